"""Batch sinks (K1–K7), versioned replacement and clustered layers."""

from .clustered import file_bounds, latest_stored, read_clustered, sorted_stored, write_clustered
from .files import append_layer, export_csv, publish_dims, write_layer
from .snapshots import publish_snapshots, read_snapshot, replace_snapshot, replace_table_snapshot
from .tables import append_table, append_table_once, replace_table

__all__ = ["append_layer", "export_csv", "publish_dims", "write_layer", "append_table", "append_table_once", "replace_table",
           "publish_snapshots", "read_snapshot", "replace_snapshot", "replace_table_snapshot", "file_bounds", "latest_stored",
           "read_clustered", "sorted_stored", "write_clustered"]
