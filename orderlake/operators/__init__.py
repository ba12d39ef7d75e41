"""DataFrame operators: each takes and returns DataFrames."""

from .aggregate import count_rows, qty_by_event_time, qty_by_neighborhood
from .joins import (add_customer, add_employee, add_neighborhood, bounded,
                    broadcast_if_bounded, lookup_by_coordinate)
from .order import latest, latest_first
from .project import (at_coordinate, drop_key, drop_raw_date, neighborhood_dim,
                      pick, rename, sample_dim, with_constant)
from .flush import flush_ready
from .setops import append_orders, union_versions
from .spatial import (assign_polygon, cell_index, points_in_polygons, polygon_bounds,
                      suggest_cell, within, within_area)

__all__ = [
    "count_rows", "qty_by_event_time", "qty_by_neighborhood",
    "add_customer", "add_employee", "add_neighborhood", "bounded", "broadcast_if_bounded",
    "lookup_by_coordinate", "latest", "latest_first",
    "at_coordinate", "drop_key", "drop_raw_date", "neighborhood_dim", "pick",
    "rename", "sample_dim", "with_constant", "append_orders", "union_versions",
    "assign_polygon", "cell_index", "flush_ready", "suggest_cell", "points_in_polygons", "polygon_bounds",
    "within", "within_area",
]
