"""Batch and streaming sources."""

from .catalog import init_catalog, list_databases, list_tables, register_layer, register_query, scan_table
from .files import empty_orders, read_bronze_json, read_landing, read_parquet
from .stream import orders_stream

__all__ = ["init_catalog", "list_databases", "list_tables", "register_layer", "register_query", "scan_table", "empty_orders", "read_bronze_json",
           "read_landing", "read_parquet", "orders_stream"]
