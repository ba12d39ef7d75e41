"""Column-level functions (built-in Spark expressions only, no UDFs)."""

from .geometry import inside, ring_edges
from .timeparts import (epoch_to_text, parse_event_time, text_to_epoch,
                        time_parts, time_parts_by_substring)
from .wire import parse_wire, wire_text

__all__ = [
    "inside", "ring_edges",
    "epoch_to_text", "parse_event_time", "text_to_epoch",
    "time_parts", "time_parts_by_substring",
    "parse_wire", "wire_text",
]
