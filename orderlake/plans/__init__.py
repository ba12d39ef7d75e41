"""Composite jobs: raw -> silver -> gold -> reports, as pure DataFrame functions."""

from .gold import to_gold
from .reports import export_reports
from .silver import add_time_parts, to_silver

__all__ = ["to_gold", "export_reports", "add_time_parts", "to_silver"]
