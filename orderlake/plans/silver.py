"""C2 raw -> silver: parsed event time, calendar parts, neighborhood and commune."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.timeparts import parse_event_time, time_parts
from ..operators.joins import BROADCAST_MAX_ROWS, add_neighborhood
from ..operators.project import drop_raw_date
from ..operators.spatial import assign_polygon, suggest_cell
from ..schemas import SILVER_COLUMNS


def add_time_parts(raw: DataFrame, src: str = "date") -> DataFrame:
    """F1–F8 + P6: ``event_date`` and its calendar parts; the wire text is dropped."""
    with_ts = raw.withColumn("event_date", parse_event_time(src))
    return drop_raw_date(with_ts.withColumns(time_parts("event_date")))


def to_silver(raw: DataFrame, neighborhoods: DataFrame,
              max_broadcast_rows: int = BROADCAST_MAX_ROWS,
              polygons: DataFrame | None = None, cell=None, priority: str | None = None) -> DataFrame:
    """One narrow projection + one left lookup; column order as in :data:`SILVER_COLUMNS`.

    By default the neighborhood comes from the order's ``object_id``. With
    ``polygons`` (``polygon_id`` = ``OBJECTID``, ``rings``) it comes from where
    the order is: the first polygon that strictly contains (longitude, latitude)
    replaces ``object_id`` before the lookup (J6/J7), null if none does. ``priority`` names the
    polygon column that says which comes first (``poly_seq``, else the id, by default).
    """
    staged = add_time_parts(raw)
    if polygons is not None:
        staged = assign_polygon(staged.drop("object_id"), polygons,
                                cell if cell is not None else suggest_cell(polygons),
                                out_col="object_id", priority=priority, max_broadcast_rows=max_broadcast_rows)
    silver = add_neighborhood(staged, neighborhoods, max_broadcast_rows)
    return silver.select(*SILVER_COLUMNS)
