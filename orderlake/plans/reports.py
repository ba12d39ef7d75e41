"""C4 reports: quantity by neighborhood and by event time, plus the gold CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.aggregate import qty_by_event_time, qty_by_neighborhood
from ..sinks.files import export_csv


def export_reports(gold: DataFrame, out_dir: str) -> dict[str, str]:
    """Write gold and both reports as CSV under ``out_dir``; only aggregated rows
    and the distributed gold write leave the executors (no ``toPandas``)."""
    paths = {"gold": f"{out_dir}/gold", "by_neighborhood": f"{out_dir}/by_neighborhood",
             "by_event_time": f"{out_dir}/by_event_time"}
    export_csv(gold, paths["gold"])
    export_csv(qty_by_neighborhood(gold), paths["by_neighborhood"])
    export_csv(qty_by_event_time(gold), paths["by_event_time"])
    return paths


def export_stored_reports(spark: SparkSession, sums_dir: str, out_dir: str) -> dict[str, str]:
    """Both reports as CSV from stored partial sums (:mod:`orderlake.streaming.reports`); gold is not read."""
    from ..streaming.reports import stored_qty_by_event_time, stored_qty_by_neighborhood
    paths = {"by_neighborhood": f"{out_dir}/by_neighborhood", "by_event_time": f"{out_dir}/by_event_time"}
    export_csv(stored_qty_by_neighborhood(spark, sums_dir), paths["by_neighborhood"])
    export_csv(stored_qty_by_event_time(spark, sums_dir), paths["by_event_time"])
    return paths
