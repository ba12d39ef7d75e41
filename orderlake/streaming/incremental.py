"""Incremental layer jobs (K10, T4): each landing file is consumed exactly once.

A job is a file-stream query with a checkpoint, run with
``trigger(availableNow=True)`` by whatever scheduler calls it (30 min for
silver, 60 min for gold in the reference). The checkpoint — not the folder
contents — records what was consumed, so a retry or an early re-run neither
skips nor doubles files, and files that land while a run is going are picked
up by the next run. Outputs go through the Parquet file sink (its log commits
each batch once). ``cleanSource=archive`` may tidy the landing folder, but it
lags one batch and is never used to decide what is new.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.gold import to_gold
from ..plans.silver import to_silver
from ..schemas import ORDER_SCHEMA
from .ingest import LANDING_SCHEMA, landed_orders


def landing_stream(spark: SparkSession, landing: str, schema: StructType,
                   archive: str | None = None, max_files: int | None = None) -> DataFrame:
    """File-stream source over a landing folder (glob patterns allowed)."""
    reader = spark.readStream.schema(schema).format("parquet")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(landing)


def bound_checkpoint(spark: SparkSession, job: str, source: str, out_dir: str, state: str | None = None) -> str:
    """The checkpoint of one job from one source to one output, kept with the output.

    Its place follows from the output (``<out>/_state/<job>``, or ``<state>/<job>-<hash of the output>``), so
    two outputs never share one. The source it was made for is recorded next to it; another source
    is refused, since its files would be taken for those already done.
    """
    place = f"{out_dir.rstrip('/')}/_state/{job}"
    if state:
        place = f"{state.rstrip('/')}/{job}-{hashlib.sha256(out_dir.rstrip('/').encode()).hexdigest()[:16]}"
    record = f"source={source.rstrip('/')} output={out_dir.rstrip('/')}"
    try:
        known = spark.read.text(f"{place}/_made_for").first()
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    if known is None:
        spark.range(1).select(F.lit(record).alias("value")).coalesce(1).write.mode("overwrite").text(f"{place}/_made_for")
    elif known[0] != record:
        raise ValueError(f"the state of job {job} in {place} was made for {known[0]}, not for {record}")
    return f"{place}/checkpoint"


def consume_landing(spark: SparkSession, landing: str, schema: StructType,
                    transform: Callable[[DataFrame], DataFrame], out_dir: str, checkpoint: str,
                    archive: str | None = None, partition_by: list[str] | None = None,
                    wait: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Process every landing file not yet seen by ``checkpoint`` into ``out_dir``.

    With ``partition_by`` rows are first rebalanced by those columns: a small partition is written
    by one task, a hot one is split by size, so the number of files follows the data and not tasks x
    partitions. ``max_files`` bounds a micro-batch, so that a backlog is taken in steps.
    """
    frame = transform(landing_stream(spark, landing, schema, archive, max_files))
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    writer = (frame.writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint).outputMode("append")
              .trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    if wait:
        query.awaitTermination()
    return query


# Silver and gold files are laid out by event date, so date-bounded reads prune whole folders.
SILVER_PARTITIONS = ["event_year", "event_month", "event_day"]
GOLD_PARTITIONS = ["sale_date"]


def run_silver(spark: SparkSession, raw: str, neighborhoods: DataFrame, silver_dir: str,
               checkpoint: str, archive: str | None = None,
               partition_by: list[str] | None = SILVER_PARTITIONS,
               polygons: DataFrame | None = None, cell=None, priority: str | None = None,
               max_files: int | None = None, landing: bool = False) -> StreamingQuery:
    """T4 raw -> silver (C2) over the files landed since the last run.

    With ``polygons`` the neighborhood is found by location (see
    :func:`~orderlake.plans.silver.to_silver`). ``landing`` says that ``raw`` is the folder of an ingest
    with quarantine. Reading ``silver_dir`` back puts the partition columns last; select
    :data:`~orderlake.schemas.SILVER_COLUMNS` for the layer's column order.
    """
    def silver(df: DataFrame) -> DataFrame:
        return to_silver(landed_orders(df) if landing else df, neighborhoods, polygons=polygons, cell=cell, priority=priority)

    return consume_landing(spark, raw, LANDING_SCHEMA if landing else ORDER_SCHEMA, silver,
                           silver_dir, checkpoint, archive, partition_by, max_files=max_files)


def gold_layout(silver: DataFrame, customers: DataFrame, employees: DataFrame) -> DataFrame:
    """Gold with ``sale_date``, the day of the event, which lays out its files."""
    return to_gold(silver, customers, employees).withColumn("sale_date", F.to_date("event_date"))


def run_gold(spark: SparkSession, silver_dir: str, silver_schema: StructType,
             customers: DataFrame, employees: DataFrame, gold_dir: str, checkpoint: str,
             archive: str | None = None, partition_by: list[str] | None = GOLD_PARTITIONS,
             max_files: int | None = None) -> StreamingQuery:
    """T4 silver -> gold (C3) over the silver files committed since the last run.

    Gold is laid out by ``sale_date``, the day of the event; select
    :data:`~orderlake.schemas.GOLD_COLUMNS` for the layer's own columns.
    """
    def gold(df: DataFrame) -> DataFrame:
        return gold_layout(df, customers, employees) if partition_by == GOLD_PARTITIONS else to_gold(df, customers, employees)

    return consume_landing(spark, silver_dir, silver_schema, gold, gold_dir, checkpoint, archive, partition_by,
                           max_files=max_files)
