"""Reports kept up incrementally (C4, A2, A3): stored partial sums, merged on read.

A run turns the gold rows that came since the last one into sums by neighborhood and by event second, in one pass, and stores
them as one part of a layer of sums. Sums add up, so a report merges the parts that are in place and never opens
gold again. Each part is renamed into place once and is named by what it was made from, so neither a retry nor a
reader in between can count anything twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.aggregate import qty_by_event_time, qty_by_neighborhood
from ..schemas import GOLD_SCHEMA
from .incremental import landing_stream
from .layers import append_part, consume_layer, read_consumed

NEIGHBORHOOD, TIME = "neighborhood", "event_time"
SUMS_SCHEMA = (StructType().add("neighborhood", "string").add("event_date", "timestamp")
               .add("quantity_products", "long").add("kind", "string"))
_BY = ["kind"]


def partial_sums(gold: DataFrame) -> DataFrame:
    """Both reports' sums of some gold rows, told apart by ``kind`` (:data:`SUMS_SCHEMA`)."""
    keys = [F.col("neighborhood"), F.col("event_date")]
    kind = F.when(F.grouping("event_date") == 1, NEIGHBORHOOD).otherwise(TIME).alias("kind")
    return (gold.select("neighborhood", "event_date", "quantity_products").groupingSets([[keys[0]], [keys[1]]], *keys)
            .agg(F.sum("quantity_products").cast("bigint").alias("quantity_products"), kind))


def run_reports(spark: SparkSession, gold_dir: str, sums_dir: str, checkpoint: str, gold_schema: StructType = GOLD_SCHEMA,
                max_files: int | None = None) -> StreamingQuery:
    """Sums of the gold files committed since the last run; ``gold_dir`` is a layer of the plain gold job."""
    def store(batch: DataFrame, batch_id: int) -> None:
        append_part(spark, partial_sums(batch), sums_dir, batch_id + 1, batch_id + 1, _BY)

    query = (landing_stream(spark, gold_dir, gold_schema, max_files=max_files).writeStream.foreachBatch(store)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def consume_reports(spark: SparkSession, gold_dir: str, sums_dir: str, gold_schema: StructType = GOLD_SCHEMA) -> int:
    """The same for a gold layer made flush by flush; returns the last flush done."""
    return consume_layer(spark, gold_dir, gold_schema, partial_sums, sums_dir, _BY)


def _sums(spark: SparkSession, sums_dir: str, kind: str) -> DataFrame:
    return read_consumed(spark, sums_dir, SUMS_SCHEMA).where(F.col("kind") == kind)


def stored_qty_by_neighborhood(spark: SparkSession, sums_dir: str) -> DataFrame:
    """A2 from the stored sums."""
    return qty_by_neighborhood(_sums(spark, sums_dir, NEIGHBORHOOD))


def stored_qty_by_event_time(spark: SparkSession, sums_dir: str, **how) -> DataFrame:
    """A3 from the stored sums."""
    return qty_by_event_time(_sums(spark, sums_dir, TIME), **how)
