"""Aggregations (A1–A3). All run as partial (map-side) + final hash aggregates,
so a hot group costs one partial row per task before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import REPORT_TIME_FORMAT


def count_rows(df: DataFrame) -> DataFrame:
    """A1: one-row frame with ``n`` = number of rows."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def qty_by_neighborhood(gold: DataFrame) -> DataFrame:
    """A2: total quantity per neighborhood, keys ascending.

    Follows the reference's pandas group-by: the null key is dropped, null
    quantities are skipped and an all-null group sums to 0.
    """
    return (gold.select("neighborhood", "quantity_products")
            .where(F.col("neighborhood").isNotNull())
            .groupBy("neighborhood")
            .agg(F.coalesce(F.sum("quantity_products"), F.lit(0)).cast("bigint").alias("quantity_products"))
            .orderBy("neighborhood"))


def qty_by_event_time(gold: DataFrame, key_format: str = REPORT_TIME_FORMAT,
                      missing: str | None = None) -> DataFrame:
    """A3: total quantity per event second, keyed by its text.

    Grouping runs on the TIMESTAMP (fixed width, cheap to hash); the text is
    made once per group. A missing time is its own group, keyed ``missing`` (null by default).
    Null quantities are skipped and an all-null group sums to 0.

    The reference's pandas report writes a missing time as ``'NaT'`` and, when every time is midnight,
    dates only: ``key_format="yyyy-MM-dd", missing="NaT"`` renders that.
    """
    grouped = (gold.select("event_date", "quantity_products")
               .groupBy("event_date")
               .agg(F.coalesce(F.sum("quantity_products"), F.lit(0)).cast("bigint")
                    .alias("quantity_products")))
    text = F.coalesce(F.date_format("event_date", key_format), F.lit(missing).cast("string"))
    return grouped.select(text.alias("event_date"), "quantity_products").orderBy("event_date")
