"""Range-clustered layers (O1, O2 on stored data): files in key order with their bounds.

A layer is range-sorted by its key before it is written, so every file covers a narrow range of keys. The bounds and row
counts of its files are stored beside it, a row a file. The latest rows are then in the few files with the highest
bounds: nothing else is opened. Each write adds files and their bounds, so a layer may grow run by run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.order import latest, latest_first

BOUNDS = "_bounds"


def write_clustered(df: DataFrame, path: str, key: str = "order_id", files: int | None = None) -> str:
    """Append ``df`` to a clustered layer, in ``files`` files or as many as the session's shuffle partitions."""
    spark = df.sparkSession
    run = f"run-{uuid.uuid4().hex[:12]}"
    order = [F.col(key).asc_nulls_last()]
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.parquet(f"{path}/{run}")
    stored = spark.read.schema(df.schema).parquet(f"{path}/{run}")
    bounds = stored.groupBy(F.input_file_name().alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("n"), F.count(F.lit(1)).alias("n_rows"))
    bounds.coalesce(1).write.parquet(f"{path}/{BOUNDS}/{run}")  # a row a file; written last: it makes the run count
    return path


def file_bounds(spark: SparkSession, path: str) -> DataFrame:
    """(file, low, high, n, n_rows) of the files of a clustered layer; n counts rows with a key."""
    return spark.read.parquet(f"{path}/{BOUNDS}/run-*")


def read_clustered(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of the runs whose bounds are written."""
    runs = sorted({r[0] for r in spark.read.parquet(f"{path}/{BOUNDS}/run-*").select(
        F.regexp_extract("file", r"(run-[0-9a-f]{12})/[^/]*$", 1)).distinct().collect()})  # a row a run
    return spark.read.schema(schema).parquet(*[f"{path}/{r}" for r in runs])


def latest_stored(spark: SparkSession, path: str, schema: StructType, n: int = 20, key: str = "order_id") -> DataFrame:
    """O2 on a clustered layer: the ``n`` rows with the highest keys, from the files that can hold them.

    The ``n`` files with the highest bounds hold at least n rows with a key, if there are so many at all. The least key that
    may count follows from the fewest of them that hold n rows; a file is read if it reaches that key.
    """
    bounds = file_bounds(spark, path)
    top = bounds.where("n > 0").orderBy(F.desc("high"), F.desc("low")).limit(n).collect()  # at most n rows
    held, least = 0, None
    for r in top:
        held, least = held + r.n, r.low if least is None else min(least, r.low)
        if held >= n:
            break
    if held < n:  # too few keys: rows without one follow
        return latest(read_clustered(spark, path, schema), n, key)
    files = [r.file for r in bounds.where(F.col("high") >= F.lit(least)).select("file").collect()]  # those that overlap the last n rows
    return latest(spark.read.schema(schema).parquet(*files), n, key)


def sorted_stored(spark: SparkSession, path: str, schema: StructType, key: str = "order_id") -> DataFrame:
    """O1 on a clustered layer."""
    return latest_first(read_clustered(spark, path, schema), key)
