"""Sorts and limits (O1–O3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def latest_first(df: DataFrame, key: str = "order_id") -> DataFrame:
    """O1: descending by ``key``, nulls last (range-partitioned global sort).

    A hash of the whole row breaks ties. The order by ``key`` stays the same,
    but the range partitioner can now split a hot key (or the null key) over
    several partitions instead of sending all of its rows to one task.
    """
    hashable = [f"`{f.name}`" for f in df.schema.fields if not _has_map(f.dataType)]
    if not hashable:
        return df.orderBy(F.col(key).desc_nulls_last())
    return df.orderBy(F.col(key).desc_nulls_last(), F.xxhash64(*hashable))


def _has_map(t) -> bool:
    """Map values cannot be hashed by Spark; such columns stay out of the tiebreak."""
    if isinstance(t, MapType):
        return True
    if isinstance(t, ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return False


def latest(df: DataFrame, n: int = 20, key: str = "order_id") -> DataFrame:
    """O2: top ``n`` by ``key`` descending; planned as TakeOrderedAndProject
    (per-partition top-n, then one merge of n rows per partition)."""
    return latest_first(df, key).limit(n)
