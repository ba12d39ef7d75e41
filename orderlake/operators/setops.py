"""Bag unions (U1). No shuffle: a union only concatenates partitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def append_orders(*frames: DataFrame) -> DataFrame:
    """Positional bag union of frames with the same shape (duplicates kept)."""
    return reduce(DataFrame.union, frames)


def union_versions(*frames: DataFrame) -> DataFrame:
    """U1 across schema versions: by name, a column missing on one side is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
