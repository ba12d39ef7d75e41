"""Projections, renames, drops, literals and simple filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick(joined: DataFrame, left: DataFrame, right_cols: dict[str, str], right: DataFrame) -> DataFrame:
    """``left.*`` plus chosen columns of the other join side, renamed.

    ``right_cols`` maps a column of ``right`` to its output name.
    """
    return joined.select(left["*"], *[right[src].alias(dst) for src, dst in right_cols.items()])


def neighborhood_dim(nb: DataFrame) -> DataFrame:
    """The three neighborhood columns silver needs, renamed."""
    return nb.select(F.col("OBJECTID").alias("object_id"),
                     F.col("NOMBRE").alias("neighborhood"),
                     F.col("IDENTIFICACION").alias("commune"))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P5: rename columns in one projection (missing names are ignored)."""
    return df.withColumnsRenamed(mapping)


def drop_raw_date(df: DataFrame) -> DataFrame:
    """Drop the wire text once ``event_date`` exists."""
    return df.drop("date")


def drop_key(joined: DataFrame, key: Column) -> DataFrame:
    """Drop a join key by column reference (the side it came from matters)."""
    return joined.drop(key)


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """A literal column (Catalyst folds it into the projection)."""
    return df.withColumn(name, F.lit(value))


def at_coordinate(df: DataFrame, latitude: float, longitude: float) -> DataFrame:
    """P10: rows at one exact coordinate; on stored columns both predicates reach the Parquet scan."""
    return df.filter((F.col("latitude") == F.lit(latitude)) & (F.col("longitude") == F.lit(longitude)))


def sample_dim(df: DataFrame, cols: list[str], order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows of a few columns, ordered so the pick is deterministic."""
    sql = (f"SELECT {', '.join(cols)} FROM {{src}} "
           f"ORDER BY {', '.join(order)} LIMIT {int(n)}")
    return df.sparkSession.sql(sql, src=df)
