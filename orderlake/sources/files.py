"""File sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import ORDER_SCHEMA


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; filters and projections applied later reach the scan."""
    return spark.read.parquet(path)


def empty_orders(spark: SparkSession, schema: StructType = ORDER_SCHEMA) -> DataFrame:
    """A typed frame with no rows (built in the JVM; all fields nullable)."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_landing(spark: SparkSession, glob: str, schema: StructType = ORDER_SCHEMA) -> DataFrame:
    """All landing files matching ``glob`` as one table, with a declared schema.

    Spark fails with PATH_NOT_FOUND when nothing matches; a run without new data
    is a no-op here, so that case gives an empty typed frame instead. The folder that the
    pattern starts from must exist: a mistyped one raises.
    """
    try:
        return spark.read.schema(schema).parquet(glob)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
    base = glob_base(glob)
    if base != glob:
        spark.read.format("binaryFile").load(base)  # raises PATH_NOT_FOUND for a missing folder
        return empty_orders(spark, schema)
    return spark.read.schema(schema).parquet(glob)


def glob_base(glob: str) -> str:
    """The folder above the first part of a path that holds a pattern."""
    parts = glob.split("/")
    for i, part in enumerate(parts):
        if any(c in part for c in "*?[{"):
            return "/".join(parts[:i])
    return glob


def read_bronze_json(spark: SparkSession, path: str, schema: StructType = ORDER_SCHEMA) -> DataFrame:
    """S3: JSON-lines scan with an explicit schema (no inference pass over the data)."""
    return spark.read.schema(schema).json(path)
