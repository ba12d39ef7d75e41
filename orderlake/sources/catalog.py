"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Tables the lakehouse keeps in its database: three layers and the dimensions.
LAYER_TABLES = ["bronze", "silver", "gold"]
DIMENSION_TABLES = ["municipality", "customers", "employees", "neighborhoods"]


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """``SELECT * FROM name``."""
    return spark.table(name)


def init_catalog(spark: SparkSession, db: str, dims: dict[str, DataFrame],
                 location: str | None = None,
                 buckets: dict[str, tuple[str, int]] | None = None) -> list[str]:
    """K8: create the database, drop every lakehouse table, load the dimensions.

    Running it twice leaves the same tables with the same rows (drop, then write).
    ``buckets`` maps a dimension to ``(key, n)``: that table is stored bucketed
    and sorted by its key, so a sort-merge join against it (a dimension too big
    to broadcast) shuffles only the order side, never the dimension.
    Returns the qualified names of the dimension tables written.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")
    for table in LAYER_TABLES + DIMENSION_TABLES + sorted(set(dims) - set(DIMENSION_TABLES)):
        drop_relation(spark, f"{db}.{table}")
    written = []
    for name, df in dims.items():
        writer = df.write.mode("overwrite")
        if buckets and name in buckets:
            key, n = buckets[name]
            writer = writer.bucketBy(n, key).sortBy(key)
        writer.saveAsTable(f"{db}.{name}")
        written.append(f"{db}.{name}")
    return written


def drop_relation(spark: SparkSession, name: str) -> None:
    """Drop a table or a view of this name, if there is one."""
    if spark.catalog.tableExists(name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {name}")


def list_databases(spark: SparkSession) -> DataFrame:
    """K9: ``SHOW DATABASES``."""
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, db: str) -> DataFrame:
    """K9: table names of one database (``SHOW TABLES FROM db``), session temp views left out."""
    return spark.sql(f"SHOW TABLES FROM {db}").where("NOT isTemporary").select("tableName")


def register_layer(spark: SparkSession, name: str, path: str) -> str:
    """Expose a layer folder as a catalog view (``SELECT * FROM data.gold``).

    A view over ``parquet.`path``` reads through the file sink's commit log, so
    files of a failed, uncommitted micro-batch never show up in the table.
    """
    return register_query(spark, name, f"SELECT * FROM parquet.`{path}`")


def register_query(spark: SparkSession, name: str, query: str) -> str:
    """A catalog view; a table of the same name gives way."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        drop_relation(spark, name)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return name
