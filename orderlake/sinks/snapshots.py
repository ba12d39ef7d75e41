"""Replacement without a gap (K4, K7): versioned folders and a pointer that is swapped last.

A new version is written beside the old one. Only when it is whole does the pointer (a small file, or a catalog
view) move to it, in one step. Until then, and after a failed write, readers get the old version. A plan may
replace what it reads, since nothing that it reads is touched. The last ``keep`` versions stay for readers
that began with them; older ones, and what failed writes left, go after a swap. One writer at a time replaces a folder or table.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.catalog import drop_relation, register_query
from ..storage import exists, names, read_text, remove, swap_text

POINTER = "_current"


def _write_version(df: DataFrame, base: str, partition_by: list[str] | None) -> str:
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"  # in order of time
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{base}/{version}")
    return version


def _drop_old(spark: SparkSession, base: str, current: str, keep: int) -> None:
    older = [v for v in names(spark, base, "v-*") if v < current]
    whole = [v for v in older if exists(spark, f"{base}/{v}/_SUCCESS")]  # the rest are writes that failed
    for v in set(older) - set(whole[len(whole) - keep + 1:] if keep > 1 else []):
        remove(spark, f"{base}/{v}")


def replace_snapshot(df: DataFrame, base: str, partition_by: list[str] | None = None, keep: int = 2) -> str:
    """Make ``df`` the current version of the folder ``base``; returns the version."""
    spark = df.sparkSession
    version = _write_version(df, base, partition_by)
    swap_text(spark, f"{base}/{POINTER}", version)
    _drop_old(spark, base, version, keep)
    return version


def read_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """The current version of ``base``; it stays readable while the next ones replace it."""
    version = read_text(spark, f"{base}/{POINTER}")
    if version is None:
        raise FileNotFoundError(f"{base} has no current version")
    return spark.read.parquet(f"{base}/{version}")


def publish_snapshots(spark: SparkSession, sources: dict[str, str] | list[str], dest: str, keep: int = 2) -> dict[str, str]:
    """K7: publish each dimension as a new version of ``dest/<name>`` (read it with :func:`read_snapshot`)."""
    if not isinstance(sources, dict):
        sources = {p.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet"): p for p in sources}
    for name, src in sources.items():
        replace_snapshot(spark.read.parquet(src), f"{dest}/{name}", keep=keep)
    return {name: f"{dest}/{name}" for name in sources}


def replace_table_snapshot(df: DataFrame, name: str, base: str | None = None, partition_by: list[str] | None = None, keep: int = 2) -> str:
    """K4: replace the table ``name`` by ``df``, which may read that very table.

    The name is a view of the current version below ``base`` (by default a folder in the database's place); it
    is replaced last. A managed table of that name gives way once the version is whole.
    """
    spark = df.sparkSession
    if base is None:
        db, _, table = name.rpartition(".")
        base = f"{spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri}/{table}_versions"
    version = _write_version(df, base, partition_by)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        drop_relation(spark, name)
    columns = ", ".join(f"`{c}`" for c in df.columns)  # partition columns come back in their places
    register_query(spark, name, f"SELECT {columns} FROM parquet.`{base}/{version}`")
    _drop_old(spark, base, version, keep)
    return name
