"""File sinks (K1, K2, K5, K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def layer_dir(base: str, run_id: str | int) -> str:
    """Folder of one run of a layer. No ``=`` in the name, so a glob read of the
    layer never turns the run id into a partition column."""
    return f"{base}/run-{run_id}"


def write_layer(df: DataFrame, base: str, run_id: str | int,
                partition_by: list[str] | None = None) -> str:
    """K1: overwrite the run's folder, so a retried run replaces (never doubles) its output."""
    path = layer_dir(base, run_id)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def append_layer(df: DataFrame, path: str) -> str:
    """K2: append new files to one folder."""
    df.write.mode("append").parquet(path)
    return path


def export_csv(df: DataFrame, path: str) -> str:
    """K5: CSV with a header, overwrite; a null becomes an empty field."""
    df.write.csv(path, header=True, mode="overwrite")
    return path


def publish_dims(spark: SparkSession, sources: dict[str, str] | list[str], dest: str) -> dict[str, str]:
    """K7: copy each dimension Parquet to ``dest/<name>.parquet`` (overwrite).

    ``sources`` maps names to paths, or is a list of paths named by their base
    name (``/data/customers.parquet`` -> ``customers``). Each copy is a
    distributed read + write; nothing passes through the driver.
    """
    if not isinstance(sources, dict):
        sources = {p.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet"): p for p in sources}
    out = {}
    for name, src in sources.items():
        target = f"{dest}/{name}.parquet"
        spark.read.parquet(src).write.mode("overwrite").parquet(target)
        out[name] = target
    return out
