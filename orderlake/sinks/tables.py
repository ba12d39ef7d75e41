"""Managed-table sinks (K3, K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
    """K3: append to a managed table. Columns are matched by name; another
    column count is an error."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return name


#: Partition column of the tables that :func:`append_table_once` writes.
BATCH = "batch_id"


def append_table_once(df: DataFrame, name: str, batch_id: str | int) -> str:
    """K3, safe to retry: append ``df`` as the batch ``batch_id`` of a managed table.

    The table is partitioned by the batch; an append overwrites its own batch's partition and no other. So a retry
    replaces what a first attempt left, whole or not, and rows never double. Columns are matched by name;
    other columns than the table's are an error, as in a plain append.
    """
    spark, fields = df.sparkSession, [f for f in df.schema.fields if f.name != BATCH]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {BATCH} STRING) USING parquet PARTITIONED BY ({BATCH})")
    own = [c for c in spark.table(name).columns if c != BATCH]
    if sorted(own) != sorted(f.name for f in fields):
        raise ValueError(f"{name} has the columns {own}, not {[f.name for f in fields]}")
    named = ", ".join(f"`{c}`" for c in own)
    batch = str(batch_id).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({BATCH} = '{batch}') SELECT {named} FROM {{rows}}", rows=df)
    return name


def replace_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
    """K4: overwrite a managed table. A plan that reads the same table cannot
    overwrite it (Spark refuses); materialise it elsewhere first."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return name
