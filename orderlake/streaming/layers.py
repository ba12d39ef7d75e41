"""Layers made flush by flush (T4): a consumer whose source is a gate or another such layer.

A layer's parts are folders ``flush=f<first>-<last>``, each made of the source's flushes first to last. A part is written aside
and renamed into place when it is whole: that rename is the commit, the names are the log. The next run starts after
the last flush that any name has, so it reads the new flushes and nothing else, whether its source is the gate's
staging folder or a layer. A layer is bound to its source: what another source numbers the same is not the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.catalog import register_query
from ..sources.files import empty_orders
from ..storage import move, names, read_text, remove, swap_text
from .ingest import flush_ledger, read_flushed

PART = "flush"


def parts(spark: SparkSession, layer: str) -> list[tuple[int, int, str]]:
    """(first flush, last flush, folder) of a layer's parts, in order; one listing, nothing is opened."""
    found = []
    for name in names(spark, layer, f"{PART}=f*"):
        first, last = name.removeprefix(f"{PART}=f").split("-")
        found.append((int(first), int(last), f"{layer}/{name}"))
    return sorted(found)


def last_flush(spark: SparkSession, layer: str) -> int:
    return max((last for _, last, _ in parts(spark, layer)), default=0)


def bind(spark: SparkSession, layer: str, source: str) -> None:
    """Tie a layer to its source at its first run; another source is refused."""
    known, source = read_text(spark, f"{layer}/_source"), source.rstrip("/")
    if known is None:
        swap_text(spark, f"{layer}/_source", source)
    elif known != source:
        raise ValueError(f"{layer} is made from {known}, not from {source}")


def append_part(spark: SparkSession, rows: DataFrame, layer: str, first: int, last: int, partition_by: list[str] | None) -> None:
    """Write the part of the flushes first to last and rename it into place."""
    name = f"{PART}=f{first:010d}-{last:010d}"
    aside = f"{layer}/_staging/{name}-{uuid.uuid4().hex[:8]}"
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(aside)
    if not move(spark, aside, f"{layer}/{name}"):  # an earlier attempt got as far as this: its part is the same
        remove(spark, aside)


def consume_flushes(spark: SparkSession, staging: str, transform: Callable[[DataFrame], DataFrame], out_dir: str,
                    partition_by: list[str] | None = None) -> int:
    """Process the gate's flushes not yet in ``out_dir`` as one part; returns the last flush done."""
    bind(spark, out_dir, staging)
    before = last_flush(spark, out_dir)
    last = flush_ledger(spark, staging, before).agg(F.max("flush_id")).first()[0] or 0
    if last > before:
        append_part(spark, transform(read_flushed(spark, staging, before, last)), out_dir, before + 1, last, partition_by)
    return max(last, before)


def consume_layer(spark: SparkSession, source: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], out_dir: str,
                  partition_by: list[str] | None = None) -> int:
    """Process the parts of the layer ``source`` not yet in ``out_dir`` as one part; returns the last flush done."""
    bind(spark, out_dir, source)
    before = last_flush(spark, out_dir)
    fresh = [p for p in parts(spark, source) if p[0] > before]
    if not fresh:
        return before
    append_part(spark, transform(_read(spark, source, schema, fresh)), out_dir, fresh[0][0], fresh[-1][1], partition_by)
    return fresh[-1][1]


def _read(spark: SparkSession, layer: str, schema: StructType, some: list[tuple[int, int, str]]) -> DataFrame:
    rows = spark.read.schema(schema).option("basePath", layer).parquet(*[p[2] for p in some])
    return rows.select(*schema.names)


def read_consumed(spark: SparkSession, out_dir: str, schema: StructType, after: int = 0) -> DataFrame:
    """The layer's rows, or those of its parts that begin after a flush."""
    some = [p for p in parts(spark, out_dir) if p[0] > after]
    return _read(spark, out_dir, schema, some) if some else empty_orders(spark, schema)


def register_consumed(spark: SparkSession, name: str, layer: str, columns: list[str]) -> str:
    """The layer as a catalog view: a query by name sees every part in place, and no part that is not."""
    return register_query(spark, name, f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM parquet.`{layer}`")
