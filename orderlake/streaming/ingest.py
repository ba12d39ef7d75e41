"""Order ingest: wire lines -> parsed orders -> raw Parquet.

The same expressions serve a streaming frame and a batch frame. The raw sink is
Spark's Parquet file sink: with a checkpoint, every micro-batch is committed once
to the sink's log, and a file-stream reader of the raw folder (the silver job)
lists files through that log, so the chain ingest -> silver is exactly once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.wire import parse_wire, wire_text
from ..operators.flush import flush_ready
from ..schemas import ORDER_SCHEMA
from ..sources.files import empty_orders
from . import ledger

#: What the ingest with quarantine lands: an order's fields, or the rejected line, by status.
LANDING_SCHEMA = StructType(ORDER_SCHEMA.fields + [StructField("value", StringType(), True),
                                                   StructField("status", StringType(), True)])


def to_wire(orders: DataFrame, batch_col: str, cols: list[str] | None = None) -> DataFrame:
    """A5 + F15: pack the orders of each batch into one JSON-array line ``value``.

    A batch holds a handful of orders (5–10 on the real feed), so each
    ``collect_list`` group stays small; batches are spread over all tasks.
    """
    cols = cols or [f.name for f in ORDER_SCHEMA.fields]
    return (orders.groupBy(batch_col)
            .agg(wire_text(F.collect_list(F.struct(*cols))).alias("value")))


def _parsed(lines: DataFrame) -> DataFrame:
    return lines.select("value", parse_wire("value").alias("data"))


def parse_orders(lines: DataFrame) -> DataFrame:
    """F13 -> F14 -> P8. Null, blank, malformed and ``[]`` lines give no rows."""
    return (_parsed(lines).select(F.explode("data").alias("order")).select("order.*"))


def quarantine(lines: DataFrame) -> DataFrame:
    """Lines whose parse result is null (malformed or blank), kept for inspection."""
    return (_parsed(lines).where(F.col("data").isNull() & F.col("value").isNotNull())
            .select("value"))


def landed(lines: DataFrame) -> DataFrame:
    """Orders and rejected lines of one parse, told apart by ``status`` (:data:`LANDING_SCHEMA`)."""
    fields = ORDER_SCHEMA.fields
    text = lambda c: c.cast("string").alias("value")
    orders = F.transform("data", lambda o: F.struct(*[o[f.name].alias(f.name) for f in fields], text(F.lit(None)),
                                                    F.lit("order").alias("status")))
    reject = F.array(F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields], text(F.col("value")),
                              F.lit("reject").alias("status")))
    rows = F.when(F.col("data").isNotNull(), orders).when(F.col("value").isNotNull(), reject)
    return _parsed(lines).select(F.explode(rows).alias("row")).select("row.*")


def landed_orders(landing: DataFrame) -> DataFrame:
    """The orders of a landing frame (batch or stream); only their partition is read."""
    return landing.where(F.col("status") == "order").select(*ORDER_SCHEMA.names)


def landed_rejects(landing: DataFrame) -> DataFrame:
    return landing.where(F.col("status") == "reject").select("value")


def _start(frame: DataFrame, path: str, checkpoint: str, trigger: dict | None,
           name: str | None, partition_by: list[str] | None = None) -> StreamingQuery:
    writer = (frame.writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(**(trigger or {"processingTime": "30 seconds"}))
    return writer.start()


def start_ingest(lines: DataFrame, raw_dir: str, checkpoint: str,
                 trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """One long-running query (or ``{"availableNow": True}`` per scheduled run)."""
    return _start(parse_orders(lines), raw_dir, checkpoint, trigger, name)


def start_ingest_with_quarantine(lines: DataFrame, landing: str, checkpoint: str,
                                 trigger: dict | None = None,
                                 name: str | None = None) -> StreamingQuery:
    """C1 with the quarantine branch: one query, one JSON parse a line, one file sink.

    Orders and rejects land below ``landing`` in partitions ``status=order`` and ``status=reject``.
    The sink's log alone says which files count, so files of a cut-off attempt are never seen;
    read the folder with :data:`LANDING_SCHEMA` and :func:`landed_orders` or :func:`landed_rejects`.
    """
    return _start(landed(lines), landing, checkpoint, trigger, name, ["status"])


def _stage(staging: str, batch_id: int) -> str:
    return f"{staging}/batch-{batch_id:012d}"


def gated_batch_handler(staging: str, threshold: int = 50, max_age: int | None = None, clock: Callable[[], float] = time.time):
    """The ``foreachBatch`` function of :func:`start_gated_ingest`.

    Orders are staged first, the ledger row that publishes them comes second. A retry of the batch
    writes the same folder and the same row again; until the row is there, nobody reads the folder.
    """
    book = f"{staging}/_ledger"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parse_orders(batch).write.mode("overwrite").parquet(_stage(staging, batch_id))
        staged = spark.read.schema(ORDER_SCHEMA).parquet(_stage(staging, batch_id))
        prev = ledger.last_before(spark, book, batch_id)
        level, flushes = (prev.level, prev.flushes) if prev else (0, 0)
        open_from = prev.open_from if prev and prev.open_from is not None else batch_id
        now = int(clock())
        opened_at = prev.opened_at if prev and prev.opened_at is not None else now
        held = F.lit(level) + F.col("n")
        ready = flush_ready(held, threshold)
        if max_age is not None and now - opened_at >= max_age:
            ready |= held > 0
        row = {"batch_id": F.lit(batch_id), "n": F.col("n"), "level": F.when(ready, 0).otherwise(held),
               "flushes": F.lit(flushes) + F.when(ready, 1).otherwise(0), "open_from": F.when(~ready, F.lit(open_from)),
               "opened_at": F.when(~ready, F.lit(opened_at))}
        (staged.agg(F.count(F.lit(1)).alias("n")).select(*[row[c].cast("bigint").alias(c) for c in ledger.COLUMNS])
         .write.mode("overwrite").parquet(ledger.single(book, batch_id)))
        ledger.compact(spark, book, batch_id)

    return handle


def start_gated_ingest(lines: DataFrame, staging: str, checkpoint: str,
                       threshold: int = 50, trigger: dict | None = None,
                       name: str | None = None, max_age: int | None = None) -> StreamingQuery:
    """C1 with the reference's count gate (T3/A6): micro-batches gather until more
    than ``threshold`` rows are buffered, then all of them count as one flush and the buffer
    starts empty. With ``max_age`` (seconds) a buffer that has waited so long also goes out with the next micro-batch;
    :func:`close_flush` lets it out when none comes.

    The buffer is on shared storage, not on the driver: every micro-batch is
    staged once under its batch id, and a one-row ledger per batch keeps the buffer level, the
    flush count and the first buffered batch. The ledger is the manifest: :func:`read_flushed`
    reads the folders of flushed batches and no others, so nothing is copied on a flush and a
    retry can't double anything. Rows below the threshold stay out of sight until a
    later batch carries them out. Memory does not depend on the threshold.
    """
    writer = (lines.writeStream.foreachBatch(gated_batch_handler(staging, threshold, max_age))
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def flush_ledger(spark, staging: str, after: int = 0) -> DataFrame:
    """``batch_id, n, flush_id, flushed`` per micro-batch, from the gate's ledger.

    ``flush_id`` numbers (from 1) the flush that carries the batch out, null while it is buffered;
    ``flushed`` marks the batch that closes its flush. With ``after`` only batches of later flushes are listed, and only
    their part of the ledger is read.
    """
    rows = ledger.rows(spark, f"{staging}/_ledger", after)
    if rows is None:
        return empty_orders(spark, StructType.fromDDL("batch_id bigint, n bigint, flush_id bigint, flushed boolean"))
    total = rows.agg(F.max("flushes")).first()[0]
    closes = F.col("open_from").isNull()
    own = F.col("flushes") + F.when(closes, 0).otherwise(1)
    out = rows.select("batch_id", "n", F.when(own <= F.lit(total), own).cast("bigint").alias("flush_id"), closes.alias("flushed"))
    return out.where(F.col("flush_id").isNull() | (F.col("flush_id") > after)) if after else out


def close_flush(spark, staging: str, max_age: int = 0, now: float | None = None) -> bool:
    """Let the buffered rows out (by age, or whatever their age at the end of a feed); between runs of the gate."""
    return ledger.close_open(spark, f"{staging}/_ledger", int(time.time() if now is None else now), max_age)


def read_flushed(spark, staging: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """Orders of the flushes numbered above ``after`` (to ``upto``), as the manifest lists them."""
    listed = flush_ledger(spark, staging, after).where(F.col("flush_id") > after)
    if upto is not None:
        listed = listed.where(F.col("flush_id") <= upto)
    batches = [r.batch_id for r in listed.orderBy("batch_id").select("batch_id").collect()]  # a row a new micro-batch
    if not batches:
        return empty_orders(spark)
    return spark.read.schema(ORDER_SCHEMA).parquet(*[_stage(staging, b) for b in batches])


def ingest(lines: DataFrame, path: str, checkpoint: str, min_rows: int | None = None,
           trigger: dict | None = None, max_age: int | None = None) -> StreamingQuery:
    """C1 as planned: land wire lines in ``path``; with ``min_rows`` (51 in the reference, i.e.
    more than 50) ``path`` is the staging folder of a gated ingest."""
    if min_rows is None:
        return start_ingest(lines, path, checkpoint, trigger)
    return start_gated_ingest(lines, path, checkpoint, threshold=min_rows - 1, trigger=trigger, max_age=max_age)
