"""The count gate's ledger: one row a micro-batch, compacted so that a run reads what is new.

Rows are written singly, ``batch-<id>``. Every ``RADIX`` batches the last ``RADIX`` rows are merged into one segment, every
``RADIX`` segments into one of the next level, and so on: any number of batches is covered by a few dozen segments at
most. A segment's name says which batches it covers and the last flush it touches, so a reader that knows where it stopped
picks the segments it needs by name. Rows merged in one round are deleted in the next, so that a reader which listed them still finds
them. Every step may be repeated: a retried batch writes the same row, and a repeated merge the same segment.

A flush that closed without a full count (by age, or at the end of a feed) is a record of its own, ``closed-<id of its last
batch>``. A retried batch thus can't open it again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..storage import move, names, remove

COLUMNS = ["batch_id", "n", "level", "flushes", "open_from", "opened_at"]
SCHEMA = ", ".join(f"{c} bigint" for c in COLUMNS)
#: Rows or segments that make a segment of the next level.
RADIX = 10


def read_if_there(spark, schema, *paths: str) -> DataFrame | None:
    """The Parquet below ``paths``; None where no such path exists (any other error is raised)."""
    try:
        return spark.read.schema(schema).parquet(*paths)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def single(ledger: str, batch_id: int) -> str:
    return f"{ledger}/batch-{batch_id:012d}"


def _segments(listed: list[str]) -> list[tuple[int, int, int, int, str]]:
    """(first, last, level, last flush, name) of the segments among names, those that cover most first."""
    found = []
    for name in listed:
        if name.startswith("segment-"):
            level, first, last, flush = map(int, name.split("-")[1:])
            found.append((first, last, level, flush, name))
    return sorted(found, key=lambda s: (s[0], -s[1]))


def _cover(listed: list[str]) -> tuple[list[tuple], list[int]]:
    """Segments that don't overlap, and the single rows after them."""
    kept, end = [], -1
    for s in _segments(listed):
        if s[0] > end:
            kept.append(s)
            end = s[1]
    return kept, [b for b in sorted(int(n[6:]) for n in listed if n.startswith("batch-")) if b > end]


def _closes(rows: DataFrame, closed: list[int]) -> DataFrame:
    """Rows whose flush was closed without a full count, as closed ones."""
    if not closed:
        return rows
    shut = F.col("batch_id").isin(closed) & F.col("open_from").isNotNull()
    return rows.withColumns({"flushes": F.when(shut, F.col("flushes") + 1).otherwise(F.col("flushes")),
                             "level": F.when(shut, F.lit(0)).otherwise(F.col("level")),
                             "open_from": F.when(~shut, F.col("open_from")), "opened_at": F.when(~shut, F.col("opened_at"))}).select(*COLUMNS)


def rows(spark: SparkSession, ledger: str, after: int = 0) -> DataFrame | None:
    """The ledger's rows, at least those of flushes above ``after`` and the newest; None without any."""
    listed = names(spark, ledger)
    segments, singles = _cover(listed)
    paths = [f"{ledger}/{s[4]}" for s in segments if s[3] > after] + [single(ledger, b) for b in singles]
    if not paths and segments:
        paths = [f"{ledger}/{segments[-1][4]}"]
    if not paths:
        return None
    closed = [int(n[7:]) for n in listed if n.startswith("closed-")]
    return _closes(spark.read.schema(SCHEMA).parquet(*paths), closed)


def last_before(spark: SparkSession, ledger: str, batch_id: int) -> Row | None:
    """The row of the last micro-batch before ``batch_id`` (None at the start)."""
    if batch_id == 0:
        return None
    one = read_if_there(spark, SCHEMA, single(ledger, batch_id - 1))
    if one is not None:
        closed = [batch_id - 1] if names(spark, ledger, f"closed-{batch_id - 1:012d}") else []
        return _closes(one, closed).first()
    every = rows(spark, ledger)
    return every and every.where(F.col("batch_id") < batch_id).orderBy(F.col("batch_id").desc()).first()


def _merge(spark: SparkSession, ledger: str, level: int, first: int, last: int) -> None:
    listed = names(spark, ledger)
    if level == 1:
        parts = [f"{ledger}/{n}" for n in listed if n.startswith("batch-") and first <= int(n[6:]) <= last]
    else:
        parts = [f"{ledger}/{s[4]}" for s in _segments(listed) if s[2] == level - 1 and first <= s[0] and s[1] <= last]
    if len(parts) < RADIX:  # a feed that began with a later batch: its first rows stay single
        return
    closed = [int(n[7:]) for n in listed if n.startswith("closed-") and first <= int(n[7:]) <= last]
    merged = _closes(spark.read.schema(SCHEMA).parquet(*parts), closed)
    top = merged.agg(F.max(F.col("flushes") + F.when(F.col("open_from").isNull(), 0).otherwise(1))).first()[0]
    path = f"{ledger}/segment-{level}-{first:012d}-{last:012d}-{top:012d}"
    merged.orderBy("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{ledger}/_new-{level}-{first}")
    remove(spark, path)
    move(spark, f"{ledger}/_new-{level}-{first}", path)


def compact(spark: SparkSession, ledger: str, batch_id: int) -> None:
    """Merge what ``batch_id`` completes, and drop what the round before merged.

    The row of the last batch, and whatever a running reader may have listed, stay for one more round.
    """
    span, level = RADIX, 1
    while (batch_id + 1) % span == 0:
        first = batch_id + 1 - span
        _merge(spark, ledger, level, first, batch_id)
        listed = names(spark, ledger)
        merged = [s for s in _segments(listed) if s[2] == level and s[1] < first]
        for name in listed:
            kind, at = name.split("-")[0], name.split("-")[-2 if name.startswith("segment-") else -1]
            mine = kind in ("batch", "closed") if level == 1 else kind == "segment" and name.split("-")[1] == str(level - 1)
            if mine and any(s[0] <= int(at) <= s[1] for s in merged):
                remove(spark, f"{ledger}/{name}")
        span, level = span * RADIX, level + 1


def close_open(spark: SparkSession, ledger: str, now: int, max_age: int = 0) -> bool:
    """Close the open flush if it holds rows and was opened ``max_age`` seconds before ``now`` (seconds) or earlier.

    For a time when no micro-batch is running (between the runs of a scheduled job).
    """
    every = rows(spark, ledger)
    last = every and every.orderBy(F.col("batch_id").desc()).first()
    if not last or not last.level or last.opened_at is None or now - last.opened_at < max_age:
        return False
    spark.createDataFrame([(last.batch_id, now)], "batch_id bigint, closed_at bigint").coalesce(1).write.mode("overwrite").parquet(
        f"{ledger}/closed-{last.batch_id:012d}")
    return True
