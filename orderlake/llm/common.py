"""Helpers shared by the operators: settled tables, hash columns, slices of Arrow batches."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import scratch_path
from ..storage import remove

#: Bytes of text that a task turns into numpy arrays at a time.
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch, of which a task holds one in Spark and one in Python; a row beyond it is a batch of its own.
BATCH_BYTES = 4 << 20


def settle(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage like a checkpoint does, in columns: a lost executor costs no recomputation,
    and values made by ``monotonically_increasing_id`` or by a task's own order stay fixed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    for made in _made:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


_made: list[list[str]] = []


def settle_alone(make: Callable[[], DataFrame], name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Settle what ``make`` returns and delete the tables that it settled on the way, but for those named in ``keep``:
    nothing else reads them."""
    _made.append([])
    try:
        out = settle(make(), name)
    finally:
        paths = _made.pop()
    gone = [p for p in paths[:-1] if p.rsplit("/", 1)[-1].rsplit("-", 1)[0] not in keep]
    for path in gone:
        remove(out.sparkSession, path)
    for outer in _made:
        outer[:] = [p for p in outer if p not in gone]
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a SparkContext, so that tasks can import it."""
    context = spark.sparkContext
    if getattr(context, "_orderlake_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    to = os.path.join(tempfile.mkdtemp(prefix="orderlake-code-"), "orderlake.zip")
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(to)
    context._orderlake_shipped = True


def arrow_map(df: DataFrame, task: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand in the task; after each batch a worker hands freed memory back.

    Batches are bounded by bytes as well as by rows: the session's ``spark.sql.execution.arrow.maxBytesPerBatch`` is lowered
    to ``BATCH_BYTES``, unless it is lower already.
    """
    ship(df.sparkSession)
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    given = conf.get(name).lower().rstrip("b")
    if not given.isdigit() or not 0 < int(given) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                hand_back()

        yield from task(each())
        hand_back()

    return df.mapInArrow(run, schema)


def hand_back() -> None:
    """Return memory that numpy and Arrow have freed to the system: workers are reused and would sit on it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` less the columns an operator is about to add (compared without case, as Spark does)."""
    new = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in new])


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def extended(df: DataFrame, fields: str) -> StructType:
    """The schema of ``df`` with more fields after it."""
    return StructType(df.schema.fields + StructType.fromDDL(fields).fields)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, UTF-8 texts) of runs of rows with about ``limit`` bytes; a null text is empty."""
    first, held, size = 0, [], 0
    for i, value in enumerate(column.cast(pa.binary())):
        raw = value.as_py() or b""
        if held and size + len(raw) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
