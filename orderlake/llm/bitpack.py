"""Token-id files: fixed-width bit packing in blocks with offsets.

An id takes ``width_of(vocabulary)`` bits, the least that holds every id. A file row is one block: whole
documents in ascending order of their key, with the lengths that say where each starts, and the
packed ids. ``unpack`` reads any range of a block's ids without touching the rest, so block and
offset are enough for random access. The container is Parquet, so blocks are written by Spark's own
committer to any store.

Layout: rows are dealt by ranges of the key; ``part`` counts the ranges, ``block`` the blocks of a
part, ``start`` the ids of the part before the block. ``starts`` gives each part's place in the whole.

Edge cases: a null text is empty and still gets its end id; equal keys stand next to each other in
any order among themselves; rows with a null key come first; an empty table
gives files without rows. Columns other than key and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import arrow_map

#: Ids after which a block ends (with the document that reaches it).
BLOCK_IDS = 1 << 18
BLOCKS = ("part int, block int, start long, width int, n_ids long, keys array<bigint>, lens array<int>, "
          "payload binary")


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``width`` bits an id, least bit first, without gaps."""
    if width == 16:
        return ids.astype("<u2").tobytes()
    if width == 32:
        return ids.astype("<u4").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, n_ids: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive) of a block, as uint32; reads only their bytes."""
    last = n_ids if last is None else last
    if width in (16, 32):
        size = width // 8
        return np.frombuffer(payload, f"<u{size}", last - first, first * size).astype(np.uint32)
    low, high = first * width // 8, -(-last * width // 8)
    bits = np.unpackbits(np.frombuffer(payload, np.uint8, high - low, low), bitorder="little")
    bits = bits[first * width - 8 * low:][: (last - first) * width].reshape(-1, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def crc32(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def write_ids(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int, key: str = "doc_id",
              text: str = "text", partitions: int | None = None) -> None:
    """Encode whole texts and write them as blocks below ``path`` in ascending order of ``key``."""
    width = width_of(vocabulary)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (rows.repartitionByRange(n, "k").sortWithinPartitions("k")
              .select("k", "t", F.spark_partition_id().alias("p")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens.words(tokenizer, True)
        end = np.array([end_id], np.uint32)
        held: list[np.ndarray] = []
        keys: list = []
        part = block = start = size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, start, size
            ids = np.concatenate(held)
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                pa.array([width], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([keys], pa.list_(pa.int64())),
                pa.array([[len(h) for h in held]], pa.list_(pa.int32())), pa.array([pack(ids, width)], pa.binary())],
                names=["part", "block", "start", "width", "n_ids", "keys", "lens", "payload"])
            block, start, size = block + 1, start + len(ids), 0
            held.clear()
            keys.clear()
            return row

        for batch in batches:
            ks, ts, ps = (c.to_pylist() for c in batch.columns)
            for k, p, ids in zip(ks, ps, words.encode_all(t or "" for t in ts)):
                part = p
                ids = np.concatenate([ids, end])
                held.append(ids)
                keys.append(k)
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    arrow_map(ranged, encode, BLOCKS).write.option("compression", "zstd").parquet(path)


def blocks(spark, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def starts(files: DataFrame) -> DataFrame:
    """(part, base): the ids in all parts before; a row a part."""
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    return totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, from the blocks."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):  # a block at a time
                ids = unpack(r["payload"], r["width"], r["n_ids"])
                lens = np.array(r["lens"], np.int64)
                at = np.cumsum(lens) - lens
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["keys"], pa.int64()), pa.array(np.full(len(lens), r["part"], np.int32)),
                    pa.array(at + r["start"]), pa.array(lens),
                    pa.array([crc32(ids[a:a + n]) for a, n in zip(at, lens)], pa.int64())],
                    names=["doc_id", "part", "within", "n_tokens", "ids_crc32"])

    docs = arrow_map(files, decode, "doc_id long, part int, within long, n_tokens long, ids_crc32 long")
    return docs.join(F.broadcast(starts(files)), "part").select(  # a row a part: bounded by the partition count
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
