"""Packing documents into sequences: cutting stock by column generation.

A document's ids (its text's, then an end id) are cut into whole sequences and one rest. Rests are
counted by length, rounded up to a multiple of ``grain``: that histogram, ``capacity / grain`` numbers
whatever the size of the corpus, is all the driver sees. A linear program over patterns (how many
rests of each class fill one sequence) is solved by column generation: a knapsack dynamic program
finds the pattern that today's prices make cheapest, a simplex pivot takes it in, until none helps. Patterns
are rounded down, what is left over is packed greedily, and the result says of each class which
ranks go to which pattern. Documents are ranked within their class by task and place in the task,
so ranking needs a count per task and class and no sort; a hot length is just a large count.

Edge cases: a null or empty text is its end id alone; equal rows are documents of their own; an
empty table gives no rows. Rows are keyed by ``key``, which may repeat or be null. Other columns
aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded
from . import tokens
from .common import arrow_map, settle

GRAIN = 8
EPS = 1e-9
#: Pivots end when the bound on what they can still save is below this share of all sequences.
SLACK = 2e-4


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity: unbounded knapsack by DP."""
    worth = prices > EPS
    p, s = prices[worth], sizes[worth]
    value, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        fit = s <= room
        if fit.any():
            gain = np.where(fit, p + value[np.maximum(room - s, 0)], -1.0)
            j = int(gain.argmax())
            if gain[j] > value[room] + EPS:
                value[room], taken[room] = gain[j], j
    pattern, room, at = np.zeros(len(sizes)), capacity, np.flatnonzero(worth)
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[at[taken[room]]] += 1
            room -= s[taken[room]]
    return float(value[capacity]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, max_pivots: int = 20_000) -> list[tuple[np.ndarray, int]]:
    """(pattern, uses): together exactly ``demand`` of each size, in about the fewest sequences."""
    m = len(sizes)
    if not m:
        return []
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    dot = np.einsum  # small products; BLAS threads would only wait for each other on a busy driver
    uses = dot("ij,j->i", inverse, demand)
    for pivot in range(max_pivots):
        value, pattern = best_pattern(inverse.sum(0), sizes, capacity)  # every pattern costs one sequence
        if value <= 1 + 1e-7 or uses.sum() * (1 - 1 / value) < max(0.2, SLACK * uses.sum()):
            break  # no dual solution can save more than that
        step = dot("ij,j->i", inverse, pattern)
        ratio = np.full(m, np.inf)
        np.divide(uses, step, out=ratio, where=step > 1e-9)
        out = int(ratio.argmin())
        basis[:, out] = pattern
        inverse[out] /= step[out]
        rest = np.arange(m) != out
        inverse[rest] -= step[rest, None] * inverse[out]
        if pivot % 500 == 499:  # a Newton step against rounding
            inverse = 2 * inverse - dot("ij,jk->ik", inverse, dot("ij,jk->ik", basis, inverse))
        uses = np.maximum(dot("ij,j->i", inverse, demand), 0)
    plan, left = [], demand.astype(np.int64).copy()
    for j in np.argsort(-uses):
        pattern = basis[:, j].astype(np.int64)
        n = min(int(uses[j] + 1e-6), int((left[pattern > 0] // pattern[pattern > 0]).min()))
        if n > 0:
            plan.append((pattern, n))
            left -= n * pattern
    order = np.argsort(-sizes)
    while left.any():  # what rounding left: the largest first into one pattern, as often as it goes
        pattern, room = np.zeros(m, np.int64), capacity
        for j in order:
            pattern[j] = min(left[j], room // sizes[j])
            room -= pattern[j] * sizes[j]
        some = pattern > 0
        n = int((left[some] // pattern[some]).min())
        plan.append((pattern, n))
        left -= n * pattern
    return plan


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, grain: int, key: str, text: str,
              keep_ids: bool) -> DataFrame:
    """A row a piece, with its class (0: a whole sequence) and its rank among the task's of that class.

    ``ids`` has 16 bits an id where all ids of a piece fit, else 32.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, task = tokens.words(tokenizer, False), np.array([end_id], np.uint32), TaskContext.get().partitionId()
        ranks = np.zeros(capacity // grain + 2, np.int64)
        for batch in batches:
            rows: list[tuple] = []
            ks, ts = (c.to_pylist() for c in batch.columns)
            for k, ids in zip(ks, words.encode_all(t or "" for t in ts)):
                ids = np.concatenate([ids, end]).astype("<u4")
                for at in range(0, len(ids), capacity):
                    piece = ids[at:at + capacity]
                    c = 0 if len(piece) == capacity else -(-len(piece) // grain)
                    kept = None if not keep_ids else (piece.astype("<u2") if piece.max() < 1 << 16 else piece).tobytes()
                    rows.append((k, at, len(piece), zlib.crc32(piece.tobytes()), len(ids), task, c, int(ranks[c]), kept))
                    ranks[c] += 1
                if len(rows) >= (2_000 if keep_ids else 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64()), ("task", pa.int32()), ("class", pa.int32()), ("rank", pa.int64()),
                        ("ids", pa.binary())])
    spark_schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, class int, "
                    "rank long, ids binary")
    rows = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return arrow_map(rows, cut, spark_schema)


def slots_of(plan: list[tuple[np.ndarray, int]], classes: np.ndarray) -> tuple[dict[int, np.ndarray], int]:
    """For each class rows of (first rank, first sequence, rests a sequence, first slot), and all sequences."""
    slots: dict[int, list] = {int(c): [] for c in classes}
    taken = dict.fromkeys(slots, 0)
    sequence = 0
    for pattern, n in plan:
        slot = 0
        for c, a in zip(classes.tolist(), pattern.tolist()):
            if a:
                slots[c].append((taken[c], sequence, a, slot))
                taken[c] += n * a
                slot += a
        sequence += n
    return {c: np.array(r, np.int64) for c, r in slots.items()}, sequence


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, grain: int = GRAIN, key: str = "doc_id",
         text: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids: little-endian uint32).

    A row a piece; ``offset`` is the piece's place in its sequence, gapless from 0.
    """
    pieces = settle(pieces_of(docs, tokenizer, end_id, capacity, grain, key, text, keep_ids), "pieces")
    tally = pieces.groupBy("task", "class").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["class"]: r["n"] for r in tally.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    classes = np.array(sorted(c for c in histogram if c), np.int64)
    demand = np.array([histogram[c] for c in classes.tolist()], np.int64)
    slots, sequences = slots_of(solve(classes, demand, capacity // grain), classes)
    before = (tally.withColumn("base", F.sum("n").over(Window.partitionBy("class").orderBy("task")) - F.col("n"))
              .select("task", "class", "base"))
    ranked = (pieces.join(broadcast_if_bounded(before), ["task", "class"])  # so that ids move once, to their sequences
              .select(*[c for c in pieces.columns if c not in ("task", "rank")], (F.col("rank") + F.col("base")).alias("rank")))
    at = {c: i for i, c in enumerate(ranked.columns)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, rank = (batch.column(at[n]).to_numpy(zero_copy_only=False) for n in ("class", "rank"))
            sequence, slot = sequences + rank, np.zeros(len(rank), np.int64)
            for k in np.unique(c[c > 0]):
                own, rows = np.flatnonzero(c == k), slots[int(k)]
                first, start, each, offset = rows[np.searchsorted(rows[:, 0], rank[own], "right") - 1].T
                sequence[own] = start + (rank[own] - first) // each
                slot[own] = offset + (rank[own] - first) % each
            yield pa.RecordBatch.from_arrays(
                [batch.column(at[n]) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")]
                + [pa.array(sequence), pa.array(slot)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "slot"])

    placed = arrow_map(ranked, place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                      "ids binary, sequence_id long, slot long")
    order = Window.partitionBy("sequence_id").orderBy("slot")
    offset = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("length")
    out = placed.withColumn("offset", offset).drop("slot")
    return arrow_map(out, _wide_ids, out.schema) if keep_ids else out.drop("ids")


def _wide_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """32 bits an id, whatever the pieces were moved with."""
    for batch in batches:
        at = batch.schema.get_field_index("ids")
        wide = [np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4").tobytes()
                for raw, n in zip(batch.column(at).to_pylist(), batch.column("length").to_pylist())]
        yield batch.set_column(at, "ids", pa.array(wide, pa.binary()))


def sequences_of(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, doc_ids, ids: the packed sequences themselves (needs ``keep_ids``)."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return (packed.groupBy("sequence_id").agg(pieces.alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_tokens"),
                    F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
                    F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
