"""Benchmark decontamination: MinHash containment search, size by size, then exact containment.

Test items are short, documents are long, so a document's own MinHash says nothing of an item in
it. Items are partitioned by size (classes of doubling length, from one shingle); for each class the document
is seen through windows of two blocks of that length, so that any run holding the item lies within a
window of similar size. A window and an item of its class that share one of ``HASHES`` minima are
a candidate, and every candidate is verified by the exact share of the item's distinct shingles
(five words) that the whole document holds. A window holds at most twice its class's length and an item more than half
of it, so a whole item is missed with a chance of at most (3/4)**64, about 1e-8, and a passage in one piece with the
least allowed share with about 1e-5.

The items are what tasks receive, in blocks of at most ``block_bytes`` of text: a larger benchmark
takes further passes over the documents, with the same result. Documents aren't shuffled.

Edge cases: null, empty or wordless items and documents match nothing. An item of fewer than five
words is one shingle, its whole sequence, and so matches only documents that are that sequence. Null keys are keys
like others: such rows are searched and reported each. A very long text is searched in one piece, some 16 bytes a byte of it.
Repeated items count once, repeated documents each. Empty tables give no matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_slices
from .shingles import shingle_sets, shingles

THRESHOLD = 0.75
HASHES = 64
BLOCK_BYTES = 8 << 20
_rng = np.random.default_rng(7)
XOR = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
ODD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
MASK = np.uint64(0xFFFF)


def _hashed(x: np.ndarray, i: int) -> np.ndarray:
    y = (x ^ XOR[i]) * ODD[i]
    return y ^ (y >> np.uint64(32))


class Index:
    """MinHash signatures of items, by size class."""

    def __init__(self, texts: list[bytes]):
        self.sets = shingle_sets(texts) if texts else []
        sizes = np.array([len(s) for s in self.sets], np.int64)
        level = np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
        self.classes = []
        self.block = 1 << int(level[sizes > 0].min()) if (sizes > 0).any() else 1
        for g in np.unique(level[sizes > 0]):
            items = np.flatnonzero((level == g) & (sizes > 0))
            rows = []
            for i in range(HASHES):
                least = np.array([_hashed(self.sets[j], i).min() for j in items], np.uint64)
                order = np.argsort(least, kind="stable")
                seen = np.zeros(1 << 16, bool)
                seen[least & MASK] = True
                rows.append((least[order], items[order], seen))
            self.classes.append(((1 << int(g)) // self.block, rows))

    def search(self, texts: list[bytes], threshold: float) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared shingles) of every verified pair."""
        hashes, ends = shingles(texts)
        if not len(hashes) or not self.classes:
            return
        sizes = np.diff(ends, prepend=0)
        n_blocks = -(-sizes // self.block)
        block_ends = np.cumsum(n_blocks)
        owner = np.repeat(np.arange(len(texts)), n_blocks)
        nth = np.arange(len(owner)) - np.repeat(block_ends - n_blocks, n_blocks)
        first = np.repeat(ends - sizes, n_blocks) + nth * self.block
        heads = [np.flatnonzero(nth % span == 0) for span, _ in self.classes]
        pairs: set[tuple[int, int]] = set()
        for i in range(HASHES):
            blocks = np.minimum.reduceat(_hashed(hashes, i), first)
            for (span, rows), head in zip(self.classes, heads):
                least = np.minimum.reduceat(blocks, head) if span > 1 else blocks
                own = owner[head]
                least[:-1] = np.where(own[:-1] == own[1:], np.minimum(least[:-1], least[1:]), least[:-1])
                values, items, seen = rows[i]
                for w in np.flatnonzero(seen[least & MASK]):
                    a, b = np.searchsorted(values, least[w]), np.searchsorted(values, least[w], "right")
                    pairs.update((int(own[w]), int(j)) for j in items[a:b])
        last, found = -1, None
        for text, item in sorted(pairs):
            if text != last:
                last, found = text, np.unique(hashes[ends[text] - sizes[text]:ends[text]])
            wanted = self.sets[item]
            at = np.minimum(np.searchsorted(found, wanted), len(found) - 1)
            shared = int((found[at] == wanted).sum())
            if shared >= threshold * len(wanted):
                yield text, item, shared


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list]:
    """Distinct (item, text) rows, a bounded block at a time."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = int(-(-2 * size // block_bytes)) if size > block_bytes else 1
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b) if n > 1 else rows
        yield sorted(part.collect(), key=lambda r: (r["item"] is not None, r["item"], r["text"] or ""))


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every item that a document contains."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = [f"doc_id {rows.schema['doc_id'].dataType.simpleString()}",
              f"item_id {benchmark.schema[item].dataType.simpleString()}", "n_shingles long, n_shared long, containment double"]
    out = None
    for block in _blocks(benchmark, item, item_text, block_bytes):
        ids, texts = [r["item"] for r in block], [(r["text"] or "").encode() for r in block]

        def find(batches: Iterator[pa.RecordBatch], ids=ids, texts=texts) -> Iterator[pa.RecordBatch]:
            index = Index(texts)
            for batch in batches:
                at, items, shared = [], [], []
                for first, part in text_slices(batch.column(1)):
                    for t, j, n in index.search(part, threshold):
                        at.append(first + t)
                        items.append(ids[j])
                        shared.append((len(index.sets[j]), n))
                if at:
                    size, n = np.array(shared).T
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array(items), pa.array(size), pa.array(n), pa.array(n / size)],
                        names=["doc_id", "item_id", "n_shingles", "n_shared", "containment"])

        found = arrow_map(rows, find, ", ".join(schema))
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
          threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that contain no item, as they are."""
    at = docs.columns.index(text)
    for block in _blocks(benchmark, item, item_text, block_bytes):
        texts = [(r["text"] or "").encode() for r in block]

        def keep(batches: Iterator[pa.RecordBatch], texts=texts) -> Iterator[pa.RecordBatch]:
            index = Index(texts)
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for first, part in text_slices(batch.column(at)):
                    for t, _, _ in index.search(part, threshold):
                        good[first + t] = False
                yield batch.filter(pa.array(good))

        docs = arrow_map(docs, keep, docs.schema)
    return docs
