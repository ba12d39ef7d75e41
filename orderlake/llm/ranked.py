"""Ranked lexical search with pair-bound MaxScore.

Documents are indexed in shards of consecutive rows, each with inverted lists of its own, so that no list is ever
shuffled and none grows with the corpus. Three passes:

1. ``postings`` reads every whole text once. A shard holds about ``SHARD_BYTES`` of text (or one longer text):
   the keys of its documents, their lengths, and for every term of the queries the documents that hold it, with counts.
   Document frequencies and lengths over all documents come from sums over the shards.
2. ``impacts`` turns counts into integer scores, since weights are known now. It stores each term's largest score in the
   shard, and for pairs of terms of one query the intersection list: the documents with both, and the largest sum of both.
   From these lists alone come scores that documents reach at least; counted by size over all shards they give every
   query a threshold that its 50th best document certainly reaches.
3. ``best`` searches the shards. A document can get from a pair no more than the larger of either term's largest score and
   the pair's joint largest score; that is less than the sum of both wherever the best documents of one term lack the other. Pairs are
   sorted by this bound. Those whose bounds together stay below the threshold are not essential: only documents in the
   lists of the others are looked at, the rest of the lists is probed for the candidates still able to reach the
   threshold, and a shard whose bounds all together stay below it is skipped. Each task keeps the best k of a query and raises
   its threshold; Spark merges the tasks' lists.

All scores are 64-bit integers, so bounds are exact: a document is left out only if its score is below that of k others.

What tasks receive is a block of queries (at most ``block_bytes`` of text); more queries take further passes with the
same result. Terms: ASCII letters (A-Z lower-cased), digits and all other code points from U+0080 on.

Edge cases: null, empty and termless documents and queries match nothing; of equal scores the lesser key goes first, a
null key last; repeated documents rank each on their own; a query repeated with the same id and text counts once. Extra
columns are not read. Empty tables give no rows. A very long text is a shard of its own; its terms are counted at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, settle
from .decontaminate import BLOCK_BYTES, _blocks

SHARD_BYTES = 16 << 20
#: Sizes of scores are told apart by this many steps to a doubling.
STEPS = 16
THRESHOLDS = np.array([0] + sorted({math.ceil(2 ** (i / STEPS)) for i in range(60 * STEPS)}), np.int64)
_FOLD = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """All terms of a text, in order."""
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The part of a term's score that does not depend on the term."""
    m = 50 + (50 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Queries:
    """The terms of a block of queries, numbered."""

    def __init__(self, texts: list[bytes]):
        self.number: dict[bytes, int] = {}
        self.terms = [np.array([self.number.setdefault(t, len(self.number)) for t in dict.fromkeys(terms(x))], np.int64) for x in texts]


class Plan:
    """Weights of terms, and for every query its pairs and single terms (a partner of -1)."""

    def __init__(self, queries: Queries, df: dict[int, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array([weight(n_docs, df[t]) if t in df else 0 for t in range(len(queries.number))], np.int64)
        self.pair_number: dict[tuple[int, int], int] = {}
        self.groups = []
        for own in queries.terms:
            # The heaviest terms meet each other: documents that hold both are few.
            own = sorted((int(t) for t in own if self.weight[t] > 0), key=lambda t: (-self.weight[t], t))
            pairs = [tuple(sorted(own[i:i + 2])) for i in range(0, len(own) - 1, 2)]
            rows = [(a, b, self.pair_number.setdefault((a, b), len(self.pair_number))) for a, b in pairs]
            if len(own) % 2:
                rows.append((own[-1], -1, -1))
            self.groups.append(np.array(rows, np.int64).reshape(-1, 3))
        self.pairs = np.array(list(self.pair_number), np.int64).reshape(-1, 2)


_POSTINGS = "n array<int>, term array<int>, ends array<int>, doc array<int>, tf array<int>"


def postings(docs: DataFrame, queries: Queries, key: str, text: str) -> DataFrame:
    """The index's shards: keys, lengths, and the lists (term, end of its list, documents, counts)."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    number = queries.number

    def shard(keys: list[pa.Array], n: list[int], ids: list[np.ndarray]) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        both, tf = np.unique((np.concatenate(ids) << 32) | owner, return_counts=True)
        term = both >> 32
        own, first = np.unique(term, return_index=True)
        lists = [n, own, np.append(first[1:], len(term)) if len(own) else first, both & 0xFFFFFFFF, tf]
        key_row = pa.concat_arrays(keys)
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(key_row)], pa.int32()), key_row)]
            + [pa.array([np.asarray(x, np.int32)], pa.list_(pa.int32())) for x in lists],
            names=["keys", "n", "term", "ends", "doc", "tf"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, ids, size, get = [], [], [], 0, number.get
        for batch in batches:
            first = 0
            for i, value in enumerate(batch.column(1).cast(pa.binary())):
                raw = value.as_py() or b""
                own = terms(raw)
                n.append(len(own))
                ids.append(np.array([x for x in map(get, own) if x is not None], np.int64))
                size += len(raw)
                if size >= SHARD_BYTES:
                    keys.append(batch.column(0).slice(first, i + 1 - first))
                    yield shard(keys, n, ids)
                    keys, n, ids, size, first = [], [], [], 0, i + 1
            if first < batch.num_rows:
                keys.append(batch.column(0).slice(first))
        if n:
            yield shard(keys, n, ids)

    return arrow_map(rows, task, f"keys array<{kind}>, {_POSTINGS}")


def _statistics(shards: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, terms of all documents, and documents a term (a row a term of the block)."""
    n = F.transform("n", lambda x: x.cast("long"))
    total = shards.agg(F.sum(F.size(F.filter("n", lambda x: x > 0))).alias("docs"),
                       F.sum(F.aggregate(n, F.lit(0).cast("long"), lambda a, x: a + x)).alias("terms")).first()
    sizes = F.transform("ends", lambda e, i: F.struct(F.col("term")[i].alias("t"), (e - F.when(i > 0, F.get("ends", i - 1)).otherwise(0)).alias("n")))
    df = shards.select(F.inline(sizes)).groupBy("t").agg(F.sum("n").alias("n"))
    return int(total["docs"] or 0), int(total["terms"] or 0), {r.t: r.n for r in df.collect()}


def _list(shard: dict[str, np.ndarray], at: int) -> slice:
    return slice(shard["ends"][at - 1] if at else 0, shard["ends"][at])


def _arrays(batch: pa.RecordBatch, row: int) -> dict[str, np.ndarray]:
    return {name: batch.column(name)[row].values.to_numpy(zero_copy_only=False) for name in batch.schema.names if name != "keys"}


def _step_of(scores: np.ndarray) -> np.ndarray:
    """The number of the last threshold that a score reaches."""
    return np.searchsorted(THRESHOLDS, scores, "right") - 1


def impacts(shards: DataFrame, plan: Plan, k: int) -> DataFrame:
    """Shards with scores instead of counts, largest scores, the pairs' intersection lists, and how many documents
    certainly reach which threshold (query, step, count)."""
    kind = shards.schema["keys"].dataType.simpleString()
    names = ["term", "ends", "doc", "impact", "most", "pair", "pair_ends", "pair_doc", "pair_sum", "pair_most", "query", "step", "count"]
    types = dict.fromkeys(names, "int") | dict.fromkeys(["most", "pair_sum", "pair_most"], "long")

    def convert(shard: dict[str, np.ndarray]) -> list[np.ndarray]:
        term, doc, ends = shard["term"], shard["doc"], shard["ends"]
        n = shard["n"].astype(np.int64)
        made = impact(shard["tf"].astype(np.int64), n[doc], plan.n_docs, plan.n_terms) if len(doc) else np.zeros(0, np.int64)
        score = made * np.repeat(plan.weight[term], np.diff(ends, prepend=0))
        most = np.maximum.reduceat(score, ends - np.diff(ends, prepend=0)) if len(term) else np.zeros(0, np.int64)
        place = np.full(len(plan.weight) + 1, -1)
        place[term] = np.arange(len(term))
        slot = np.full(len(n), -1)
        pair, pair_doc, pair_sum = [], [], []
        for number in np.flatnonzero((place[plan.pairs] >= 0).all(axis=1)):
            a, b = (_list(shard, place[t]) for t in plan.pairs[number])
            slot[doc[a]] = np.arange(a.start, a.stop)
            mate = slot[doc[b]]
            slot[doc[a]] = -1
            common = mate >= 0
            if common.any():
                pair.append(number)
                pair_doc.append(doc[b][common])
                pair_sum.append(score[b][common] + score[mate[common]])
        seen = {p: i for i, p in enumerate(pair)}
        query, step, count = [], [], []
        for q, groups in enumerate(plan.groups):
            own = [seen[p] for p in groups[:, 2] if p in seen]
            if own:
                docs = np.concatenate([pair_doc[i] for i in own])
                reached = np.bincount(docs, np.concatenate([pair_sum[i] for i in own]))  # sums below 2**53: exact
                reached = np.sort(reached[reached > 0].astype(np.int64))[-k:]
                steps, times = np.unique(_step_of(reached), return_counts=True)
                query.append(np.full(len(steps), q)), step.append(steps), count.append(times)
        flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return [term, ends, doc, made, most, np.array(pair), np.cumsum([len(x) for x in pair_doc]), flat(pair_doc), flat(pair_sum),
                np.array([x.max() for x in pair_sum]), flat(query), flat(step), flat(count)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                made = convert(_arrays(batch, row))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1)] + [pa.array([np.asarray(x, np.int64 if types[c] == "long" else np.int32)],
                                                                pa.list_(pa.int64() if types[c] == "long" else pa.int32())) for c, x in zip(names, made)],
                    names=["keys", *names])

    return arrow_map(shards, task, f"keys {kind}, " + ", ".join(f"{c} array<{types[c]}>" for c in names))


def _floors(index: DataFrame, n_queries: int, k: int) -> np.ndarray:
    """For every query a score that at least k documents reach (1 where that is not known)."""
    counts = index.select(F.inline(F.arrays_zip("query", "step", "count"))).groupBy("query", "step").agg(F.sum("count").alias("count"))
    down = Window.partitionBy("query").orderBy(F.desc("step"))  # a row a step, at most a few hundred
    reach = counts.withColumn("n", F.sum("count").over(down)).where(F.col("n") >= k).groupBy("query").agg(F.max("step").alias("step"))
    out = np.ones(n_queries, np.int64)
    for r in reach.collect():  # a row a query of the block
        out[r.query] = max(1, int(THRESHOLDS[r.step]))
    return out


class Searcher:
    """MaxScore over one shard at a time, with the best k of each query so far."""

    def __init__(self, plan: Plan, floors: np.ndarray, k: int):
        self.plan, self.floor, self.k = plan, floors.copy(), k
        self.best: list[list[tuple[int, bool, object]]] = [[] for _ in plan.groups]  # (-score, key is null, key)

    def search(self, shard: dict[str, np.ndarray], keys: pa.Array) -> None:
        plan = self.plan
        place = np.full(len(plan.weight) + 1, -1)  # the last place is that of a missing partner
        place[shard["term"]] = np.arange(len(shard["term"]))
        most = np.append(shard["most"], 0)
        joint = np.zeros(len(plan.pairs) + 1, np.int64)
        joint[shard["pair"]] = shard["pair_most"]
        for q, groups in enumerate(plan.groups):
            bound = np.maximum(np.maximum(most[place[groups[:, 0]]], most[place[groups[:, 1]]]), joint[groups[:, 2]])
            order = np.argsort(bound, kind="stable")
            below = np.cumsum(bound[order])  # what a document can get from this group and those before it
            floor = self.floor[q]
            if not len(order) or below[-1] < floor:
                continue
            essential = int(np.searchsorted(below, floor))
            self._collect(q, shard, keys, place, groups[order], below, essential)

    def _collect(self, q: int, shard: dict, keys: pa.Array, place: np.ndarray, groups: np.ndarray, below: np.ndarray, essential: int) -> None:
        floor, doc = self.floor[q], shard["doc"]
        score = np.zeros(len(keys), np.int64)
        for t in groups[essential:, :2].ravel():
            if t >= 0 and place[t] >= 0:
                own = _list(shard, place[t])
                score[doc[own]] += self.plan.weight[t] * shard["impact"][own].astype(np.int64)
        left = below[essential - 1] if essential else 0
        found = np.flatnonzero((score > 0) & (score + left >= floor))
        for g in range(essential - 1, -1, -1):
            for t in groups[g, :2]:
                if t >= 0 and place[t] >= 0 and len(found):
                    own = _list(shard, place[t])
                    at = np.searchsorted(doc[own], found)  # lists are in order of documents
                    at[at == own.stop - own.start] = 0
                    hit = doc[own][at] == found
                    score[found[hit]] += self.plan.weight[t] * shard["impact"][own][at[hit]].astype(np.int64)
            left = below[g - 1] if g else 0
            found = found[score[found] + left >= floor]
        if not len(found):
            return
        if len(found) > self.k:  # more than k: those below the k-th score can't be among the best
            found = found[score[found] >= np.partition(score[found], -self.k)[-self.k]]
        named = [(-int(s), x is None, x) for s, x in zip(score[found], keys.take(pa.array(found)).to_pylist())]
        self.best[q] = sorted(self.best[q] + named, key=lambda r: r[:2] if r[1] else r)[:self.k]
        if len(self.best[q]) == self.k:
            self.floor[q] = max(self.floor[q], -self.best[q][-1][0])


def best(index: DataFrame, plan: Plan, floors: np.ndarray, k: int) -> DataFrame:
    """(query, key, score): each task's best k documents of every query."""
    kind = index.schema["keys"].dataType.elementType.simpleString()
    needed = ["keys", "term", "ends", "doc", "impact", "most", "pair", "pair_most"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher, key_type = Searcher(plan, floors, k), None
        for batch in batches:
            key_type = batch.schema.field("keys").type.value_type
            for row in range(batch.num_rows):
                searcher.search(_arrays(batch, row), batch.column("keys")[row].values)
        found = [(q, r[2], -r[0]) for q, rows in enumerate(searcher.best) for r in rows]
        if found:
            query, key, score = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(key, key_type), pa.array(score, pa.int64())],
                                             names=["query", "key", "score"])

    return arrow_map(index.select(*needed), task, f"query int, key {kind}, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every query with a score above 0."""
    spark, kind = docs.sparkSession, queries.schema[item].dataType.simpleString()
    out = None
    for block in _blocks(queries, item, item_text, block_bytes):
        asked = Queries([(r["text"] or "").encode() for r in block])
        shards = settle(postings(docs, asked, key, text), "search-postings")
        n_docs, n_terms, df = _statistics(shards)
        plan = Plan(asked, df, n_docs, n_terms)
        index = settle(impacts(shards, plan, k), "search-index")
        found = best(index, plan, _floors(index, len(block), k), k)
        first = Window.partitionBy("query").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
        named = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(block)], f"query int, item_id {kind}")
        part = ranked.join(F.broadcast(named), "query").select("item_id", "rank", F.col("key").alias("doc_id"), "score")
        out = part if out is None else out.unionByName(part)
    return out
