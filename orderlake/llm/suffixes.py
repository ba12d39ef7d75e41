"""Suffix-array dedup: repeated substrings across documents by merging shard Burrows-Wheeler transforms.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
key, judged on the input. Three steps keep this bounded:

1. Anchors. Every string of ``LENGTH`` bytes holds a ``GRAM``-byte gram with the least hash among its
   grams (winnowing), so two equal strings hold the same anchor at the same place. Anchors that only
   one text has are gone after one exchange of their hashes, counted once a task. The others are broadcast while
   they are at most ``LOOKED_FOR``; beyond it joins on the anchor, then on the text, give each text its own, so the
   texts are read a fixed number of times however many there are. Exact copies of a text are one text.
2. Merging. Around each shared anchor stands a context, all strings that may hold it. Distinct
   contexts are dealt by anchor, and those that share no long part with another one of theirs are left out (``met_again``);
   those of an anchor in more than ``CONTEXTS`` are dealt by longer parts that some of their strings hold, at last by whole
   strings, whose least keys Spark's aggregation finds. Each shard of them has its Burrows-Wheeler transform from its own suffix
   array; the transforms are merged by refining their interleave: a stable counting sort by the
   symbols before each suffix, two to ``STEP`` of them a step, deepens the order of all shards' suffixes at once. No suffix is
   compared or sorted again. Where neighbours part in a step, their common prefix ends there; after
   ``LENGTH`` symbols the unparted runs are the repeated intervals, and each takes its least key.
3. Removal. Occurrences look up the least keys of their context's strings; strings that an earlier document
   has are united into spans and cut out.

Edge cases: a null or empty text has nothing to remove; texts under ``LENGTH`` bytes are kept whole; a
null key counts as the smallest; rows with the same key never remove from each other. A cut may part a
UTF-8 character; ``bytes`` of the kept text are exact, as text the broken character is dropped. An empty table
gives no rows. A text longer than ``SLICE`` bytes is read in overlapping pieces, with the same result, so what a task computes
at a time is bounded; the text itself is held whole, as Spark hands it over. To the count of shared anchors its pieces are texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded
from .common import arrow_map, extended, free_name, hand_back, mix64, settle, settle_alone, text_slices, without
from .shingles import powers

LENGTH, GRAM = 50, 18
WINDOW = LENGTH - GRAM + 1  # grams in a string, and strings that may hold an anchor
CONTEXT = LENGTH + WINDOW - 1
#: Anchors in a bucket of their exchange; shared anchors that may be broadcast.
BUCKET, LOOKED_FOR = 1 << 21, 1 << 23
#: Anchors and contexts a task gathers before it counts them; contexts in a bucket and in a shard of it.
CHUNK, KEPT, CONTEXTS, SHARD = 1 << 20, 1 << 18, 1 << 14, 1 << 12
#: Bytes of text whose anchors a task computes at a time, in some twenty 8-byte numbers a byte; a longer text is read in
#: pieces of as many, each with the bytes beside it that decide its anchors and fill their contexts.
SLICE, MARGIN = 1 << 17, CONTEXT
#: Symbols that a step of the merge takes at most.
STEP = 5
#: Strings in a copy of a context whose anchor has too many of them: at each level fewer, at last one.
LEVELS = (17, 6, 1)
#: Neighbouring strings of a context of which another context of its anchor must hold the common part, or none is compared.
PART = 9
SYMBOL = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=np.uint64)
NOBODY = np.iinfo(np.int64).max


def _sliding(x: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """pick over x[i:i + n] for every i that has n."""
    out, have = x, 1
    while 2 * have <= n:
        out, have = pick(out[:-have], out[have:]), 2 * have
    return pick(out[:len(x) - n + 1], out[n - have:n - have + len(x) - n + 1]) if n > have else out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, text, place, anchor, context): all texts with ``LENGTH`` zeros around each, and for each anchor its
    text, its place in data, its gram's hash and its context's."""
    pad = bytes(LENGTH)
    data = np.frombuffer(pad + pad.join([t.replace(b"\x00", b"\xff") for t in texts]) + pad, np.uint8)  # 0xff is no UTF-8
    size = np.array([len(t) for t in texts], np.int64)
    begin = LENGTH + np.cumsum(size + LENGTH) - size - LENGTH
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(SYMBOL[data] * up[:-1], dtype=np.uint64)])
    grams = mix64((sums[GRAM:] - sums[:-GRAM]) * down[:len(sums) - GRAM])
    low = (grams >> np.uint64(32)).astype(np.uint32)
    least = _sliding(low, WINDOW, np.minimum)
    # A gram is an anchor if it is the least of some string that holds it.
    edge = np.zeros(WINDOW - 1, np.uint32)
    most = _sliding(np.concatenate([edge, least, edge]), WINDOW, np.maximum)
    place = np.flatnonzero(most == low)
    text = np.searchsorted(begin, place, "right") - 1
    inside = (text >= 0) & (size[text] >= LENGTH) & (place + GRAM <= begin[text] + size[text])
    text, place = text[inside], place[inside]
    return data, text, place, grams[place], begin


def anchored(column: pa.Array, limit: int) -> Iterator[tuple]:
    """(first row, where the first text read starts in its row's text, the texts read, *their ``anchors``) of about ``limit`` bytes at a
    time. A longer text comes in pieces; each anchor is in one of them, at least ``MARGIN`` bytes from where it was parted."""
    for first, raw in text_slices(column, limit):
        if len(raw) > 1 or len(raw[0]) <= limit:
            yield first, 0, raw, *anchors(raw)
            continue
        for a in range(0, len(raw[0]), limit):
            ahead = min(a, MARGIN)
            part = [raw[0][a - ahead:a + limit + MARGIN]]
            data, text, place, h, begin = anchors(part)
            own = (place - begin[0] >= ahead) & (place - begin[0] < ahead + limit)
            yield first, a - ahead, part, data, text[own], place[own], h[own], begin


def _identity(key: str, text: str) -> dict[str, Column]:
    """The key (null: the smallest) and two hashes of the text, by which a text is known."""
    raw = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return {"doc": F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long")), "one": F.xxhash64(raw),
            "two": F.xxhash64(F.lit("two"), raw)}


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    raw = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return docs.select(*[c.alias(n) for n, c in _identity(key, text).items()], raw.alias("raw"), F.octet_length(raw).cast("long").alias("n"))


def shared_anchors(texts: DataFrame, total: int) -> DataFrame:
    """(bucket, n, anchors): the hashes of the anchors that several texts have, distinct and sorted, a row a bucket."""
    bits = max(4, int(np.ceil(np.log2(max(total, 1) / 16 / BUCKET + 1))) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            cut = np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1))
            for b in np.flatnonzero(np.diff(cut)):
                own, k = h[cut[b]:cut[b + 1]], n[cut[b]:cut[b + 1]]
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([int(b)], pa.int32()), "once": [own[k == 1].tobytes()], "more": [own[k > 1].tobytes()]})

        for batch in batches:
            for _, _, _, _, text, _, h, _ in anchored(batch.column(0), SLICE):
                for own in np.split(h, np.flatnonzero(np.diff(text)) + 1):
                    held.append(np.unique(own))
                if sum(map(len, held)) >= CHUNK:
                    yield from flush()
                    held = []
                    hand_back()
        if held:
            yield from flush()

    def meet(group: pa.Table) -> pa.Table:
        hand_back()  # what the last group used
        once = np.sort(np.frombuffer(b"".join(group.column("once").to_pylist()), np.uint64))
        more = np.frombuffer(b"".join(group.column("more").to_pylist()), np.uint64)
        both = np.concatenate([once[1:][once[1:] == once[:-1]], more])
        both = np.unique(both)
        return pa.table({"bucket": pa.array([group.column("bucket")[0].as_py()], pa.int32()), "n": pa.array([len(both)], pa.int64()),
                         "anchors": pa.array([both.tobytes()], pa.binary())})

    rows = arrow_map(texts.select("raw"), count, "bucket int, once binary, more binary")
    return settle(rows.groupBy("bucket").applyInArrow(meet, "bucket int, n long, anchors binary"), "anchors")


def with_own(texts: DataFrame, met: DataFrame) -> DataFrame:
    """The texts that hold any shared anchor, with ``wanted``, the hashes of those that they hold."""
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, one = batch.column("doc").to_numpy(), batch.column("one").to_numpy()
            for first, _, _, _, text, _, h, _ in anchored(batch.column("raw"), SLICE):
                order = np.lexsort((h, text))
                text, h = text[order], h[order]
                fresh = (np.diff(text, prepend=-1) != 0) | (h != np.roll(h, 1))  # an anchor of a text once
                at = first + text[fresh]
                yield pa.RecordBatch.from_pydict({"anchor": pa.array(h[fresh].view(np.int64)), "doc": pa.array(doc[at]), "one": pa.array(one[at])})

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket in batch.column("anchors"):
                yield pa.RecordBatch.from_pydict({"anchor": pa.array(np.frombuffer(bucket.as_py(), np.int64))})

    shared = arrow_map(met.where("n > 0").select("anchors"), listed, "anchor long")
    of_text = (arrow_map(texts.select("doc", "raw", "one"), held, "anchor long, doc long, one long")
               .join(shared, "anchor", "left_semi").groupBy("doc", "one").agg(F.collect_set("anchor").alias("wanted")))
    return texts.join(of_text, ["doc", "one"])


def contexts(texts: DataFrame, met: DataFrame) -> DataFrame:
    """Rows of two kinds. An occurrence of a shared anchor: context (its hash), doc, one, at (place in the text). A
    distinct context of a task's chunk: anchor, context, bytes, the least doc and the occurrences it stands for."""
    known, fields = None, ["doc", "raw", "one"]
    if (met.agg(F.sum("n")).first()[0] or 0) <= LOOKED_FOR:
        buckets = met.where("n > 0").orderBy("bucket").select("anchors").collect()  # at most LOOKED_FOR hashes, 8 bytes each
        known = texts.sparkSession.sparkContext.broadcast(np.frombuffer(b"".join(r["anchors"] for r in buckets), np.uint64))
    else:
        texts, fields = with_own(texts, met), [*fields, "wanted"]
    names = ["anchor", "context", "doc", "one", "at", "bytes", "stands"]
    kinds = [pa.int64()] * 5 + [pa.binary(), pa.int64()]

    def rows(n: int, **given: np.ndarray | pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(given[c], k) if isinstance(given.get(c), np.ndarray) else
                                           given[c] if c in given else pa.nulls(n, k) for c, k in zip(names, kinds)], names=names)

    def distinct(held: list[tuple]) -> pa.RecordBatch:
        code, doc, h, stands, window = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((doc, code))
        head = np.flatnonzero(np.diff(code[order], prepend=~code[order[:1]]))
        n, first = np.add.reduceat(stands[order], head), order[head]
        raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(CONTEXT), len(first), [None, pa.py_buffer(window[first].tobytes())])
        return rows(len(first), anchor=h[first].view(np.int64), context=code[first].view(np.int64), doc=doc[first],
                    bytes=raw.cast(pa.binary()), stands=n)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        up = powers(CONTEXT)[0]
        for batch in batches:
            doc, one = batch.column("doc").to_numpy(), batch.column("one").to_numpy()
            for first, since, raw, data, text, place, h, begin in anchored(batch.column("raw"), SLICE):
                # An anchor is shared or not, whichever text it stands in.
                wanted = known.value if known else np.unique(batch.column("wanted").slice(first, len(raw)).flatten().to_numpy().view(np.uint64))
                if not len(wanted):
                    continue
                hit = wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h
                text, place, h = text[hit], place[hit], h[hit]
                if not len(h):
                    continue
                # Bytes beyond the text are zeros; so contexts at its ends differ from inner ones.
                ahead = place - (WINDOW - 1)
                window = np.lib.stride_tricks.sliding_window_view(data, CONTEXT)[ahead].copy()
                start, size = begin[text], np.array([len(r) for r in raw], np.int64)[text]
                edge = np.flatnonzero((ahead < start) | (ahead + CONTEXT > start + size))
                at = ahead[edge, None] + np.arange(CONTEXT)
                window[edge] *= (at >= start[edge, None]) & (at < (start + size)[edge, None])
                code = np.zeros(len(h), np.uint64)
                for k in range(CONTEXT):
                    code += SYMBOL[window[:, k]] * up[k]
                code, own = mix64(code ^ h), doc[first + text]
                yield rows(len(h), context=code.view(np.int64), doc=own, one=one[first + text], at=(place - start + since).astype(np.int64))
                order = np.lexsort((own, code))
                head = np.flatnonzero(np.diff(code[order], prepend=~code[order[:1]]))
                least = order[head]
                held.append((code[least], own[least], h[least], np.diff(np.append(head, len(order))), window[least]))
                if sum(len(x[0]) for x in held) >= KEPT:
                    yield distinct(held)
                    held = []
                    hand_back()
        if held:
            yield distinct(held)

    return arrow_map(texts.select(*fields), read, "anchor long, context long, doc long, one long, at long, bytes binary, stands long")


def shard_order(strings: np.ndarray) -> np.ndarray:
    """The suffix array of a shard: rotations of its rows (each with its end mark), sorted to 72 symbols."""
    m, width = strings.shape
    key = np.zeros((m, width), np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | np.roll(strings, -k, 1)
    bits = np.uint64(21)  # of a rank: a shard has at most ``SHARD`` rows
    for step in (8, 24):
        rank = np.unique(key, return_inverse=True)[1].reshape(m, width).astype(np.uint64)
        key = (rank << (bits + bits)) | (np.roll(rank, -step, 1) << bits) | np.roll(rank, -2 * step, 1)
    return np.argsort(key.ravel())  # ties hold the same symbols as far as any merge reads


def merge(shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, group) over all suffixes of the shards, numbered shard by shard: sorted by their first ``depth``
    symbols, ``group`` the runs that share them.

    ``shards`` are rows of symbols; the last column is the end mark, 0. A step takes as many symbols, at most ``STEP``, as make
    no more than 65,536 different strings.
    """
    key = np.concatenate(shards).astype(np.uint64)
    for k in range(1, STEP):
        key = (key << np.uint64(8)) | np.concatenate([np.roll(s, -k, 1) for s in shards])
    seen, code = np.unique(key, return_inverse=True)
    code, deep = code.reshape(key.shape), STEP
    while len(seen) > 1 << 16:
        seen, fewer = np.unique(seen >> np.uint64(8), return_inverse=True)
        code, deep = fewer[code], deep - 1
    code = code.astype(np.uint16)
    orders, before, first = [], [], []
    cuts = np.cumsum([0] + [len(s) for s in shards])
    rest = depth % deep
    short = np.unique(seen >> np.uint64(8 * (deep - rest)), return_inverse=True)[1].astype(np.uint16)
    for s, a, b in zip(shards, cuts[:-1], cuts[1:]):
        order = shard_order(s)
        orders.append(order)
        before.append(np.roll(code[a:b], deep, 1).ravel()[order])  # the transform: the symbols before each suffix
        first.append(np.roll(short[code[a:b]], rest, 1).ravel()[order])
    total = sum(map(len, orders))
    origin = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(o) for o in orders])
    group = np.zeros(total, np.int32)
    symbol = np.empty(total, np.uint16)
    for these in [first] * (rest > 0) + [before] * (depth // deep):
        for i, b in enumerate(these):
            symbol[origin == i] = b
        step = np.argsort(symbol, kind="stable")
        origin, group, parted = origin[step], group[step], symbol[step]
        fresh = np.concatenate([[False], (parted[1:] != parted[:-1]) | (group[1:] != group[:-1])])
        group = np.cumsum(fresh, dtype=np.int32)
    out, base = np.empty(total, np.int64), 0
    for i, order in enumerate(orders):
        out[origin == i] = order + base
        base += len(order)
    return out, group


def least_docs(window: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each context and each of its strings, the least doc that has the string; NOBODY where it leaves the text."""
    m = len(window)
    used = np.unique(window)
    used = used[used > 0]
    table = np.zeros(256, np.uint8)
    table[used] = np.arange(1, len(used) + 1)  # UTF-8 leaves byte values unused, so marks and symbols fit a byte
    rows = np.zeros((m, CONTEXT + 1), np.uint8)
    rows[:, :CONTEXT] = table[window]
    shards = [rows[i:i + SHARD] for i in range(0, m, SHARD)]
    order, group = merge(shards, LENGTH)
    place = order % (CONTEXT + 1)
    # A string is whole if its first and last byte lie in the text.
    whole = (place < WINDOW)
    order, group, place = order[whole], group[whole], place[whole]
    row = order // (CONTEXT + 1)
    inside = (rows[row, place] > 0) & (rows[row, place + LENGTH - 1] > 0)
    row, place, group = row[inside], place[inside], group[inside]
    out = np.full((m, WINDOW), NOBODY)
    if len(row):
        starts = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
        least = np.minimum.reduceat(doc[row], starts)
        out[row, place] = np.repeat(least, np.diff(np.append(starts, len(group))))
    return out


def met_again(anchor: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Contexts that may share a string with another one of their anchor.

    ``PART`` strings in a row have a part in common that any two equal ones among them share, gram and all; where no
    other context of the anchor holds such a part, no string of the context stands in another.
    """
    out = np.zeros(len(anchor), bool)
    up = powers(CONTEXT)[0]
    for low in range(0, WINDOW, PART):
        high = min(low + PART, WINDOW) - 1
        code = np.zeros(len(anchor), np.uint64)
        for k in range(high, low + LENGTH):
            code += SYMBOL[window[:, k]] * up[k]
        _, which, times = np.unique(mix64(code ^ mix64(anchor.view(np.uint64))), return_inverse=True, return_counts=True)
        out |= (times[which] > 1) & (window[:, high] > 0) & (window[:, low + LENGTH - 1] > 0)
    return out


def _runs(m: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(rows that have any, for each of those its runs (a, b, doc): strings a to b are first in doc)."""
    value = m.ravel()
    fresh = np.ones(m.shape, bool)
    fresh[:, 1:] = m[:, 1:] != m[:, :-1]
    start = np.flatnonzero(fresh)
    stop = np.append(start[1:], m.size) - 1
    good = value[start] != NOBODY
    start, stop = start[good], stop[good]
    rows, n = np.unique(start // WINDOW, return_counts=True)
    runs = pa.StructArray.from_arrays([pa.array((start % WINDOW).astype(np.int32)), pa.array((stop % WINDOW).astype(np.int32)),
                                       pa.array(value[start])], names=["a", "b", "doc"])
    return rows, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), runs)


def _met(rows: DataFrame, buckets: int) -> DataFrame:
    """(context, runs) of contexts whose anchors stand in no more than about ``CONTEXTS`` of them, a bucket a group."""
    def meet(group: pa.Table) -> pa.Table:
        hand_back()  # what the last group used
        anchor, context, doc, stands = (group.column(c).to_numpy() for c in ("anchor", "context", "doc", "stands"))
        order = np.lexsort((doc, anchor, context))
        a, c = anchor[order], context[order]
        head = np.flatnonzero(np.diff(c, prepend=~c[:1]) | np.diff(a, prepend=~a[:1]))
        n, first = np.add.reduceat(stands[order], head), order[head]
        window = np.frombuffer(b"".join(group.column("bytes").take(pa.array(first)).to_pylist()), np.uint8).reshape(-1, CONTEXT)
        anchor, context, doc = anchor[first], context[first], doc[first]
        m = np.where((window[:, :WINDOW] > 0) & (window[:, LENGTH - 1:] > 0), doc[:, None], NOBODY)
        several = np.flatnonzero(met_again(anchor, window))
        if len(several):
            m[several] = least_docs(window[several], doc[several])
        m[(n == 1) & ((m == doc[:, None]) | (m == NOBODY)).all(1)] = NOBODY  # held by that one place alone
        kept, runs = _runs(m)
        return pa.table({"context": pa.array(context[kept]), "runs": runs})

    return (rows.select("anchor", "context", "doc", "bytes", "stands")
            .groupBy(F.pmod(F.col("anchor"), F.lit(buckets)).alias("bucket"))
            .applyInArrow(meet, "context long, runs array<struct<a int, b int, doc long>>"))


def _crowded(rows: DataFrame, buckets: int) -> DataFrame | None:
    """The anchors in more than ``CONTEXTS`` rows, if any; they are counted only in cells that have as many."""
    cell, n = F.pmod(F.col("anchor"), F.lit(16 * buckets)), F.count(F.lit(1)).alias("n")
    full = settle(rows.groupBy(cell.alias("cell")).agg(n).where(F.col("n") > CONTEXTS).select("cell"), "cells")
    if full.isEmpty():
        return None
    counted = rows.select("anchor", cell.alias("cell")).join(broadcast_if_bounded(full), "cell").groupBy("anchor").agg(n)
    hot = settle(counted.where(F.col("n") > CONTEXTS).select("anchor"), "hot-anchors")
    return None if hot.isEmpty() else broadcast_if_bounded(hot)


def _copies(rows: DataFrame, width: int) -> DataFrame:
    """A copy of each context for every ``width`` of its strings, zeros beside them; its anchor is what they all hold."""
    zeros = f"X'{'00' * CONTEXT}'"
    parts = rows.selectExpr("context", "doc", "bytes", "stands", "hi AS last", f"explode(sequence(lo, hi, {width})) AS lo").selectExpr(
        "context", "doc", "bytes", "stands", "lo", f"least(lo + {width - 1}, last) AS hi")
    # Zeros stand at the ends alone, so a part that all strings hold is whole if its ends are.
    return parts.where(f"substring(bytes, hi + 1, 1) <> X'00' AND substring(bytes, lo + {LENGTH}, 1) <> X'00'").selectExpr(
        f"xxhash64(lo, substring(bytes, hi + 1, lo + {LENGTH} - hi)) AS anchor", "context", "doc",
        f"concat(substring({zeros}, 1, lo), substring(bytes, lo + 1, hi + {LENGTH} - lo), "
        f"substring({zeros}, 1, {WINDOW - 1} - hi)) AS bytes", "stands", "lo", "hi")


def _single(rows: DataFrame) -> DataFrame:
    """(context, runs) of copies that hold one string each: equal strings are reduced by grouped minima."""
    one = rows.selectExpr("context", "doc", "stands", "lo", f"substring(bytes, lo + 1, {LENGTH}) AS string")
    least = settle(one.groupBy("string").agg(F.min("doc").alias("first"), F.sum("stands").alias("n")).where("n > 1")
                   .select("string", "first"), "strings")
    runs = settle(one.join(broadcast_if_bounded(least), "string").where("first < doc OR stands > 1").select(
        "context", F.struct(F.col("lo").alias("a"), F.col("lo").alias("b"), F.col("first").alias("doc")).alias("run")), "runs")
    return runs.groupBy("context").agg(F.collect_list("run").alias("runs"))  # at most WINDOW a context


def first_holders(found: DataFrame) -> DataFrame:
    """(context, runs): for each distinct context the least doc that holds each of its strings.

    Contexts of an anchor in more than ``CONTEXTS`` are dealt by longer parts of their strings, level by level; a
    context then has a row a copy."""
    rows = found.where("bytes is not null").select("anchor", "context", "doc", "bytes", "stands")
    out = []
    for width in LEVELS:
        buckets = max(1, -(-rows.count() // CONTEXTS))
        hot = _crowded(rows, buckets)
        out.append(_met(rows if hot is None else rows.join(hot, "anchor", "left_anti"), buckets))
        if hot is None:
            break
        rows = rows.join(hot, "anchor")
        if width == LEVELS[0]:  # tasks' chunks repeat a context
            rows = (rows.groupBy("context").agg(F.min("doc").alias("doc"), F.first("bytes").alias("bytes"), F.sum("stands").alias("stands"))
                    .withColumns({"lo": F.lit(0), "hi": F.lit(WINDOW - 1)}))
        rows = settle(_copies(rows, width), f"copies-{width}")
    else:
        out.append(_single(rows))
    return reduce(DataFrame.unionByName, out)


def spans_of(found: DataFrame, holders: DataFrame) -> DataFrame:
    """(doc, one, span): runs of bytes of each text that strings of earlier documents cover, each start << 32 | end."""
    here = found.where("at is not null").select("context", "doc", "one", "at").join(holders, "context")
    start = F.col("at") - (WINDOW - 1)
    earlier = F.transform(F.filter("runs", lambda r: r["doc"] < F.col("doc")), lambda r: F.shiftleft(
        (start + r["a"]).cast("long"), 32).bitwiseOR((start + r["b"] + LENGTH).cast("long")))
    return here.select("doc", "one", F.explode(earlier).alias("span"))


def united(spans: DataFrame) -> DataFrame:
    """(doc, one, spans): the spans of each text, overlapping and touching ones made one."""
    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = batch.column("spans").flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("spans")).to_numpy())
            order = np.lexsort((value, row))
            value, row = value[order], row[order]
            s, e = value >> 32, value & 0xFFFFFFFF
            # The farthest end so far within the row: rows are lifted apart, then one running maximum serves all.
            far = np.maximum.accumulate((row << 33) + e) - (row << 33)
            fresh = np.ones(len(s), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (s[1:] > far[:-1])
            head = np.flatnonzero(fresh)
            last = np.append(head[1:], len(s)) - 1
            offsets = np.searchsorted(row[head], np.arange(batch.num_rows + 1))
            out = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array((s[head] << 32) | far[last]))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("one"), out], names=["doc", "one", "spans"])

    lists = spans.groupBy("doc", "one").agg(F.collect_list("span").alias("spans")).select("doc", "one", "spans")
    return arrow_map(lists, unite, "doc long, one long, spans array<bigint>")


def covered(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, one, spans): of each text that loses bytes, the runs of bytes that go."""
    texts = _texts(docs, key, text)
    thin = settle(texts.select("doc", "one", "two", "n"), "texts")
    classes = thin.groupBy("one", "two").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1")
    copies = settle(thin.join(classes, ["one", "two"]).where("doc > rep").select("doc", "one", "two", "n").distinct(), "copies")
    single = texts.join(broadcast_if_bounded(copies.select("doc", "one", "two")), ["doc", "one", "two"], "left_anti")
    total = thin.agg(F.sum("n")).first()[0] or 0
    spans = copies.where(F.col("n") >= LENGTH).select("doc", "one", F.col("n").alias("span"))  # a copy goes whole: 0 << 32 | n
    found = settle(contexts(single, shared_anchors(single, total)), "contexts")
    holders = settle(first_holders(found), "holders")
    return united(spans.unionByName(spans_of(found, holders)))


def dedupe(docs: DataFrame, key: str = "doc_id", text: str = "text", as_text: bool = True) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (longest removed runs), kept, the bytes that stay, and with ``as_text`` kept_text,
    the same as text."""
    new = ["n_bytes", "n_removed", "n_spans", "kept"] + ["kept_text"] * as_text
    docs = without(docs, new)
    doc, one, spans = (free_name(docs, n) for n in ("own_doc", "own_one", "own_spans"))
    gone = settle_alone(lambda: covered(docs, key, text), "spans").select(F.col("doc").alias(doc), F.col("one").alias(one), F.col("spans").alias(spans))
    gone = broadcast_if_bounded(gone, size=F.lit(64) + 8 * F.size(spans))
    identity = _identity(key, text)
    joined = docs.withColumns({doc: identity["doc"], one: identity["one"]}).join(gone, [doc, one], "left")
    rows = joined.select(*[f"`{c}`" for c in docs.columns], spans)
    at = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, runs, kept = [], [], [], []
            for raw, spans in zip(batch.column(at).cast(pa.binary()), batch.column(batch.num_columns - 1)):
                raw, whole = raw.as_py() or b"", [(x >> 32, x & 0xFFFFFFFF) for x in spans.as_py() or []]
                edges = [0, *[x for run in whole for x in run], len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                n.append(len(raw))
                removed.append(len(raw) - len(kept[-1]))
                runs.append(len(whole))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(runs, pa.int64()), pa.array(kept, pa.binary()),
                                              *([pa.array([k.decode(errors="ignore") for k in kept], pa.string())] if as_text else [])],
                                             names=[*batch.schema.names[:-1], *new])

    return arrow_map(rows, cut, extended(docs, "n_bytes long, n_removed long, n_spans long, kept binary" + ", kept_text string" * as_text))
