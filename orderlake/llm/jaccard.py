"""N-gram Jaccard join: sets of word shingles, joined size-aware by a light and a heavy method.

Documents with the same set form a class; classes are joined. Two sets link when the Jaccard similarity
of their five-word shingles is at least ``PERCENT`` per cent.

* Light: for two small sets of sizes a <= b, linking means sharing some subset of exactly
  ``needed(a, b)`` shingles. Each small set enumerates those subsets; equal subsets link without a check.
* Heavy: for the others, sets that link share a shingle among the first ``prefix(n)`` of each in one
  global order. Those shingles make inverted lists. Shingles that many sets hold come last in
  the order, so that lists are short. Each list is scanned against its least member first; what that leaves
  in different components is then compared within lists, the smaller parts with the rest, where the places of
  the shingle in both sets leave room for enough others. Every
  pair is verified by the exact size of the intersection.

The boundary is the size where both methods together cost least, by the histogram of small sizes.
Pairs across it are the heavy method's, which takes sets down to what can link with a larger one.

No pair within a component that is already known is ever made. Lists are rows, reduced by grouped minima and
joined by keys, so a shingle or a group of copies with a third of all rows is pre-aggregated or split.

Edge cases: null, empty and wordless texts have an empty set and link with nothing, not even each
other. Repeated rows have one class. A null key keeps its row; it names a component only if no
other key does. An empty table gives no rows. Further columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded
from .common import arrow_map, free_name, mix64, settle, settle_alone, ship, text_slices
from .components import connected_components
from .shingles import shingle_sets

PERCENT = 75
#: Sizes from which the boundary is chosen; sets up to it keep their shingles with the class.
LIGHT_MOST = 12
#: A shingle in more sets than this, of a chunk of ``CHUNK`` shingles in a task, comes late in the order.
OFTEN, CHUNK = 1, 1 << 22
#: Shingles that the order knows as frequent, the most frequent ones: 16 bytes each in every task.
OFTEN_MOST = 1 << 21
#: Postings of a shingle that one task takes; a longer list is dealt over shares.
LIST_MOST = 1 << 16
#: Bytes of text whose shingles a task computes at a time.
SLICE = 1 << 20
#: Shingles for each counter of a set's summary.
LOAD = 2


def needed(a: int, b: int) -> int:
    """Shingles that sets of a and b must share to link: 100 * i >= PERCENT * (a + b - i)."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def prefix(n: int) -> int:
    """Of n ordered shingles, those among which a linking set must share one."""
    return n - -(-PERCENT * n // 100) + 1


def partners(n: int, most: int) -> range:
    """Sizes up to ``most`` that can link with n."""
    return range(max(1, -(-PERCENT * n // 100)), min(most, 100 * n // PERCENT) + 1)


def subset_cost(n: int, most: int) -> int:
    return sum(comb(n, needed(n, m)) for m in partners(n, most) if needed(n, m) <= min(n, m))


def boundary(sizes: dict[int, int]) -> int:
    """The largest light size; ``sizes`` has the number of sets by size up to what light sizes can meet."""
    def cost(most: int) -> float:
        light = sum(c * subset_cost(n, most) for n, c in sizes.items() if n <= most)
        return light + sum(c * (prefix(n) + n) for n, c in sizes.items() if PERCENT * (most + 1) <= 100 * n)
    return min(range(LIGHT_MOST + 1), key=cost)


def _class_of(tokens: np.ndarray) -> int:
    total = mix64(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix64(np.array([total], np.uint64)).view(np.int64)[0])


def _summary(tokens: np.ndarray) -> bytes:
    """Counts of the shingles in a power of two of buckets: the minima of two sets' counts bound their intersection."""
    bits = max(0, int(np.ceil(np.log2(max(len(tokens), 1) / LOAD))))
    counts = np.bincount((mix64(tokens) & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""  # without a summary nothing is ruled out


def _most_shared(x: bytes, y: bytes, n: int) -> int:
    """The largest intersection that two summaries allow; ``n`` where one is missing."""
    if not x or not y:
        return n
    a, b = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    width = min(len(a), len(b))
    return int(np.minimum(a.reshape(-1, width).sum(0), b.reshape(-1, width).sum(0)).sum())


def _docs(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.xxhash64(F.col(text).cast("string")).alias("mark"))


def sets_of(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: a document (doc_id, mark, n, class, small: its shingles if few), or a frequent shingle (token, n)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[np.ndarray] = []
        held = 0

        def frequent() -> pa.RecordBatch:
            tokens = np.concatenate(chunk)
            chunk.clear()
            tokens.sort()
            head = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            tokens, n = tokens[head], np.diff(np.append(head, len(tokens)))
            often = n > OFTEN
            none = pa.nulls(int(often.sum()), pa.int64())
            return pa.RecordBatch.from_arrays([none, pa.array(n[often]), none, pa.nulls(len(none), pa.binary()),
                                               pa.array(tokens[often].view(np.int64)), none, pa.nulls(len(none), pa.binary())], names=names)

        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE):
                found = shingle_sets(texts)
                ids = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([len(s) for s in found], pa.int64()), pa.array([_class_of(s) for s in found], pa.int64()),
                    pa.array([s.tobytes() if len(s) <= LIGHT_MOST else None for s in found], pa.binary()),
                    pa.nulls(len(found), pa.int64()), batch.column(2).slice(first, len(texts)),
                    pa.array([_summary(s) for s in found], pa.binary())], names=names)
                chunk += found
                held += sum(map(len, found))
                if held >= CHUNK:
                    yield frequent()
                    held = 0
        if held:
            yield frequent()

    names = ["doc_id", "n", "class", "small", "token", "mark", "summary"]
    return arrow_map(docs, read, "doc_id long, n long, class long, small binary, token long, mark long, summary binary")


def light_links(classes: DataFrame, most: int) -> DataFrame:
    """(a, b): links among sets of at most ``most`` shingles; sets that share a subset link to one of them."""
    def enumerate_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for c, n, raw in zip(*(col.to_pylist() for col in batch.columns)):
                tokens = mix64(np.frombuffer(raw, np.uint64) ^ np.uint64(0x5EED))
                for m in partners(n, most):
                    size = needed(n, m)
                    if size > min(n, m):
                        continue
                    own = np.array(list(combinations(range(n), size)))
                    tag = np.uint64(min(n, m) * 64 + max(n, m))
                    keys = mix64(tokens[own].sum(1, dtype=np.uint64) ^ (tag << np.uint64(40))).view(np.int64)
                    out += [(k, min(n, m), n, c) for k in keys.tolist()]
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["key", "least", "n", "class"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["key", "least", "n", "class"])

    small = classes.where((F.col("n") > 0) & (F.col("n") <= most)).select("class", "n", "small")
    rows = arrow_map(small, enumerate_, "key long, least long, n long, class long")
    # Sets of the smaller size that share the subset link with all others that do, so one stands for them.
    heads = (rows.groupBy("key").agg(F.min(F.when(F.col("n") == F.col("least"), F.col("class"))).alias("a"),
                                     F.min("class").alias("low"), F.max("class").alias("high"))
             .where("a is not null and low <> high").select("key", "a"))
    return rows.join(heads, "key").where("class <> a").select("a", F.col("class").alias("b")).distinct()


def postings(docs: DataFrame, often: tuple[np.ndarray, np.ndarray], least: int) -> DataFrame:
    """(token, share, class, size, spot): the prefix shingles of every set of at least ``least``. ``size`` holds the set's
    shingles that aren't frequent and all its shingles, ``spot`` the shingle's place in the set's order and its number of
    shares (each two 32-bit numbers). In the order frequent ones come last, by their counts. ``often`` has those
    shingles, ascending, and the counts; a list longer than ``LIST_MOST`` is dealt over shares by class."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(often)  # at most OFTEN_MOST shingles

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = sent.value
        for batch in batches:
            for _, texts in text_slices(batch.column(1), SLICE):
                rows, seen = [], set()
                for s in shingle_sets(texts):
                    if len(s) < least or not len(s):
                        continue
                    c = _class_of(s)
                    if c in seen:
                        continue
                    seen.add(c)
                    k = prefix(len(s))
                    first, seldom, rare = s, np.zeros(len(s), np.int64), len(s)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        seldom = np.where(known[at] == s, times[at], 0)
                        order = np.argsort(seldom, kind="stable")
                        first, seldom, rare = s[order], seldom[order], int((seldom == 0).sum())
                    shares = np.maximum(1, -(-seldom[:k] // LIST_MOST))
                    rows.append((first[:k], (c & 0x7FFFFFFF) % shares, np.full(k, c), np.full(k, rare << 32 | len(s)),
                                 np.arange(1, k + 1) << 32 | shares))
                if rows:
                    token, share, *more = (np.concatenate(x) for x in zip(*rows))
                    yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(share.astype(np.int32))] + [pa.array(x) for x in more],
                                                     names=["token", "share", "class", "size", "spot"])

    return arrow_map(docs, read, "token long not null, share int not null, class long not null, size long not null, spot long not null")


def listed(rows: DataFrame) -> DataFrame:
    """(token, class, n, pos, head): the postings that several sets share; a list's head is the member with the fewest
    shingles of its own, which stands nearest to the others.

    Postings are shuffled once: heads and lists are read from the same exchange (both need all its columns). A share's
    head is final where the list has one share; the others' few heads meet in a second, small grouping.
    """
    low = "4294967295"
    dealt = rows.repartition("token", "share")
    first = dealt.groupBy("token", "share").agg(F.min(F.struct("size", "class")).alias("head"), F.min("class").alias("low"),
                                                F.max("class").alias("high"), F.max(F.expr(f"spot & {low}")).alias("shares"))
    whole = first.where("shares = 1 and low <> high").select("token", "share", F.col("head.class").alias("head"))
    split = (first.where("shares > 1").groupBy("token").agg(F.min("head").alias("head"), F.min("low").alias("low"), F.max("high").alias("high"),
                                                            F.max("shares").alias("shares")).where("low <> high")
             .select("token", F.explode(F.expr("sequence(0, cast(shares as int) - 1)")).alias("share"), F.col("head.class").alias("head")))
    return dealt.join(whole.unionByName(split), ["token", "share"]).select(
        "token", "class", F.expr(f"cast(size & {low} as int)").alias("n"), F.expr("cast(shiftright(spot, 32) as int)").alias("pos"), "head")


def _fits(n: str, pos: str, m: str, other: str) -> str:
    """SQL: sets of n and m shingles can link, if the shingle at these places is the first that they share."""
    return f"{PERCENT} * ({n} + {m}) <= {100 + PERCENT} * (1 + least({n} - {pos}, {m} - {other}))"


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that the sets' summaries don't rule out."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (n, x, m, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2, 6)))):
                good[i] = _most_shared(x, y, min(n, m)) >= needed(n, m)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    for side, (n, x) in (("a", ("n", "x")), ("b", ("m", "y"))):
        pairs = pairs.join(classes.select(F.col("class").alias(side), F.col("n").alias(n), F.col("summary").alias(x)), side)
    return arrow_map(pairs.select("a", "b", "n", "x", "m", "y"), check, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` (settled) that link, by the exact intersection of their sets."""
    pairs = settle(plausible(pairs, classes), "plausible")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    keys = settle(wanted.join(classes.select("class", F.col("rep").alias("_rep"), F.col("rep_mark").alias("_mark"), "n"), "class"), "wanted")
    same = F.col("doc_id").eqNullSafe(F.col("_rep")) & F.col("mark").eqNullSafe(F.col("_mark"))
    texts = docs.join(broadcast_if_bounded(keys), same).select("doc_id", "text", "class", "n")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, size = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for first, texts in text_slices(batch.column(1), SLICE):
                got = [(own[first + i], s) for i, s in enumerate(shingle_sets(texts))
                       if len(s) == size[first + i] and _class_of(s) == own[first + i]]
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in got], pa.int64()),
                                                  pa.array([s.tobytes() for _, s in got], pa.binary())], names=["class", "tokens"])

    # Rows with the same key and text have one set; the class takes one of them.
    sets = settle(arrow_map(texts, read, "class long, tokens binary").dropDuplicates(["class"]), "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = 100 * both >= PERCENT * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    left = pairs.join(sets.select(F.col("class").alias("a"), F.col("tokens").alias("x")), "a")
    full = left.join(sets.select(F.col("class").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y")
    return arrow_map(full, check, "a long, b long")


def heavy_links(docs: DataFrame, classes: DataFrame, often: tuple[np.ndarray, np.ndarray], least: int, known: DataFrame) -> DataFrame:
    """(a, b): verified links between sets of at least ``least`` shingles, enough of them to connect
    every component together with the links ``known``."""
    lists = settle(listed(postings(docs, often, least)).distinct(), "lists")  # shingles of one set alone are gone
    star = settle(lists.where("class <> head").select(F.least("head", "class").alias("a"), F.greatest("head", "class").alias("b")).distinct(), "star-pairs")
    found = settle_alone(lambda: verified(star, docs, classes), "star-links")
    groups = settle(connected_components(found.unionByName(known)), "star-groups").withColumnRenamed("node", "class")
    # What each list still holds of different components: its largest part against none, the others against all.
    member = settle(lists.select("token", "class", "n", "pos").join(groups, "class", "left")
                    .withColumn("component", F.coalesce("component", "class")), "members")
    parts = member.groupBy("token", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = (parts.groupBy("token").agg(F.max(F.struct("size", "component")).alias("top"), F.count(F.lit(1)).alias("parts"))
               .where("parts > 1").select("token", F.col("top.component").alias("top")))
    minor = member.join(largest, "token").where("component <> top").select(
        "token", F.col("class").alias("c"), F.col("n").alias("m"), F.col("pos").alias("at"), F.col("component").alias("other"))
    # Members alike in size and place are judged together first: a list of which no two places can meet makes no pairs.
    span = [F.min("component").alias("from"), F.max("component").alias("to")]
    kinds = minor.withColumnRenamed("other", "component").groupBy("token", "m", "at").agg(*span)
    places = member.join(largest.select("token"), "token").groupBy("token", "n", "pos").agg(*[x.alias(f"{n}_") for x, n in zip(span, ("from", "to"))])
    meet = settle(kinds.join(places, "token").where(_fits("n", "pos", "m", "at") + " and (`from` <> from_ or `to` <> to_ or `from` <> `to`)")
                  .select("token", "m", "at", "n", "pos"), "meeting-places")
    pairs = (minor.join(meet, ["token", "m", "at"]).join(member, ["token", "n", "pos"]).where("component <> other")
             .select(F.least("c", "class").alias("a"), F.greatest("c", "class").alias("b")).distinct())
    more = settle(pairs.join(star, ["a", "b"], "left_anti"), "rest-pairs")
    return found.unionByName(settle_alone(lambda: verified(more, docs, classes), "rest-links"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, mark, n_shingles, group, component_id, a row a document.

    ``mark`` is a hash of the text, ``group`` the component (null for an empty set) and ``component_id`` the
    least key in it.
    """
    docs = _docs(docs, key, text)
    read = settle(sets_of(docs), "shingle-sets")
    sets = read.where("class is not null").select("doc_id", "n", "class", "small", "mark", "summary")
    counts = settle(read.where("token is not null").groupBy("token").agg(F.sum("n").alias("n")), "frequent")
    # The count above which there are at most OFTEN_MOST shingles, from a histogram of counts.
    more = floor = 0
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("n")).collect():  # a row a count
        more += r.c
        if more > OFTEN_MOST:
            floor = r.n
            break
    top = counts.where(F.col("n") > floor).toArrow()
    token, times = top.column("token").to_numpy().view(np.uint64), top.column("n").to_numpy()
    often = (token[np.argsort(token)], times[np.argsort(token)])
    # Null keys come last; the mark tells rows with the same key apart.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("least")
    classes = settle(sets.where("n > 0").groupBy("class", "n").agg(least, F.first("small").alias("small"), F.first("summary").alias("summary"))
                     .select("class", "n", F.col("least.doc_id").alias("rep"), F.col("least.mark").alias("rep_mark"), "small", "summary"), "classes")
    sizes = {r["n"]: r["c"] for r in classes.where(F.col("n") <= 2 * LIGHT_MOST).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    most = boundary(sizes)
    light = settle(light_links(classes, most), "light-links")
    heavy = settle_alone(lambda: heavy_links(docs, classes, often, -(-PERCENT * (most + 1) // 100), light), "heavy-links",
                         keep=("star-pairs", "rest-pairs"))  # how many pairs were judged can be read afterwards
    groups = connected_components(light.unionByName(heavy)).withColumnRenamed("node", "class")
    named = classes.select("class", "rep").join(groups, "class")
    names = settle(named.join(named.groupBy("component").agg(F.min("rep").alias("name")), "component")
                   .select("class", "name", "component"), "names")
    own = classes.select("class", "rep").join(names, "class", "left").select(
        "class", F.coalesce("component", "class").alias("group"), F.coalesce("name", "rep").alias("component_id"))
    full = sets.where("n > 0").select("doc_id", "mark", "n", "class").join(own, "class").select(
        "doc_id", "mark", F.col("n").alias("n_shingles"), "group", "component_id")
    empty = sets.where("n = 0").select("doc_id", "mark", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("group"),
                                       F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the least key (then the least mark).

    Documents with an empty set all stay. Rows with the same key and text are one document.
    """
    found = settle_alone(lambda: near_duplicates(docs, key, text), "near-duplicates")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    best = found.where("group is not null").groupBy("group").agg(first).select("first.doc_id", "first.mark")
    own, mark, key_name = free_name(docs, "text_mark"), free_name(docs, "kept_mark"), free_name(docs, "kept_key")
    times = found.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("times"))
    stay = best.unionByName(found.where("group is null").select("doc_id", "mark")).distinct()
    same = (stay["doc_id"].eqNullSafe(times["doc_id"])) & (stay["mark"] == times["mark"])
    stay = settle(stay.join(times, same).select(stay["doc_id"].alias(key_name), stay["mark"].alias(mark), F.col("times")), "stay")
    marked = docs.withColumn(own, F.xxhash64(F.col(text).cast("string")))

    def kept(which: DataFrame) -> DataFrame:
        which = broadcast_if_bounded(which.drop("times"))
        return marked.join(which, F.col(key).cast("long").eqNullSafe(F.col(key_name)) & (F.col(own) == F.col(mark)), "left_semi")

    repeated = kept(stay.where("times > 1")).dropDuplicates([key, own])
    return kept(stay.where("times = 1")).unionByName(repeated).drop(own)
