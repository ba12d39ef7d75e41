"""Document fingerprints: invertible Bloom lookup tables over paragraph digests.

A text is the set of its paragraphs: lines, cut further after words that a hash picks (one in ``COARSE``; one in
``FINE`` among the first ``OPENING`` words, so that a short text has several), each hashed with the number of
times it occurs. The words themselves decide where paragraphs end, so a word put in changes one or two of them.

A table has three parts of equal width; an element falls into one cell of each part, where a signed count, the XOR
of the digests and the XOR of their checks add up. The width is a power of two that follows the number of the text's
paragraphs, so a table can list all its own. Tables of two versions are folded to the narrower one's width (cells whose
places agree modulo it add up) and subtract cell by cell: what they share cancels, and peeling
recovers the rest. A cell whose count is 1 or -1 and whose check fits holds exactly one differing digest, which is taken out
of its three cells, which lays bare others. A difference that doesn't peel is retried with larger tables, twice as
wide each time.

Everything is built-in DataFrame operations. Cells are rows keyed by the pair of texts, dealt by the
pair once and laid out at the folded width from the start; each peeling round is an explode and a grouped sum within the
partition, over one part of the table (where a digest occurs in one cell only). The cost is linear in the paragraphs,
whatever a document's length. Only counts of failed pairs reach the driver.

Edge cases: a null text is empty; a text without words has no paragraphs; two texts without
paragraphs are alike (1.0). Order of paragraphs and white space between words don't count for the
digests. Repeated rows are pairs of their own. Only the key and the text are read, so further columns can't clash. A line
is one array of word hashes while it is cut, 8 bytes a word. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

#: A paragraph ends after one word in so many; in the opening of a text, its first words, after more of them.
COARSE, FINE, OPENING = 16, 2, 16
PARTS = 3
#: Cells of a part for each paragraph: a difference of as many peels.
ROOM = 0.6
LEAST_WIDTH = 4
ROUNDS = 12


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cut(words: Column, line: Column) -> Column:
    """Digests of the paragraphs of a line, given its words' hashes and its number."""
    def last(word: Column, i: Column) -> Column:
        fine = (line == 0) & (i < OPENING) & (F.pmod(word, F.lit(FINE)) == 0)
        return F.when((F.pmod(word, F.lit(COARSE)) == 0) | fine | (i == F.size(words) - 1), i)

    def digests(ends: Column) -> Column:
        def digest(end: Column, k: Column) -> Column:
            before = F.coalesce(F.get(ends, k - 1), F.lit(-1))
            return F.xxhash64(F.slice(words, before + 2, end - before))

        return F.transform(ends, digest)

    return _bound(F.filter(F.transform(words, last), lambda i: i.isNotNull()), digests)


def paragraphs(text: Column) -> Column:
    """Digests of the paragraphs, in order."""
    lines = F.regexp_extract_all(text, F.lit(r"[^\n\x0B\f\r]++"), F.lit(0))

    def of_line(line: Column, nth: Column) -> Column:
        words = F.transform(F.regexp_extract_all(line, F.lit(r"\S++"), F.lit(0)), lambda w: F.xxhash64(w))
        return _bound(words, lambda w: _cut(w, nth))

    return F.flatten(F.transform(lines, of_line))


def width(n: Column) -> Column:
    """Cells in a part of a table for n paragraphs: a power of two."""
    return F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(LEAST_WIDTH), n * F.lit(ROOM))))).cast("int")


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


def _cell(key: Column, part: int, width: Column) -> Column:
    return (F.pmod(F.xxhash64(key, F.lit(part)), width.cast("long")) + F.lit(part) * width).cast("int")


def elements(rows: DataFrame, sides: list[str], keep: list[str]) -> DataFrame:
    """(keep..., side, key): each distinct digest of each side with its number of occurrences hashed in."""
    def tag(side: int) -> Callable[[Column], Column]:
        return lambda digest: F.struct(F.lit(side).alias("side"), digest.alias("digest"))

    tagged = F.concat(*[F.transform(s, tag(i)) for i, s in enumerate(sides)])
    return (rows.select(*keep, F.explode(tagged).alias("e")).groupBy(*keep, "e.side", "e.digest")
            .agg(F.count(F.lit(1)).alias("n")).select(*keep, "side", F.xxhash64("digest", "n").alias("key")))


def fingerprints(found: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., fingerprint): the table of the elements as text, the width of a part and then each cell that isn't empty:
    its place, count, digests and checks (hexadecimal).

    ``found`` has the elements with ``width``, that of their table.
    """
    placed = found.select(*keep, "width", "key", F.explode(F.array(*[_cell(F.col("key"), p, F.col("width")) for p in range(PARTS)])).alias("cell"))
    cells = placed.groupBy(*keep, "width", "cell").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("key").alias("key"),
                                                       F.bit_xor(_check(F.col("key"))).alias("chk"))
    text = F.concat_ws(".", "cell", "n", F.lower(F.hex("key")), F.lower(F.hex("chk")))
    one = cells.groupBy(*keep, "width").agg(F.array_sort(F.collect_list(F.struct("cell", text.alias("text")))).alias("cells"))
    return one.select(*keep, F.concat_ws(":", F.col("width").cast("string"), F.col("cells.text")).alias("fingerprint"))


#: The fingerprint of a text without paragraphs.
EMPTY = str(LEAST_WIDTH)


def peel(pairs: DataFrame, left: str, right: list[str], grow: int) -> DataFrame:
    """(uid, k, only_left, only_right, stuck) for every pair whose tables differ.

    ``pairs`` has uid, the digests ``left`` and those of the texts to compare with, ``right[k]``, and
    ``todo``, the list of k to do. It is dealt by uid. Without ``grow`` the tables are those of the fingerprints, folded to
    the narrower one's width; with it, tables with room for all of both texts, ``grow`` times as wide.
    """
    n = len(right)
    wide = [width(F.size(left) + F.size(r)) * grow if grow else F.least(width(F.size(left)), width(F.size(r))) for r in right]
    rows = pairs.withColumns({f"w{k}": w for k, w in enumerate(wide)})
    found = elements(rows, [left, *right], ["uid", "todo", *[f"w{k}" for k in range(n)]])
    # The left side counts towards every pair, each other side against its own.
    signed = F.filter(F.array(*[F.struct(
        F.lit(k).alias("k"), F.col(f"w{k}").alias("w"),
        F.when(F.col("side") == 0, 1).when(F.col("side") == k + 1, -1).otherwise(0).alias("sign")) for k in range(n)]),
        lambda s: (s["sign"] != 0) & F.array_contains("todo", s["k"]))
    one = found.select("uid", "key", F.explode(signed).alias("s")).select(
        "uid", "s.k", "s.w", F.col("s.sign").cast("long").alias("n"), "key", _check(F.col("key")).alias("chk"))
    cells = one.select("uid", "k", "w", "n", "key", "chk", F.explode(
        F.array(*[_cell(F.col("key"), p, F.col("w")) for p in range(PARTS)])).alias("cell"))

    def summed(cells: DataFrame) -> DataFrame:
        return (cells.groupBy("uid", "k", "w", "cell").agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"),
                                                           F.bit_xor("chk").alias("chk"))
                .where("n <> 0 or key <> 0 or chk <> 0"))

    def cell_row(cell: Column, n: Column, key: Column, chk: Column) -> Column:
        return F.struct(cell.alias("cell"), n.alias("n"), key.alias("key"), chk.alias("chk"))

    zero = F.lit(0).cast("long")
    same = cell_row(*[F.col(c) for c in ("cell", "n", "key", "chk")])
    # A peeled digest leaves its three cells and is counted in cell -1 (left only) or -2 (right only).
    peeled = F.array(same, *[cell_row(_cell(F.col("key"), p, F.col("w")), -F.col("n"), F.col("key"), F.col("chk")) for p in range(PARTS)],
                     cell_row(F.when(F.col("n") > 0, -1).otherwise(-2), F.abs("n"), zero, zero))
    cells = summed(cells)
    for r in range(ROUNDS):
        pure = ((F.floor(F.col("cell") / F.col("w")) == r % PARTS) & (F.abs("n") == 1) & (F.col("chk") == _check(F.col("key"))))
        cells = summed(cells.select("uid", "k", "w", F.explode(F.when(pure, peeled).otherwise(F.array(same))).alias("c"))
                       .select("uid", "k", "w", "c.*"))
    count = lambda cell: F.coalesce(F.sum(F.when(F.col("cell") == cell, F.col("n"))), zero)
    return cells.groupBy("uid", "k").agg(count(-1).alias("only_left"), count(-2).alias("only_right"),
                                         F.max((F.col("cell") >= 0)).alias("stuck"))


def likeness(texts: DataFrame, left: str, right: list[str], partitions: int | None = None) -> DataFrame:
    """uid and ``near0``, ``near1``, ...: the likeness of ``left`` to each of ``right``, by their tables:
    twice the digests in common over the digests of both.

    ``texts`` is a settled table of uid and digest columns.
    """
    ks = list(range(len(right)))
    todo = texts.select("uid", left, *right, F.array(*[F.lit(k) for k in ks]).alias("todo"))
    done, grow = None, 0
    while True:
        dealt = todo.repartition(partitions, "uid") if partitions else todo.repartition("uid")
        out = settle(peel(dealt, left, right, grow), "peeled")
        good = out.where("not stuck")
        done = good if done is None else done.unionByName(good)
        failed = out.where("stuck").groupBy("uid").agg(F.collect_list("k").alias("todo"))
        if failed.isEmpty():
            break
        todo, grow = texts.select("uid", left, *right).join(failed, "uid"), max(1, 2 * grow)
    diff = done.groupBy("uid").agg(*[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}")
                                     for k in ks for c in ("only_left", "only_right")])
    size = texts.select("uid", F.size(F.array_distinct(left)).alias("n"))
    here = lambda c: F.coalesce(F.col(c), F.lit(0))
    both = [F.col("n") - here(f"only_left{k}") for k in ks]
    all_ = [F.col("n") + b + here(f"only_right{k}") for k, b in enumerate(both)]
    near = [F.when(a == 0, 1.0).otherwise(2 * b / a).alias(f"near{k}") for k, (a, b) in enumerate(zip(all_, both))]
    return size.join(diff, "uid", "left").select("uid", *near)


def next_lower(keys: DataFrame, bits: int = 10, few: int = 4096) -> DataFrame:
    """(k, next) for distinct longs: the next lower one, and for the lowest the highest.

    By radix: neighbours within groups of 2**bits values, then between groups by the same means, so
    that no task sorts more than ``few`` keys.
    """
    ends = keys.agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("top")).first()
    if ends["n"] <= few:
        return keys.select("k", F.coalesce(F.lag("k").over(Window.orderBy("k")), F.lit(ends["top"]).cast("long")).alias("next"))
    grouped = keys.withColumn("g", F.shiftright("k", bits))
    groups = settle(grouped.groupBy("g").agg(F.max("k").alias("top")), "groups")
    below = next_lower(groups.select(F.col("g").alias("k")), bits, few).select(F.col("k").alias("g"), F.col("next").alias("below"))
    entry = below.join(groups.select(F.col("g").alias("below"), F.col("top").alias("entry")), "below").select("g", "entry")
    inside = grouped.withColumn("next", F.lag("k").over(Window.partitionBy("g").orderBy("k")))
    return inside.join(entry, "g").select("k", F.coalesce("next", "entry").alias("next"))


def with_next(docs: DataFrame, key: str, text: str, bits: int = 10) -> DataFrame:
    """key, text and ``next_text``, the text of the document after it in descending order of the key (after the last: the first).

    Equal keys stand in order of their texts, a null key last. One shuffle of the texts, by blocks of the key.
    """
    block = F.shiftright(F.coalesce(F.col("k"), F.lit(-(1 << 63)).cast("long")), bits)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")).withColumn("b", block)
    order = Window.partitionBy("b").orderBy(F.col("k").desc_nulls_last(), "t")
    placed = rows.withColumns({"next": F.lead("t").over(order), "at": F.row_number().over(order)})
    after = next_lower(settle(rows.select(F.col("b").alias("k")).distinct(), "blocks"))
    heads = placed.where("at = 1").select(F.col("b").alias("next_b"), F.col("t").alias("head"))
    entry = after.select(F.col("k").alias("b"), F.col("next").alias("next_b")).join(heads, "next_b").select("b", "head", F.lit(True).alias("last"))
    joined = placed.withColumn("last", F.col("next").isNull()).join(entry, ["b", "last"], "left")
    return joined.select(F.col("k").alias(key), F.col("t").alias(text), F.coalesce("next", "head").alias("next_text"))
