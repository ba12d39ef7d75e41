"""Mixing sources to target weights, in built-in Spark functions alone.

Every document gets a key, the hash of its id and text, which puts the documents of a source in random order. Rows
(without their texts) are range-sorted by source and key, so that one source's rows spread over as many tasks as
they need. Sums within the ranges and sums over the ranges' totals give every document the words that its
source has before it. A source takes its budget, its target in whole words, exactly: so many whole epochs, and of one
more epoch the documents up to the place where the budget ends, which may lie within a document.

Targets: sources in order of their names by code point (null last) weigh ``weights`` in turn and share ``share`` per
cent of all words. A target stops at ``epochs`` times its source's words; what is then left is shared again by weight
among the others. The source that fills first is the one with the fewest words to its weight, so sources sorted
by that ratio and prefix sums over them say at once which stop and what a weight is worth to the rest.
The sources' own table is summed in the same distributed way, however many sources there are.

Edge cases: a null or wordless text has size 0 and is never taken; a null source is a source; a null key is hashed as
the empty string; repeated rows are documents of their own, and which of two equal rows is taken does not show;
columns named like a new one are replaced and others pass through; an empty table gives no rows. Words are only
counted, whatever the text's length. Working columns have names of their own within tables that carry
no column of the input, so no name of the input can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded
from .common import free_name, settle, without

#: Fixed value: a word.
WORD = r"[^\x20\x09-\x0D]+"
NEW = ["size", "source_size", "target", "taken"]


def n_words(text: Column) -> Column:
    """Words of a text (0 for null): each becomes one letter, and the letters are counted."""
    marks = F.regexp_replace(text, WORD, "w")
    return F.coalesce(F.length(marks) - F.length(F.replace(marks, F.lit("w"), F.lit(""))), F.lit(0)).cast("long")


def before(rows: DataFrame, within: list[str], order: list[str], sums: dict[str, str], name: str) -> DataFrame:
    """``rows`` with the sums of columns (new name -> column) over the rows before each, in ``order``, per ``within``.

    A range sort over (within, order) deals the rows; each range is summed on its own and starts from the totals of
    the ranges before it, a row a range and group. No task holds more than a range, however large a group is.
    """
    ranged = settle(rows.repartitionByRange(*within, *order).withColumn("range", F.spark_partition_id()), name)
    totals = ranged.groupBy(*within, "range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.partitionBy(*within).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*[F.col(c).alias(f"in_{c}") for c in within], F.col("range").alias("in_range"),
                           *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"start_{n}") for n in sums])
    own = Window.partitionBy(*within, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumns({n: F.coalesce(F.sum(c).over(own), F.lit(0)) for n, c in sums.items()})
    same = (F.col("range") == F.col("in_range"))
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"in_{c}"))
    joined = summed.join(broadcast_if_bounded(starts), same)
    return joined.select(*rows.columns, *[(F.col(n) + F.col(f"start_{n}")).cast("long").alias(n) for n in sums])


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: int = 150, epochs: int = 2) -> DataFrame:
    """(source, size, target) of every source, from its size in words.

    With S words and W weights in all, the first k sources by size over weight stop if the next share, per
    weight, is (share * S / 100 - epochs * S_k) / (W - W_k) and covers them. Both parts are exact integers.
    """
    total = sizes.agg(F.sum("size")).first()[0] or 0
    named = sizes.select("source", "size", F.col("source").isNull().alias("last"), F.lit(1).alias("one"))
    placed = before(named, [], ["last", "source"], {"place": "one"}, "mix-sources")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    filled = placed.select("source", "last", "size", turn.cast("long").alias("weight")).withColumn("ratio", F.col("size") / F.col("weight"))
    filled = settle(before(filled, [], ["ratio", "last", "source"], {"s": "size", "w": "weight"}, "mix-ratios"), "mix-filled")
    every = filled.agg(F.sum("weight")).first()[0] or 0
    big = lambda c: (F.col(c) if isinstance(c, str) else F.lit(c)).cast("decimal(38,0)")
    # What is left for this source and those after it, in hundredths of a word, and their weights.
    left, weight = big(share * total) - big(100 * epochs) * big("s"), big(every) - big("w")
    stops = big(100 * epochs) * big("size") * weight <= big("weight") * left
    judged = filled.withColumns({"stops": stops, "left": left, "rest": weight})
    # Once one source does not stop, none after it does: the first of them has what is left and the weights to share.
    go = judged.where(~F.col("stops")).agg(F.max("left").alias("left"), F.max("rest").alias("rest")).first()
    worth = F.col("weight") * F.lit(int(go["left"] or 0)).cast("double") / F.lit(100 * int(go["rest"] or 1)).cast("double")
    return judged.select("source", "size", F.when(F.col("stops"), (F.col("size") * epochs).cast("double")).otherwise(worth).alias("target"))


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", row: str | None = None,
         weights: tuple[int, ...] = (5, 2, 1), share: int = 150, epochs: int = 2, seed: int = 1) -> DataFrame:
    """(key, source, size, source_size, target, taken, start, row) of every document, without its text.

    ``taken`` counts the words that the mix takes of it, repeats included; ``start`` the words that its source has
    before it in random order. A source's words taken are its target, rounded down. ``row`` names a column that
    tells the documents apart (a number of its own is given where there is none).
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.md5(body.cast("binary"))))
    rows = docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"),
                       hashed.alias("hash"), (F.col(row) if row else F.monotonically_increasing_id()).alias("row"))
    rows = settle(rows, "mix-sizes")  # the range sort samples its input first: without this it would read the texts twice
    placed = settle(before(rows, ["source"], ["hash", "row"], {"start": "size"}, "mix-rows"), "mix-placed")
    goals = targets(placed.groupBy("source").agg(F.sum("size").alias("size")), weights, share, epochs)
    goals = settle(goals, "mix-targets").select(F.col("source").alias("of"), F.col("size").alias("source_size"), "target")
    turns = F.expr("CASE WHEN source_size > 0 THEN floor(target) div source_size ELSE 0 END")
    rest = F.floor("target") - turns * F.col("source_size")
    part = F.greatest(F.lit(0), F.least("size", rest - F.col("start")))
    joined = placed.join(broadcast_if_bounded(goals), F.col("source").eqNullSafe(F.col("of")))
    return joined.select("key", "source", "size", "source_size", "target", (turns * F.col("size") + part).cast("long").alias("taken"),
                         "start", "row")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mixed corpus: ``docs`` with size, source_size, target, taken and epoch, a row for every time that a document
    is taken. A document at which the budget of its source ends is cut after its last word taken.
    """
    row = free_name(docs, "row")
    rows = settle(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    made = plan(rows, key, text, source, row, **how).where("taken > 0").select(
        F.col("row").alias(row), *NEW, F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))).alias("epoch"))
    words = F.least("size", F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    part = F.slice(F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), words.cast("int"))
    cut = F.when(words < F.col("size"), F.array_join(part, "")).otherwise(F.col(text))
    return without(rows, [*NEW, "epoch"]).join(made, row).withColumn(text, cut).drop(row)
