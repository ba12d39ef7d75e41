"""Fill-in-the-middle, mixing and ranked search: against brute force, on odd rows, and on small limits."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import ODD, SF, docs_of  # noqa: F401  (a fixture)
from pyspark.sql import functions as F

from orderlake.llm import fim, mixing, ranked

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TRICKY = [(20, "a<P>b"), (21, "<<P<S<M"), (22, "\U0001f600é<" * 5), (23, "<M>"), (24, "P>S>M>"), (25, "<"), (26, "ab")]


def _middle(key, text):
    text, key = text or "", "" if key is None else key
    h = [int(hashlib.sha256(f"1:{key}".encode()).hexdigest()[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    return n, form, a, b - a, f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_fill_in_the_middle_of_odd_rows(spark, docs_of, monkeypatch, block):  # noqa: F811
    monkeypatch.setattr(fim, "BLOCK", block)  # for the calls below; tasks have their own
    rows = ODD + TRICKY + [(100 + i, t) for i in range(30) for t in ("one two", "ä" * i)]
    got = fim.restore(fim.transform(docs_of(rows))).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n, r.form, r.prefix_chars or -1, r.middle_chars or -1, r.output, r.restored) for r in got) == sorted(
        (k is None, k or 0, n, f, a or -1, b or -1, o, t or "") for k, t in rows for n, f, a, b, o in [_middle(k, t)])
    texts = [(t or "").encode() for _, t in rows]
    hashes = np.random.default_rng(1).integers(0, 1 << 32, (len(texts), 4))
    made = fim.rearranged(texts, hashes, 100, 50)
    out = [bytes(made["out"][a:b]) for a, b in zip(made["ends"], made["ends"][1:])]
    data, ends = fim.rebuilt(out, made["form"])
    assert [bytes(data[a:b]) for a, b in zip(ends, ends[1:])] == texts


def test_fill_in_the_middle_keeps_columns_and_long_texts(spark, docs_of):  # noqa: F811
    clash = docs_of([(1, "x"), (2, "y z")]).selectExpr("*", "'a' AS N", "'b' AS form", "'c' AS c0", "1 AS restored", "2 AS output")
    out = fim.restore(fim.transform(clash))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "c0", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    assert {(r.restored, r.c0) for r in out.collect()} == {("x", "c"), ("y z", "c")}
    assert fim.restore(fim.transform(docs_of([]))).count() == 0
    long = spark.range(3).select(F.col("id").alias("doc_id"), F.repeat(F.lit("añ<b "), 1_000_000).alias("text"))
    assert fim.restore(fim.transform(long)).where("restored = text and (form = 'plain' or length(output) = n + 9)").count() == 3
    with pytest.raises(Exception, match="three marks"):
        fim.restore(spark.createDataFrame([("psm", "no marks")], "form string, output string")).collect()


def _mixed(rows, weights=(5, 2, 1), share=150, epochs=2):
    """(doc_id, size, source_size, target, taken) of (doc_id, text, source) rows, by filling round after round."""
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, share / 100 * sum(sizes.values()), set(names)
    while open_:
        worth = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * worth > epochs * sizes[s]}
        for s in full or open_:
            target[s] = epochs * sizes[s] if full else weight[s] * worth
            left -= target[s]
        open_ -= full or set(open_)
    out = []
    for s in names:
        own = sorted((hashlib.md5(f"1:{'' if k is None else k}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest(), k, len(WORD.findall(t or "")))
                     for k, t, z in rows if z == s)
        budget = math.floor(target[s] + 1e-9)
        turns, at = (budget // sizes[s], budget % sizes[s]) if sizes[s] else (0, 0)
        for _, k, n in own:
            out.append((k, n, sizes[s], target[s], turns * n + max(0, min(n, at))))
            at -= n
    return out


def _sources(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


CASES = {
    "odd": [(i, t, s) for i, (_, t) in enumerate(ODD) for s in ("a", "b", None)],
    "one source": [(i, "w " * (i % 7), "s") for i in range(50)],
    "uneven": [(i, "w " * (1 + i % 5), f"s{min(i % 11, 6)}") for i in range(300)],
    "hot": [(i, "a b c", "hot" if i % 3 else f"x{i}") for i in range(400)],
    "empty words": [(1, None, "a"), (2, " ", "b"), (3, "", None)],
    "code points": [(i, "x y " * i, s) for i, s in enumerate(["é", "z", "Z", "\U0001f600", "￿", "", None])],
    "repeats": [(7, "same text here", "a")] * 20 + [(8, "b c", "b")] * 5,
}


@pytest.mark.parametrize("case", CASES)
def test_mixing_matches_brute_force(spark, case):
    rows = CASES[case]
    got = mixing.plan(_sources(spark, rows)).collect()
    order = lambda x: (x[0], x[1], x[2], x[4], x[3])
    expect = sorted(_mixed(rows), key=order)
    got = sorted(((r.key, r["size"], r.source_size, r.target, r.taken) for r in got), key=order)
    assert [(g[0], g[1], g[2], g[4]) for g in got] == [(e[0], e[1], e[2], e[4]) for e in expect]
    assert [g[3] for g in got] == pytest.approx([e[3] for e in expect])


def test_mixing_is_the_same_however_rows_are_dealt(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = sorted(map(tuple, mixing.plan(docs.coalesce(1)).drop("row").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sorted(map(tuple, mixing.plan(docs.repartition(9)).drop("row").collect())) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_mixed_corpus_has_the_words_taken(spark):
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(i % 6)) + "\n", f"s{i % 3}") for i in range(60)] + [(None, "no key", None)]
    docs = _sources(spark, rows).selectExpr("*", "7 AS row", "8 AS epoch", "9 AS start")
    taken = {r.key: r.taken for r in mixing.plan(docs).collect()}
    out = mixing.mix(docs).collect()
    assert set(mixing.mix(docs).columns) == {*docs.columns, "size", "source_size", "target", "taken"}
    words, texts = Counter(), {r[0]: r[1] for r in rows}
    for r in out:
        words[r.doc_id] += len(WORD.findall(r.text))
        assert texts[r.doc_id].startswith(r.text) and r["row"] == 7 and r["start"] == 9 and 1 <= r.epoch <= 2
    assert words == Counter({k: n for k, n in taken.items() if n})
    assert mixing.plan(_sources(spark, [])).count() == 0 and mixing.mix(_sources(spark, [])).count() == 0


def test_mixing_runs_no_python(spark):
    from conftest import plan_text
    plan = plan_text(mixing.plan(_sources(spark, CASES["uneven"])))
    assert not re.search("Python|Arrow|Pandas", plan) and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_prefix_sums_split_a_hot_group(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("g"),
                                      F.lit("same").alias("hash"), F.col("id").alias("row"), F.lit(2).alias("v"))
    out = mixing.before(rows, ["g"], ["hash", "row"], {"s": "v"}, "test-sums")
    hot = out.where("g = 'hot'").orderBy("row").collect()
    assert [r.s for r in hot] == list(range(0, 2 * len(hot), 2)) and out.where("g <> 'hot' and s <> 0").count() == 0
    ranged = rows.repartitionByRange(8, "g", "hash", "row").withColumn("range", F.spark_partition_id())
    assert ranged.where("g = 'hot'").groupBy("range").count().agg(F.max("count")).first()[0] < 0.6 * len(hot)


def _ranking(docs, items, k=50):
    found = [(key, [t for t in TERM.findall((text or "").translate(LOWER))]) for key, text in docs]
    found = [(key, len(w), Counter(w)) for key, w in found if w]
    n_docs, n_terms = len(found), sum(n for _, n, _ in found)
    df = Counter(t for _, _, c in found for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        own, scores = set(TERM.findall((text or "").translate(LOWER))), []
        for key, n, c in found:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                scores.append((-score, key is None, key or 0))
        out += [(item, i + 1, None if null else key, -s) for i, (s, null, key) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def _found(spark, docs, items, **how):
    frames = docs, spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in ranked.search(*frames, **how).collect()), key=str)


ITEMS = [(1, "one two three"), (2, ""), (3, None), (4, "a b g zzz"), (5, "\U0001f600 SIGNS x_here \x00"), (6, "one"), (6, "one"), (6, "two one"), (None, "nul and c")]


def test_search_of_odd_rows(spark, docs_of):  # noqa: F811
    rows = ODD + [(50 + i, "one two " * (i % 4) + "three words more") for i in range(40)] + [(None, "one two")] * 3
    docs = docs_of(rows).selectExpr("*", "1 AS key", "2 AS query", "3 AS score")
    assert _found(spark, docs, ITEMS, k=5) == _ranking(rows, ITEMS, 5)
    assert _found(spark, docs.where("false"), ITEMS) == [] and _found(spark, docs, []) == []


def test_search_prunes_and_stays_exact(spark, docs_of, monkeypatch):  # noqa: F811
    """Shards of a few documents, several blocks of queries, frequent and rare words, planted pairs."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    odds = 1 / np.arange(1, 61)
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 60), p=odds / odds.sum()))) for i in range(600)]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 12)))) for i in range(40)]
    rows += [(1000 + i, t) for i, t in items[:20]]
    expect = _ranking(rows, items, 10)
    assert _found(spark, docs_of(rows).repartition(7), items, k=10) == expect
    assert _found(spark, docs_of(rows).repartition(3), items, k=10, block_bytes=900) == expect
    # The same search in this process, with shards of ten documents, counting what is looked at.
    looked = []
    collect = ranked.Searcher._collect
    monkeypatch.setattr(ranked.Searcher, "_collect", lambda self, q, shard, keys, *a: looked.append(q) or collect(self, q, shard, keys, *a))
    asked = ranked.Queries([t.encode() for _, t in items])
    shards = docs_of(rows).repartition(62)
    stored = ranked.settle(ranked.postings(shards, asked, "doc_id", "text"), "test-shards")
    n_docs, n_terms, df = ranked._statistics(stored)
    plan = ranked.Plan(asked, df, n_docs, n_terms)
    index = ranked.settle(ranked.impacts(stored, plan, 10), "test-index")
    floors = ranked._floors(index, len(items), 10)
    searcher = ranked.Searcher(plan, floors, 10)
    table = index.drop("query", "step", "count").toArrow().combine_chunks().to_batches()[0]
    for row in range(table.num_rows):
        searcher.search(ranked._arrays(table, row), table.column("keys")[row].values)
    assert sorted(((items[q][0], i + 1, r[2], -r[0]) for q, best in enumerate(searcher.best) for i, r in enumerate(best)), key=str) == expect
    assert len(looked) < 0.9 * len(items) * table.num_rows
    least = {i: s for i, _, _, s in sorted(expect, key=lambda r: -r[3])}
    assert all(f <= least[i] for (i, _), f in zip(items, floors))


def test_pair_bounds_are_tighter_than_single_ones():
    """Two terms whose best documents differ: the pair's bound is what one document can really reach."""
    queries = ranked.Queries([b"a b"])
    plan = ranked.Plan(queries, {0: 1, 1: 1}, 100, 1000)
    w = plan.weight[0]
    shard = {"term": [0, 1], "ends": [1, 2], "doc": [0, 1], "impact": [900, 800], "most": [w * 900, w * 800], "pair": [], "pair_most": []}
    import pyarrow as pa
    searcher = ranked.Searcher(plan, np.array([w * 1000]), 5)
    searcher._collect = lambda *a: pytest.fail("no document reaches the threshold")
    searcher.search({k: np.array(v, np.int64) for k, v in shard.items()}, pa.array([1, 2]))
