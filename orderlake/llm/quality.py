"""Quality classifier: document evidence and hierarchical empirical Bayes over sites.

For each label (quality, toxic) a naive Bayes model over hashed words and text shape gives a
document's evidence, a log likelihood ratio, calibrated on rows it wasn't fitted on. The prior it is
combined with is its site's: the posterior mean of the label's rate on the document's host and path,
each level shrunk towards the one above it (path to host, host to the whole corpus). How strongly
is estimated from the spread of the sites' own rates (moments), so that a sparse site says little and
a large one that differs says much. Sites' rates count every document: its label where it
has one, else what the classifier alone says. They are grouped sums, so that a hot host costs
a partial row a task.

The model is fitted on a bounded sample of labelled rows: ``sample`` rows at most in expectation, chosen by a hash of the key.

Edge cases: a null or empty text has no evidence and gets its site's prior; a null host or path
is a site of its own; labels with a null key or value are ignored, several labels of a key count as
their mean. Without labels every probability is one half. Repeated documents are judged one by one.
Documents whose columns carry other names pass them as parameters; further columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded
from .common import arrow_map, settle, text_slices
from .shingles import hashed_words

SAMPLE = 20_000
WORD_BITS = 16
SHAPES, STEPS = 7, 16
SLOTS = (1 << WORD_BITS) + SHAPES * STEPS
#: A slot counts from so many documents on; pseudo-documents of smoothing; bound of the raw score.
LEAST, SMOOTH, BOUND = 5, 2.0, 30.0
#: Standard errors by which a slot's two rates must differ: about one of 16,000 does by chance.
CLEAR = 4.0
_kind = np.arange(256)
LETTER = (_kind >= 128) | ((_kind | 32) >= 97) & ((_kind | 32) <= 122)
UPPER = (_kind >= 65) & (_kind <= 90)
DIGIT = (_kind >= 48) & (_kind <= 57)
BLANK = (_kind <= 32)
SYMBOL = ~(LETTER | DIGIT | BLANK)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) pairs, each once: the words and shape buckets that a text has."""
    words, ends = hashed_words(texts, ~LETTER)
    n = np.diff(ends, prepend=0)
    own = np.repeat(np.arange(len(texts)), n)
    seen = np.unique((own << WORD_BITS) | (words >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    doc, slot = seen >> WORD_BITS, seen & ((1 << WORD_BITS) - 1)
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    first = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    size = np.maximum([len(t) for t in texts], 1)
    share = lambda table: np.add.reduceat(table[data].astype(np.int64), first) / size
    distinct = np.bincount(doc, minlength=len(texts)) / np.maximum(n, 1)
    letters = share(LETTER)
    shape = [share(UPPER) / np.maximum(letters, 1e-9), share(SYMBOL) * 3, share(DIGIT) * 3, distinct,
             np.log2(n + 1) / STEPS, letters * size / np.maximum(n, 1) / STEPS,
             share((_kind == 124) | (_kind == 10)) * 4]
    filled = np.flatnonzero(n > 0)
    for k, x in enumerate(shape):
        doc = np.concatenate([doc, filled])
        slot = np.concatenate([slot, ((1 << WORD_BITS) + k * STEPS + (x * STEPS).astype(int).clip(0, STEPS - 1))[filled]])
    return doc, slot


@dataclass
class Evidence:
    """A weight for each slot, and the calibration of their sum."""

    weights: np.ndarray
    scale: float = 1.0
    shift: float = 0.0


def _weights(has: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Log ratios of the slots' rates; ``has`` (2 x slots) counts documents of label 0 and 1."""
    if total.min() <= 0:
        return np.zeros(SLOTS)
    rate = (has.sum(0) + 0.5) / (total.sum() + 1)
    p = (has + SMOOTH * rate) / (total[:, None] + SMOOTH)
    plain = has / total[:, None]
    error = np.sqrt(rate * (1 - rate).clip(1e-9) * (1 / total).sum())
    return np.where((has.sum(0) >= LEAST) & (np.abs(plain[1] - plain[0]) > CLEAR * error), np.log(p[1] / p[0]), 0.0)


def _calibrate(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the evidence by logistic regression, the label's log odds as offset."""
    if len(label) < 20 or label.min() == label.max():
        return 1.0, 0.0
    offset = np.log(label.mean() / (1 - label.mean()))
    w, x, centre = np.array([1.0, 0.0]), np.stack([score, np.ones(len(score))], 1), np.array([1.0, 0.0])

    def loss(w: np.ndarray) -> float:
        z = offset + x @ w
        return float((np.logaddexp(0, z) - label * z).sum() + 0.5 * ((w - centre) ** 2).sum())

    for _ in range(30):  # Newton, halving steps that don't help
        p = 1 / (1 + np.exp(-(offset + x @ w).clip(-40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
        step, size = np.linalg.solve(hessian, x.T @ (label - p) - (w - centre)), 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
    return (float(w[0]), float(w[1])) if w[0] > 0 else (0.0, 0.0)


def _scores(texts: list[bytes], models: list[np.ndarray]) -> np.ndarray:
    doc, slot = features(texts)
    return np.stack([np.bincount(doc, m[slot], len(texts)) for m in models], 1).clip(-BOUND, BOUND)


def fit(docs: DataFrame, labels: DataFrame, names: list[str], key: str = "doc_id", text: str = "text",
        sample: int = SAMPLE) -> dict[str, Evidence]:
    """Evidence models of the 0/1 columns ``names`` of ``labels``."""
    n = labels.count()
    if not n:
        return {x: Evidence(np.zeros(SLOTS)) for x in names}
    draw = F.pmod(F.xxhash64(key, F.lit("quality")), F.lit(1 << 20))
    drawn = (labels.where(F.col(key).isNotNull() & (draw < F.lit(int(min(1.0, sample / n) * (1 << 20)))))
             .groupBy(key).agg(*[F.avg(x).alias(x) for x in names]))
    fold = (F.pmod(F.xxhash64(key, F.lit("fold")), F.lit(5)) == 0).alias("_held")
    rows = (docs.select(key, F.col(text).cast("string").alias("_text")).join(broadcast_if_bounded(drawn), key)
            .select("_text", fold, *[(F.col(x) >= 0.5).cast("int").alias(x) for x in names]))
    rows = settle(rows, "quality-sample")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = np.zeros((len(names), 2, SLOTS + 1), np.int64)
        for batch in batches:
            label = [batch.column(x).to_numpy(zero_copy_only=False) for x in names]
            for first, texts in text_slices(batch.column("_text")):
                doc, slot = features(texts)
                for k, y in enumerate(label):
                    y = y[first:first + len(texts)]
                    for v in (0, 1):
                        has[k, v, :SLOTS] += np.bincount(slot[y[doc] == v], minlength=SLOTS)
                        has[k, v, SLOTS] += (y == v).sum()
        at = np.flatnonzero(has)
        yield pa.RecordBatch.from_pydict({"at": at, "n": has.ravel()[at]})

    got = (arrow_map(rows.where("not _held").dropna(subset=names), tally, "at long, n long")
           .groupBy("at").agg(F.sum("n").alias("n")).toPandas())  # at most 2 x SLOTS + 2 rows a label
    has = np.zeros(len(names) * 2 * (SLOTS + 1))
    has[got["at"].to_numpy(np.int64)] = got["n"].to_numpy(float)
    has = has.reshape(len(names), 2, SLOTS + 1)
    models = [_weights(h[:, :SLOTS], h[:, SLOTS]) for h in has]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column("_text")):
                s = _scores(texts, models)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in s.T] + [
                    batch.column(x).slice(first, len(texts)) for x in names], names=[*(f"_s{x}" for x in names), *names])

    schema = ", ".join([f"`_s{x}` double" for x in names] + [f"`{x}` int" for x in names])
    held = arrow_map(rows.where("_held"), measure, schema).toPandas()  # a fifth of the bounded sample
    out = {}
    for x, m in zip(names, models):
        own = held.dropna(subset=[x])
        out[x] = Evidence(m, *_calibrate(own[f"_s{x}"].to_numpy(float), own[x].to_numpy(float)))
    return out


def evidence(docs: DataFrame, models: dict[str, Evidence], keep: dict[str, Column], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``_e<label>``: the calibrated log likelihood ratio of each label."""
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text).cast("string").alias("_text"))
    weights, names = [m.weights for m in models.values()], [f"_e{x}" for x in models]
    scale, shift = np.array([[m.scale, m.shift] for m in models.values()]).T

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column("_text")):
                e = np.where(np.array([len(t) > 0 for t in texts])[:, None], _scores(texts, weights) * scale + shift, 0.0)
                part = batch.slice(first, len(texts)).drop_columns(["_text"])
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c) for c in e.T)], names=[*part.schema.names, *names])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return arrow_map(rows, judge, ", ".join(fields + [f"`{n}` double" for n in names]))


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _shrunk(sites: DataFrame, above: Column, n: Column, k: Column) -> DataFrame:
    """``sites`` with ``rate``: (k + m * above) / (n + m), m the strength that the sites' spread implies.

    Moments: the mean of n * (k/n - above)^2 is above * (1 - above) * (1 + (n - 1) / (m + 1)) over sites.
    """
    a = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), above))
    stat = sites.select(F.sum(n * (k / n - a) * (k / n - a) / (a * (1 - a))).alias("spread"), F.count(F.lit(1)).alias("sites"),
                        F.sum(n - 1).alias("more")).first()
    excess = (stat["spread"] or 0.0) - (stat["sites"] or 0)
    rho = min(max(excess / stat["more"], 1e-4), 0.9999) if stat["more"] else 1e-4
    m = 1 / rho - 1
    return sites.withColumn("rate", (k + F.lit(m) * a) / (n + F.lit(m)))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: Column | str = "source",
          path: Column | str = "lang", names: tuple[str, ...] = ("quality", "toxic"), sample: int = SAMPLE) -> DataFrame:
    """doc_id, and for each label its probability and ``<label>_site``, the site's posterior rate."""
    names = list(names)
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    labels = labels.select(key, *[F.col(x).cast("double").alias(x) for x in names])
    models = fit(docs, labels, names, key, text, sample)
    site = {"doc_id": F.col(key), "host": F.coalesce(as_column(host).cast("string"), F.lit("")),
            "path": F.coalesce(as_column(path).cast("string"), F.lit(""))}
    scored = settle(evidence(docs, models, site, text), "quality-scores")
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("doc_id")).agg(*[F.avg(x).alias(x) for x in names])
    rows = scored.join(known, "doc_id", "left")
    base = labels.agg(*[F.avg(x).alias(x) for x in names]).first()
    out = scored
    for x in names:
        rate = min(max(0.5 if base[x] is None else float(base[x]), 1e-4), 1 - 1e-4)
        believed = F.coalesce(F.col(x), 1 / (1 + F.exp(-(F.col(f"_e{x}") + F.lit(float(np.log(rate / (1 - rate))))))))
        paths = settle(rows.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(believed).alias("k")),
                       "quality-paths")
        hosts = _shrunk(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), F.lit(rate), F.col("n"), F.col("k"))
        both = paths.join(hosts.select("host", F.col("rate").alias("_host")), "host")
        sites = _shrunk(both, F.col("_host"), F.col("n"), F.col("k")).select("host", "path", F.col("rate").alias(f"{x}_site"))
        out = out.join(broadcast_if_bounded(settle(sites, "quality-sites")), ["host", "path"])
    return out.select("doc_id", *[c for x in names for c in (
        (1 / (1 + F.exp(-(_odds(F.col(f"{x}_site")) + F.col(f"_e{x}"))))).alias(x), F.col(f"{x}_site"))])
