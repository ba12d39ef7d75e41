"""Language identification by nearest centroid.

A text becomes a TF-IDF vector over hashed byte n-grams (1 to 3 bytes of the lower-cased text) of
unit length. Every language is held by several centroids, found by spherical k-means, and a text
gets the language of the centroid with the largest cosine. A text farther from every centroid
than its language's limit is rejected.

Document frequencies are counted over all training rows by grouped aggregation. The centroids are
fitted on a bounded sample of labelled rows (``sample_per_lang`` rows a language, chosen by a hash
of the text). Limits come from the cosines of all training rows, by language and length of text: short clean texts lie
farther from a centroid than long ones, and noise or an unlearned language lies farther than either. The model, ``languages x centroids x DIMS`` floats, is what tasks receive.

Edge cases: a null text, an empty one or one without a letter gives ``und`` with score 0 and is
rejected; with no training rows every text does. Repeated rows are judged one by one; ties between
centroids go to the first language in sort order. Other columns pass through unread; those named
like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, extended, text_slices, without

DIMS = 4096
GRAMS = (1, 2, 3)
#: Texts whose vectors a task holds at a time.
ROWS = 256
#: Rows whose texts a task holds as strings at a time.
PART = 1024
#: Limits: this share of the cosine that all but ``QUANTILE`` of a language's training texts reach, by length in characters.
MARGIN, QUANTILE = 0.75, 0.01
BANDS = (64, 256, 1024)
#: Training texts that a band needs for a limit of its own; smaller ones take the least of their language's limits.
BAND_LEAST = 50
UNKNOWN = "und"


@dataclass
class Model:
    """Centroids (unit rows), their languages, the least cosine by language and length band, and the IDF weights."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    floors: dict[str, list[float]]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(texts: list[bytes]) -> np.ndarray:
    """A row of n-gram counts for each text (lower-cased UTF-8)."""
    lens = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    doc = np.repeat(np.arange(len(texts)), lens)
    out = np.zeros(len(texts) * DIMS, np.int64)
    gram = np.zeros(len(data), np.uint32)
    for n in GRAMS:
        if len(data) < n:
            break
        gram = gram[: len(data) - n + 1] * np.uint32(257) + data[n - 1:] + np.uint32(1)
        whole = doc[: len(gram)] == doc[n - 1:]
        slot = (gram * np.uint32(2654435769)) >> np.uint32(20)
        out += np.bincount((doc[: len(gram)] * DIMS + slot)[whole], minlength=len(out))
    return out.reshape(len(texts), DIMS)


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    tf = counts(texts).astype(np.float32)
    np.log1p(tf, out=tf)
    tf *= idf
    norm = np.sqrt((tf * tf).sum(1, keepdims=True))
    return tf / np.where(norm > 0, norm, 1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices of ``PART`` rows: what a task holds as Python strings at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, PART):
            yield batch.slice(i, PART)


def _lowered(column: pa.Array) -> pa.Array:
    """Lower case; what counts() hashes."""
    return pa.array([(t or "").lower() for t in column.to_pylist()], pa.large_string())


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    for first, texts in text_slices(_lowered(column).cast(pa.large_binary())):
        for i in range(0, len(texts), ROWS):
            yield first + i, texts[i:i + ROWS]


def _idf(train: DataFrame) -> np.ndarray:
    """IDF over all training rows: one vector of counts a task, added up by Spark."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS, np.int64), 0
        for batch in _parts(batches):
            for _, texts in _blocks(batch.column(0)):
                df += (counts(texts) > 0).sum(0)
                n += len(texts)
        yield pa.RecordBatch.from_pydict({"slot": np.arange(DIMS + 1), "n": np.append(df, n)})

    rows = (arrow_map(train.select("_text"), tally, "slot long, n long")
            .groupBy("slot").agg(F.sum("n").alias("n")).collect())  # DIMS + 1 rows
    got = np.zeros(DIMS + 1)
    for r in rows:
        got[r["slot"]] = r["n"]
    return (np.log((1 + got[DIMS]) / (1 + got[:DIMS])) + 1).astype(np.float32)


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; fewer centroids if rows coincide."""
    mean = x.mean(0)
    seeds = [int(np.argmax(x @ mean))]
    near = x @ x[seeds[0]]
    while len(seeds) < k and near.min() < 0.999:
        seeds.append(int(near.argmin()))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _band(texts: list[str | None]) -> np.ndarray:
    return np.searchsorted(BANDS, [len(t or "") for t in texts], "right")


def _limits(train: DataFrame, model: Model) -> dict[str, list[float]]:
    """For each language its limits by length band, from the cosines of all training rows to their own centroids."""
    own = {g: model.centroids[[x == g for x in model.langs]] for g in set(model.langs)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            batch = batch.filter(pa.array([has_letter(t) and g in own for t, g in zip(*(batch.column(c).to_pylist() for c in ("_text", "_lang")))], pa.bool_()))
            langs, cos = np.array(batch.column("_lang").to_pylist(), object), np.zeros(batch.num_rows)
            for first, texts in _blocks(batch.column("_text")):
                v, part = vectors(texts, model.idf), slice(first, first + len(texts))
                for g in set(langs[part]):
                    rows = first + np.flatnonzero(langs[part] == g)
                    cos[rows] = (v[rows - first] @ own[g].T).max(1)
            yield pa.RecordBatch.from_arrays([batch.column("_lang").cast(pa.string()), pa.array(_band(batch.column("_text").to_pylist()), pa.int64()),
                                              pa.array(cos, pa.float64())], names=["_lang", "band", "cos"])

    rows = (arrow_map(train.select("_text", "_lang"), score, "_lang string, band long, cos double").groupBy("_lang", "band")
            .agg(F.percentile_approx("cos", QUANTILE, 10_000).alias("low"), F.count(F.lit(1)).alias("n")).collect())  # languages x bands
    out = {}
    for g in own:
        some = {r["band"]: MARGIN * r["low"] for r in rows if r["_lang"] == g and r["n"] >= BAND_LEAST}
        some = some or {r["band"]: MARGIN * r["low"] for r in rows if r["_lang"] == g}
        out[g] = [some.get(b, min(some.values(), default=0.0)) for b in range(len(BANDS) + 1)]
    return out


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang",
        centroids_per_lang: int = 4, sample_per_lang: int = 300) -> Model:
    """Fit on rows with a text that has a letter and a non-null language."""
    train = (labelled.select(F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang"))
             .where(F.col("_text").isNotNull() & F.col("_lang").isNotNull()))
    totals = {r["_lang"]: r["n"] for r in train.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return Model(np.ones(DIMS, np.float32), np.zeros((0, DIMS), np.float32), [], {})
    idf = _idf(train)
    # Twice the wanted share, so that a language falls short of its bound but rarely.
    share = F.coalesce(*[F.when(F.col("_lang") == g, F.lit(min(1.0, 2 * sample_per_lang / n)))
                         for g, n in totals.items()])
    draw = F.pmod(F.xxhash64("_text", F.lit("langid")), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            keep = pa.array([has_letter(t) for t in batch.column("_text").to_pylist()])
            batch = batch.filter(keep)
            langs, draws = batch.column("_lang").to_pylist(), batch.column("_draw").to_pylist()
            for first, texts in _blocks(batch.column("_text")):
                v = vectors(texts, idf)
                part = slice(first, first + len(texts))
                yield pa.RecordBatch.from_pydict({"_lang": langs[part], "_draw": draws[part],
                                                  "v": [r.tobytes() for r in v]})

    drawn = train.withColumn("_draw", draw).where(F.col("_draw") < share).select("_text", "_lang", "_draw")
    sample = arrow_map(drawn, embed, "_lang string, _draw double, v binary").collect()
    by_lang: dict[str, list] = {}
    for r in sorted(sample, key=lambda r: (r["_lang"], r["_draw"], bytes(r["v"]))):
        rows = by_lang.setdefault(r["_lang"], [])
        if len(rows) < sample_per_lang:
            rows.append(np.frombuffer(r["v"], np.float32))
    cents, langs = [], []
    for g, rows in sorted(by_lang.items()):
        x = np.stack(rows)
        c = _cluster(x, centroids_per_lang)
        cents.append(c)
        langs += [g] * len(c)
    model = Model(idf, np.concatenate(cents) if cents else np.zeros((0, DIMS), np.float32), langs, {})
    model.floors = _limits(train, model) if langs else {}
    return model


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``accepted`` (within the limit)."""
    df = without(df, ["lang_pred", "score", "accepted"])
    at = df.columns.index(text)
    schema = extended(df, "lang_pred string, score double, accepted boolean")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            raw = batch.column(at).to_pylist()
            score = np.zeros(len(raw))
            best = np.zeros(len(raw), np.int64)
            if model.langs:
                for first, texts in _blocks(batch.column(at)):
                    cos = vectors(texts, model.idf) @ model.centroids.T
                    best[first:first + len(texts)] = cos.argmax(1)
                    score[first:first + len(texts)] = cos.max(1)
            known = np.array([bool(model.langs) and has_letter(t) for t in raw], bool)
            score = np.where(known, np.clip(score, 0, 1), 0.0)
            lang = [model.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
            accepted = [k and s >= model.floors[g][b] for k, s, g, b in zip(known, score.tolist(), lang, _band(raw))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(map(bool, accepted), pa.bool_())],
                names=[*batch.schema.names, "lang_pred", "score", "accepted"])

    return arrow_map(df, judge, schema)
