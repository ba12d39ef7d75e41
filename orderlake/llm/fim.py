"""Fill-in-the-middle by displacement scatter.

A text is cut at two code points into prefix, middle and suffix and written in another order with marks
between: ``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle`` (spm). No text is sliced on
its own. The texts of a slice of a batch are one byte array: a scan over it finds the byte of every cut, a
difference array over the cuts says where the way that bytes move changes, its cumulative sum gives each byte its
shift, and one numpy scatter puts all bytes of the slice in their places. ``restore`` needs the output and the form
alone: it finds the marks, builds the same shifts from them, and gathers the bytes back.

Cuts and forms follow from a hash of ``seed:key``, so reruns agree and nothing depends on how rows are dealt.
A form is plain (the text as it is) for an empty text, for one that already holds a mark, and for the share of keys
that ``rate`` leaves out. No text can hold a mark of its own in another form, and none can arise where
text and mark meet (a mark begins with ``<``, ends with ``>`` and has one letter between).

Edge cases: a null text is an empty one; a null key hashes as the empty string; repeated rows are cut alike; columns
named like a new one (n, form, prefix_chars, middle_chars, output; restored) are replaced, others pass through. A
slice has about 2 MB of text or one longer text; shifts exist for ``BLOCK`` bytes at a time, so a very long
text costs its bytes and those of its output, and no more. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, extended, text_slices, without

#: The marks of prefix, suffix and middle, and the names of the forms.
MARKS = (b"<P>", b"<S>", b"<M>")
FORMS = ["plain", "psm", "spm"]
PLAIN, PSM, SPM = range(3)
#: Bytes that have a shift in memory at a time.
BLOCK = 1 << 20
_NEW = "n long, form string, prefix_chars long, middle_chars long, output string"


def _blocks(size: int) -> Iterator[tuple[int, int]]:
    for a in range(0, size, BLOCK):
        yield a, min(a + BLOCK, size)


def _moves(starts: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(a, b, other place of each byte from a to b), block by block.

    Segment i begins at byte ``starts[i]`` (ascending; segments may be empty) and moves by ``shifts[i]``.
    """
    jumps = np.diff(shifts, prepend=0)
    base = np.concatenate([[0], np.cumsum(jumps)])
    for a, b in _blocks(size):
        lo, hi = np.searchsorted(starts, (a, b))
        change = np.zeros(b - a, np.int64)
        np.add.at(change, starts[lo:hi] - a, jumps[lo:hi])
        change[0] += base[lo]
        yield a, b, np.cumsum(change) + np.arange(a, b)


def _scatter(data: np.ndarray, starts: np.ndarray, shifts: np.ndarray, out: np.ndarray) -> None:
    for a, b, to in _moves(starts, shifts, len(data)):
        out[to] = data[a:b]


def _gather(data: np.ndarray, starts: np.ndarray, shifts: np.ndarray, size: int) -> np.ndarray:
    out = np.empty(size, np.uint8)
    for a, b, source in _moves(starts, shifts, size):
        out[a:b] = data[source]
    return out


def _lead_bytes(data: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the first bytes of code points, block by block."""
    for a, b in _blocks(len(data)):
        yield a + np.flatnonzero((data[a:b] & 0xC0) != 0x80)


def _points_before(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many code points begin before each of ``places`` (bytes, ascending)."""
    out = np.zeros(len(places), np.int64)
    for lead in _lead_bytes(data):
        out += np.searchsorted(lead, places)
    return out


def _byte_of(data: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The first byte of each code point of ``points`` (counted over all texts); past the last: the end."""
    out, seen = np.full(len(points), len(data), np.int64), 0
    for lead in _lead_bytes(data):
        here = (points >= seen) & (points < seen + len(lead))
        out[here] = lead[points[here] - seen]
        seen += len(lead)
    return out


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts of one byte array as an Arrow column."""
    return pa.Array.from_buffers(pa.string(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def rearranged(texts: list[bytes], hashes: np.ndarray, rate: int, spm: int) -> dict[str, np.ndarray]:
    """Forms, cuts and outputs of ``texts``; ``hashes`` has four unsigned numbers a text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = _ends(size)
    first = _points_before(data, begin)
    n = np.diff(first)
    form = np.where(hashes[:, 3] % 100 < spm, SPM, PSM)
    marked = np.array([any(m in t for m in MARKS) for t in texts], bool)
    form[(n == 0) | marked | (hashes[:, 2] % 100 >= rate)] = PLAIN
    cuts = np.sort(hashes[:, :2] % (n + 1)[:, None], axis=1)
    cuts[form == PLAIN] = n[form == PLAIN, None]  # all of a plain text is prefix
    at = _byte_of(data, (first[:-1, None] + cuts).ravel()).reshape(-1, 2)
    at = np.where(cuts == n[:, None], begin[1:, None], at)  # the end of a text, not the next one's first byte
    prefix, suffix = at[:, 0] - begin[:-1], begin[1:] - at[:, 1]
    out = np.empty(int(size.sum() + 9 * (form != PLAIN).sum()), np.uint8)
    ends = _ends(size + 9 * (form != PLAIN))
    psm, spm_ = form == PSM, form == SPM
    home = ends[:-1]
    to_prefix = np.where(form == PLAIN, home, home + np.where(psm, 3, 6 + suffix))
    to_suffix = home + np.where(psm, 6 + prefix, 3)
    to_middle = home + 9 + prefix + suffix
    starts = np.stack([begin[:-1], at[:, 0], at[:, 1]], axis=1)
    to = np.stack([to_prefix, to_middle, to_suffix], axis=1)
    _scatter(data, starts.ravel(), (to - starts).ravel(), out)
    for mark, place in zip(MARKS, (to_prefix, to_suffix, to_middle)):
        for i, byte in enumerate(mark):
            out[place[psm | spm_] - 3 + i] = byte
    return {"n": n, "form": form, "prefix": cuts[:, 0], "middle": cuts[:, 1] - cuts[:, 0], "out": out, "ends": ends}


def _marks_of(data: np.ndarray, begin: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """Places of the marks in the outputs ``moved`` (a flag each), three an output."""
    found = []
    for a, b in _blocks(len(data)):
        part = data[a:min(b + 2, len(data))]
        if len(part) < 3:
            continue
        hit = (part[:-2] == MARKS[0][0]) & (part[2:] == MARKS[0][2]) & np.isin(part[1:-1], [m[1] for m in MARKS])
        found.append(a + np.flatnonzero(hit[:b - a]))
    place = np.concatenate(found) if found else np.zeros(0, np.int64)
    owner = np.searchsorted(begin, place, "right") - 1
    place = place[moved[owner] & (place + 3 <= begin[owner + 1])]
    if len(place) != 3 * moved.sum():
        raise ValueError("an output does not have its three marks")
    return place.reshape(-1, 3)


def rebuilt(outputs: list[bytes], form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends): the texts that the outputs were made from."""
    data = np.frombuffer(b"".join(outputs), np.uint8)
    size = np.array([len(t) for t in outputs], np.int64)
    begin, moved = _ends(size), form != PLAIN
    ends = _ends(size - 9 * moved)
    starts, source = np.repeat(ends[:-1, None], 3, axis=1), np.repeat(begin[:-1, None], 3, axis=1)
    at = _marks_of(data, begin, moved)
    first, second, third = at[:, 1] - at[:, 0] - 3, at[:, 2] - at[:, 1] - 3, begin[1:][moved] - at[:, 2] - 3
    psm = form[moved] == PSM
    prefix = np.where(psm, first, second)
    home = ends[:-1][moved]
    starts[moved] = np.stack([home, home + prefix, home + prefix + third], axis=1)
    source[moved] = np.stack([np.where(psm, at[:, 0], at[:, 1]), at[:, 2], np.where(psm, at[:, 1], at[:, 0])], axis=1) + 3
    # A plain text is one segment; the two empty ones that follow it must not move the next text.
    starts[~moved, 1:], source[~moved, 1:] = ends[1:][~moved, None], begin[1:][~moved, None]
    return _gather(data, starts.ravel(), (source - starts).ravel(), int(ends[-1])), ends


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, rate: int = 90, spm: int = 20) -> DataFrame:
    """``docs`` with n (code points), form, prefix_chars and middle_chars (null if plain) and output.

    ``rate`` per cent of keys are rearranged, ``spm`` per cent of those in the form spm.
    """
    kept = without(docs, ["n", "form", "prefix_chars", "middle_chars", "output"])
    at = len(kept.columns)
    rows = docs.select(*[f"`{c}`" for c in kept.columns], F.coalesce(F.col(key).cast("string"), F.lit("")),
                       F.coalesce(F.col(text).cast("string"), F.lit(""))).toDF(*[f"c{i}" for i in range(at + 2)])
    schema = extended(kept, _NEW)
    names = schema.names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(at)
            for first, texts in text_slices(batch.column(at + 1)):
                digests = b"".join(hashlib.sha256(f"{seed}:{k}".encode()).digest()[:16] for k in keys.slice(first, len(texts)).to_pylist())
                made = rearranged(texts, np.frombuffer(digests, ">u4").astype(np.int64).reshape(-1, 4), rate, spm)
                plain = made["form"] == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [c.slice(first, len(texts)) for c in batch.columns[:at]]
                    + [pa.array(made["n"]), pa.array([FORMS[f] for f in made["form"]]), pa.array(made["prefix"], mask=plain),
                       pa.array(made["middle"], mask=plain), _strings(made["out"], made["ends"])], names=names)

    return arrow_map(rows, task, schema)


def restore(rows: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``rows`` with restored: the text of each output, from the output and its form alone."""
    kept = without(rows, ["restored"])
    at = len(kept.columns)
    schema = extended(kept, "restored string")
    names = schema.names
    given = rows.select(*[f"`{c}`" for c in kept.columns], F.col(form), F.coalesce(F.col(output), F.lit(""))
                        ).toDF(*[f"c{i}" for i in range(at + 2)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = np.array([FORMS.index(f) for f in batch.column(at).to_pylist()], np.int64)
            for first, texts in text_slices(batch.column(at + 1)):
                data, ends = rebuilt(texts, forms[first:first + len(texts)])
                yield pa.RecordBatch.from_arrays([c.slice(first, len(texts)) for c in batch.columns[:at]] + [_strings(data, ends)], names=names)

    return arrow_map(given, task, schema)
