"""Word shingles of texts as 64-bit hashes, computed with numpy over many texts at once.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return, with A-Z lower-cased. A shingle is five words in a row; a text with fewer words has
its whole sequence as its one shingle, and one without words has none. Equal shingles have equal
hashes; two different ones of a corpus meet with a chance of about pairs / 2**64.
"""

from __future__ import annotations

import numpy as np

from .common import mix64

WORDS = 5
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_rng = np.random.default_rng(5)
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
BYTE[ord("A"):ord("Z") + 1] = BYTE[ord("a"):ord("z") + 1]
PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for i, b in enumerate((BASE, BASE_INVERSE)):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            _powers[i] = np.multiply.accumulate(row)
    return _powers[0][:n], _powers[1][:n]


def hashed_words(texts: list[bytes], space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the words of all texts in order; text i's end before ``ends[i]``.

    ``space`` says of every byte value whether it parts words (a space must).
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    parts = space[data]
    starts = np.flatnonzero(~parts & np.concatenate([[True], parts[:-1]]))
    stops = np.flatnonzero(parts & np.concatenate([[False], ~parts[:-1]]))
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE[data] * up[:-1], dtype=np.uint64)])
    words = mix64((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    return words, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the shingles of all texts in order; text i's end before ``ends[i]``."""
    words, word_ends = hashed_words(texts)
    n_words = np.diff(word_ends, prepend=0)
    whole = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        whole += words[k:len(whole) + k] * PLACE[k]
    whole = mix64(whole)
    n_out = np.where(n_words >= WORDS, n_words - WORDS + 1, np.minimum(n_words, 1))
    ends = np.cumsum(n_out)
    # Where text i's shingles stand in ``whole``: at its first word.
    take = np.arange(ends[-1]) + np.repeat(word_ends - n_words - ends + n_out, n_out)
    few = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    out = whole[np.minimum(take, len(whole) - 1)] if len(whole) else np.zeros(ends[-1], np.uint64)
    for i in few:
        own = words[word_ends[i] - n_words[i]:word_ends[i]]
        out[ends[i] - 1] = mix64(np.array([(own * PLACE[:len(own)]).sum(dtype=np.uint64) ^ np.uint64(len(own))]))[0]
    return out, ends


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct shingles of each text, in ascending order."""
    hashes, ends = shingles(texts)
    return [np.unique(hashes[a:b]) for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]
