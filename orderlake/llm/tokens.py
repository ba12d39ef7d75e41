"""Token ids of whole texts by a public tokenizer, fast on text made of words.

Both public vocabularies used here cut a text before every run of white space and, apostrophes
aside, wherever letters meet other characters, and never join pieces across such a cut. So the ids
of a text are those of its pieces in a row. A worker keeps the ids of pieces it has met (a bounded
cache, filled by the tokenizers library). Some texts at a time, numpy cuts them into pieces, finds
those known in a table of their bytes and glues their ids; one call of the library encodes all new
ones. A text with an apostrophe is cut at white space only. Texts with characters for which the cut isn't safe (other white space,
scripts beyond Latin, the text of a special token) go to the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np

from .common import mix64

#: Pieces whose ids a worker keeps, in some 70 bytes each; beyond that it starts anew.
CACHE_WORDS = 2_000_000
#: Characters of the texts that are encoded at a time; a longer text is encoded alone.
AT_ONCE = 1 << 17
#: White space is plain, letters are ASCII or Latin-1 (composed), and no special token can occur.
SAFE = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]*")
LETTERS = re.compile("[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]")
#: Kinds of Latin-1 characters: 0 between texts, 1 white space, 2 letters, 3 others.
KIND = np.array([0 if not c else 1 if chr(c).isspace() else 2 if LETTERS.match(chr(c)) else 3 for c in range(256)], np.uint8)
#: Bytes of a piece that the table holds, as four numbers; longer pieces are kept by a dictionary.
ROW = 32
MASKS = np.array([[255] * n + [0] * (ROW - n) for n in range(ROW + 1)], np.uint8).view(np.uint64)
MIX = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class Words:
    """Ids of pieces, stored one after the other; with ``spaced`` the white space before a piece belongs to it."""

    def __init__(self, path: str, spaced: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer, self.spaced = Tokenizer.from_file(path), spaced
        self.clear()

    def clear(self) -> None:
        self.count = self.used = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)  # ends[i + 1]: where piece i's ids end
        self.rows = np.zeros((1 << 14, 4), np.uint64)  # the bytes of piece i, zeros after them
        self.slots = np.full(1 << 15, -1, np.int32)  # a piece stands in the slot of its hash or the next free one
        self.long: dict[bytes, int] = {}

    def slot_of(self, rows: np.ndarray) -> np.ndarray:
        h = mix64(rows[:, 0] ^ mix64(rows[:, 1] * MIX[1] + rows[:, 2] * MIX[2] + rows[:, 3] * MIX[3]))
        return (h & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def find(self, rows: np.ndarray) -> np.ndarray:
        """The numbers of pieces, -1 for those not in the table."""
        slot = self.slot_of(rows)
        out = self.slots[slot]
        left = np.flatnonzero(((self.rows[out] == rows).view(np.uint32)[:, 0] != 0x01010101) & (out >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)
            out[left] = at = self.slots[slot[left]]
            left = left[(self.rows[at] != rows[left]).any(1) & (at >= 0)]
        return out

    def place(self, numbers: np.ndarray) -> None:
        """Give each of these pieces a slot of its own."""
        slot = self.slot_of(self.rows[numbers])
        while len(numbers):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = numbers[free]
            left = self.slots[slot] != numbers
            numbers, slot = numbers[left], (slot[left] + 1) & (len(self.slots) - 1)

    def learn(self, pieces: list[bytes]) -> None:
        """Ask the library for the ids of new pieces and keep them, numbered from ``count``."""
        got = self.tokenizer.encode([p.decode("latin-1") for p in pieces], is_pretokenized=True, add_special_tokens=False)
        ids, k, n = np.array(got.ids, np.uint32), self.count, self.count + len(pieces)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + 1 > len(self.ends):
            self.ends, self.rows = (np.concatenate([x, np.zeros_like(x)]) for x in (self.ends, self.rows))
        self.flat[self.used:self.used + len(ids)] = ids
        self.ends[k + 1:n + 1] = self.used + np.cumsum(np.bincount(np.array(got.word_ids, np.int64), minlength=len(pieces)))
        self.used += len(ids)
        self.count = n
        self.long.update((p, k + i) for i, p in enumerate(pieces) if len(p) > ROW)
        self.rows[k:n] = np.frombuffer(b"".join(p.ljust(ROW, b"\0") if len(p) <= ROW else bytes(ROW) for p in pieces), np.uint64).reshape(-1, 4)
        if 2 * n > len(self.slots):
            while 2 * n > len(self.slots):
                self.slots = np.full(2 * len(self.slots), -1, np.int32)
            k = 0
        numbers = np.arange(k, n, dtype=np.int32)
        self.place(numbers[self.rows[k:n, 0] != 0])

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in the order of the texts."""
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > AT_ONCE:
                yield from self._encoded(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        if held:
            yield from self._encoded(held)

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        safe = [t if SAFE.fullmatch(t) and "<|" not in t else None for t in texts]
        raw = "\0".join(["", *[t or "" for t in safe], ""]).encode("latin-1")
        bounds = 1 + np.cumsum([0] + [len(t or "") + 1 for t in safe])
        begin, length = self.cut(raw, [(bounds[i], bounds[i + 1]) for i, t in enumerate(safe) if t and "'" in t])
        ids, to = np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        if len(begin):
            at = self.numbers(raw, begin, length)
            size = self.ends[at + 1] - self.ends[at]
            ends = np.cumsum(size)
            ids = self.flat[np.repeat(self.ends[at] - ends + size, size) + np.arange(ends[-1])]
            to = np.concatenate([[0], ends])[np.searchsorted(begin, bounds)]
        for i, (text, known) in enumerate(zip(texts, safe)):
            yield ids[to[i]:to[i + 1]] if known is not None else np.array(
                self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def cut(self, raw: bytes, uncut: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces begin and how long they are; between the bounds ``uncut`` they end at white space only."""
        kind = KIND[np.frombuffer(raw, np.uint8)]
        for a, b in uncut:
            np.minimum(kind[a:b], 2, out=kind[a:b])
        fresh = kind[1:] != kind[:-1]
        if self.spaced:
            fresh &= (kind[:-1] != 1) | (kind[1:] == 0)
        edge = np.flatnonzero(fresh) + 1
        begin, length = edge[:-1], np.diff(edge)
        piece = kind[begin] > (0 if self.spaced else 1)
        return begin[piece], length[piece]

    def numbers(self, raw: bytes, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The number of each piece; those not met before are learned."""
        if self.count >= CACHE_WORDS:
            self.clear()
        window = np.lib.stride_tricks.sliding_window_view(np.frombuffer(raw + bytes(ROW), np.uint8), ROW)
        rows = window[begin].view(np.uint64) & MASKS[np.minimum(length, ROW)]
        big = np.flatnonzero(length > ROW)
        rows[big] = 0
        at = self.find(rows)
        at[big] = [self.long.get(raw[a:a + n], -1) for a, n in zip(begin[big].tolist(), length[big].tolist())]
        if len(new := np.flatnonzero(at < 0)):
            number: dict[bytes, int] = {}
            at[new] = [number.setdefault(raw[a:a + n], self.count + len(number)) for a, n in zip(begin[new].tolist(), length[new].tolist())]
            self.learn(list(number))
        return at

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))


@cache
def words(path: str, spaced: bool) -> Words:
    return Words(path, spaced)


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
