"""Vectorised pre-tokenisation over code points, and a worker's word cache.

Both public vocabularies cut a text into pre-tokens that are then merged
independently.  The cuts are found with numpy for a whole chunk of texts, and
each distinct pre-token is encoded once per worker and cached, so the cost per
occurrence is a hash and a table look-up.
"""

from __future__ import annotations

import numpy as np

from starlane.llm.textscan import span_hashes

SPACE, LETTER, NUMBER, OTHER, END = 0, 1, 2, 3, 4
# The contractions that both patterns cut off as tokens.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

_CLASSES: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number or other."""
    if not _CLASSES:
        import regex

        at = np.concatenate([np.arange(0xD800, dtype=np.uint32), np.arange(0xE000, 0x110000, dtype=np.uint32)])
        text = at.astype("<u4").tobytes().decode("utf-32-le")
        table = np.full(0x110000, OTHER, dtype=np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, text):
                table[at[m.start():m.end()]] = kind
        _CLASSES.append(table)
    return _CLASSES[0]


class Pieces:
    """Pre-tokens of a chunk: ``starts``/``ends`` into ``text``, ``doc`` of each."""

    def __init__(self, texts: list[str]):
        self.text = "\n".join(texts) + "\n"
        self.points = np.frombuffer(self.text.encode("utf-32-le"), dtype=np.uint32)
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.begin = np.zeros(len(texts), dtype=np.int64)
        np.cumsum(sizes[:-1] + 1, out=self.begin[1:])
        self.end = self.begin + sizes
        self.kind = char_classes()[self.points]
        self.kind[self.end] = END

    def _contractions(self, starts: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Cut ``'s 't 're 've 'm 'll 'd`` off where an allowed apostrophe stands."""
        p, n = self.points, len(self.points)
        for at in np.flatnonzero(allowed & (p == 0x27)).tolist():
            tail = self.text[at + 1:at + 3]
            for c in CONTRACTIONS:
                if tail.startswith(c) and self.kind[at + 1] == LETTER:
                    starts[at] = True
                    starts[at + 1:at + 1 + len(c)] = False
                    if at + 1 + len(c) < n:
                        starts[at + 1 + len(c)] = True
                    break
        return starts

    def byte_level(self) -> Pieces:
        """Cuts of the byte-level pattern (a space goes with the run after it;
        of other white space before a word the last character stands alone)."""
        k, p = self.kind, self.points
        before = np.concatenate(([END], k[:-1]))
        after = np.concatenate((k[1:], [END]))
        space_before = np.concatenate(([False], (p[:-1] == 0x20) & (k[:-1] == SPACE)))
        solid = (k != SPACE) & (k != END)
        starts = (k != before) & (k != END)
        starts &= ~(solid & space_before)                  # attached to the space
        starts |= (k == SPACE) & (after != SPACE) & (after != END)  # last of a white-space run
        free = solid & (before != OTHER) & ~space_before
        starts = self._contractions(starts, free)
        return self._spans(starts & (k != END), k != END)

    def words(self) -> Pieces:
        """Cuts of the word pattern: letter runs, single numbers, other runs."""
        k = self.kind
        before = np.concatenate(([END], k[:-1]))
        inside = (k != SPACE) & (k != END)
        starts = inside & ((k != before) | (k == NUMBER))
        starts = self._contractions(starts, inside & (before != OTHER))
        return self._spans(starts & inside, inside)

    def _spans(self, starts: np.ndarray, inside: np.ndarray) -> Pieces:
        self.starts = np.flatnonzero(starts)
        # a piece ends where the next begins or where its run ends
        stop = np.flatnonzero(starts | ~inside)
        self.ends = stop[np.searchsorted(stop, self.starts, side="right")]
        self.doc = np.searchsorted(self.begin, self.starts, side="right") - 1
        self.hashes = span_hashes(self.points, self.starts, self.ends)
        return self

    def piece(self, i: int) -> str:
        return self.text[self.starts[i]:self.ends[i]]


class PieceCache:
    """Token ids of known pre-tokens by hash; bounded, refilled when full."""

    def __init__(self, encode_pieces, limit: int = 400_000):
        self.encode_pieces, self.limit = encode_pieces, limit
        self.clear()

    def clear(self):
        self.known = np.empty(0, dtype=np.uint64)   # hashes, sorted (a dict of them is ten times as large)
        self.slots = np.empty(0, dtype=np.int64)     # slot of each
        self.at = np.zeros(1 << 12, dtype=np.int64)
        self.size = np.zeros(1 << 12, dtype=np.int64)
        self.ids = np.zeros(1 << 14, dtype=np.uint32)
        self.used = 0
        self.names: list = []   # whatever else the encoder returns per piece

    @staticmethod
    def _room(array, n):
        if n <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(n, 2 * len(array)) - len(array), dtype=array.dtype)])

    def lookup(self, pieces: Pieces) -> np.ndarray:
        """Slot of every piece, encoding the distinct new ones first."""
        if len(self.known) > self.limit or self.used > 20 * self.limit:
            self.clear()
        distinct, first, back = np.unique(pieces.hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        slots = np.full(len(distinct), -1, dtype=np.int64)
        if len(self.known):
            near = np.minimum(place, len(self.known) - 1)
            slots = np.where(self.known[near] == distinct, self.slots[near], -1)
        new = np.flatnonzero(slots < 0)
        if len(new):
            strings = [pieces.piece(i) for i in first[new].tolist()]
            encoded, names = self.encode_pieces(strings)
            base = len(self.known)
            sizes = np.fromiter((len(e) for e in encoded), dtype=np.int64, count=len(encoded))
            total = int(sizes.sum())
            self.at = self._room(self.at, base + len(new))
            self.size = self._room(self.size, base + len(new))
            self.ids = self._room(self.ids, self.used + total)
            self.at[base:base + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.size[base:base + len(new)] = sizes
            self.ids[self.used:self.used + total] = np.fromiter(
                (i for e in encoded for i in e), dtype=np.uint32, count=total)
            self.used += total
            self.names.extend(names)
            slots[new] = np.arange(base, base + len(new))
            self.known = np.insert(self.known, place[new], distinct[new])
            self.slots = np.insert(self.slots, place[new], slots[new])
        return slots[back]

    def counts(self, pieces: Pieces) -> np.ndarray:
        """Number of ids of every piece."""
        slots = self.lookup(pieces)  # first: it may grow the arrays
        return self.size[slots]

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in order, number of ids of each piece)."""
        sizes = self.size[slots]
        shift = self.at[slots] - (np.cumsum(sizes) - sizes)
        return self.ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))], sizes


def ids_by_text(pieces: Pieces, cache: PieceCache, n_texts: int) -> list[np.ndarray]:
    """Token ids of each text of a chunk."""
    if not len(pieces.starts):
        return [np.empty(0, dtype=np.uint32)] * n_texts
    ids, sizes = cache.gather(cache.lookup(pieces))
    per_text = np.bincount(pieces.doc, weights=sizes, minlength=n_texts).astype(np.int64)
    return np.split(ids, np.cumsum(per_text)[:-1])
