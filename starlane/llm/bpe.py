"""BPE encoding and decoding: speculate, verify, merge only what fails.

For a word's characters (byte-level alphabet, the last one with the word-end
mark) greedy longest match proposes tokens.  The proposal is the word's BPE
encoding if every adjacent pair of tokens is compatible, that is if the two
tokens' joined text encodes to exactly these two.  Pairs are checked as
arrays against a table of known pairs; unknown pairs are settled by exact
merging of the pair alone, and only words with an incompatible pair are
merged exactly as a whole.

Texts are normalised and cut as the vocabulary file asks: NFC, white space,
lower case; contractions, letter runs, single numbers, other runs.  Special
tokens in a text get their own ids.  Decoding joins token strings with a
space, as the file names no decoder.

Edge cases: null and empty texts have no tokens and decode to the empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
from pyspark.sql import DataFrame

from starlane.llm.common import annotate, worker_state
from starlane.llm.pretoken import PieceCache, Pieces, ids_by_text

# the arrays of a scan, ids and decoded texts are several times the text taken at once
SCAN = {"rows_at_once": 500, "chunk_bytes": 250_000}
END_MARK = ""  # one private character for the word end while matching


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Speculative encoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]

        def inner(t):
            return t[:-len(self.suffix)] + END_MARK if t.endswith(self.suffix) else t

        self.id_of = {inner(t): i for t, i in model["vocab"].items()}
        self.token = {i: t for t, i in self.id_of.items()}
        self.string = {i: t for t, i in model["vocab"].items()}
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault((inner(left), inner(right)), rank)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.string |= {i: t for t, i in self.special.items()}
        self.alphabet = [c for _, c in sorted(byte_alphabet().items())]
        self.longest = max(map(len, self.id_of))
        self.width = max(self.string) + 1
        self.pairs = np.empty(0, dtype=np.int64)       # known pair codes, sorted
        self.compatible = np.empty(0, dtype=bool)
        self.cache = PieceCache(self.encode_words)
        self.merged = 0                                # words that needed exact merging

    def symbols(self, word: str) -> str:
        a = self.alphabet
        return "".join([a[b] for b in word.encode()]) + END_MARK

    def propose(self, s: str) -> list[int] | None:
        """Greedy longest match; the end mark never stands alone."""
        out, at, n, get = [], 0, len(s), self.id_of.get
        while at < n:
            for stop in range(min(n, at + self.longest), at, -1):
                if stop == n - 1:
                    continue
                i = get(s[at:stop])
                if i is not None:
                    break
            else:
                return None
            out.append(i)
            at = stop
        return out

    def merge(self, s: str) -> list[int]:
        """Exact merging: the best-ranked pair first, leftmost among equals."""
        parts = list(s)
        if parts[-1] == END_MARK:
            parts[-2:] = [parts[-2] + END_MARK]
        ranks = self.ranks
        while 1 < len(parts) <= 16:
            ranked = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
            if not ranked:
                return [self.id_of[p] for p in parts]
            i = min(ranked)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        # neighbours as a linked list, pairs in a heap: n log n for long words
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or ranks.get((parts[i], parts[j])) != rank:
                continue  # the pair has been merged away
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := ranks.get((parts[k], parts[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k))
        return [self.id_of[p] for p in parts if p is not None]

    def check_pairs(self, codes: np.ndarray) -> np.ndarray:
        """Compatibility of pair codes (left id * width + right id)."""
        distinct = np.unique(codes)
        new = distinct[~np.isin(distinct, self.pairs, assume_unique=True)]
        if len(new):
            verdict = []
            for code in new.tolist():
                left, right = divmod(code, self.width)
                verdict.append(self.merge(self.token[left] + self.token[right]) == [left, right])
            order = np.argsort(codes_all := np.concatenate([self.pairs, new]))
            self.compatible = np.concatenate([self.compatible, np.array(verdict, dtype=bool)])[order]
            self.pairs = codes_all[order]
        return self.compatible[np.searchsorted(self.pairs, codes)]

    def encode_words(self, words: list[str]) -> tuple[list[list[int]], list[str]]:
        """Ids of each word and its decoded form (token strings, spaced)."""
        strings = [self.symbols(w) for w in words]
        found = [self.propose(s) for s in strings]
        left, right, owner = [], [], []
        for k, ids in enumerate(found):
            if ids is not None and len(ids) > 1:
                left += ids[:-1]
                right += ids[1:]
                owner += [k] * (len(ids) - 1)
        wrong = {k for k, ids in enumerate(found) if ids is None}
        if owner:
            good = self.check_pairs(np.array(left, dtype=np.int64) * self.width + np.array(right))
            wrong.update(np.array(owner)[~good].tolist())
        for k in wrong:
            found[k] = self.merge(strings[k])
        self.merged += len(wrong)
        return found, [" ".join([self.string[i] for i in ids]) for ids in found]

    def normalise(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        # lower case character by character: no final-sigma rule
        return text.replace("Σ", "σ").lower()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """Ids and decoded text of each text."""
        if any(s in t for s in self.special for t in texts if "<" in t):
            return self._with_special(texts)
        pieces = Pieces([self.normalise(t) for t in texts]).words()
        if not len(pieces.starts):
            return [np.empty(0, dtype=np.uint32) for _ in texts], ["" for _ in texts]
        slots = self.cache.lookup(pieces)
        ids, sizes = self.cache.gather(slots)
        per_text = np.bincount(pieces.doc, weights=sizes, minlength=len(texts)).astype(np.int64)
        names = self.cache.names
        words = [names[s] for s in slots.tolist()]
        stops = np.cumsum(np.bincount(pieces.doc, minlength=len(texts)))
        begins = stops - np.bincount(pieces.doc, minlength=len(texts))
        return (np.split(ids, np.cumsum(per_text)[:-1]),
                [" ".join(words[b:e]) for b, e in zip(begins.tolist(), stops.tolist())])

    def _with_special(self, texts):
        """Cut the texts at special tokens, encode between, join again."""
        import re

        cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        parts = [cut.split(t) for t in texts]
        plain, decoded = self.encode([p for ps in parts for p in ps[::2]])
        out_ids, out_text, k = [], [], 0
        for ps in parts:
            ids, text = [], []
            for i, p in enumerate(ps):
                if i % 2:
                    ids.append(np.array([self.special[p]], dtype=np.uint32))
                    text.append(p)
                else:
                    ids.append(plain[k])
                    text.append(decoded[k])
                    k += 1
            out_ids.append(np.concatenate(ids))
            out_text.append(" ".join(t for t in text if t))
        return out_ids, out_text

    def decode(self, ids) -> str:
        return " ".join([self.string[i] for i in ids])


def worker_bpe(path: str) -> WordBpe:
    return worker_state(f"bpe:{path}", lambda: WordBpe(path))


def encode_decode(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``token_ids`` (array) and ``decoded`` text."""

    def scorer():
        bpe = worker_bpe(path)

        def score(texts):
            ids, _ = bpe.encode([t.decode() for t in texts])
            return {"token_ids": [i.tolist() for i in ids], "decoded": [bpe.decode(i.tolist()) for i in ids]}
        return score

    return annotate(docs, scorer, "token_ids array<bigint>, decoded string", keep=keep, **SCAN)


def encode_digests(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``n_tokens`` and SHA-256 of the ids and of the decoded text, without
    moving ids or texts out of the task that made them."""

    def scorer():
        bpe = worker_bpe(path)

        def score(texts):
            ids, decoded = bpe.encode([t.decode() for t in texts])
            return {"n_tokens": [len(i) for i in ids],
                    "ids_sha256": [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
                    "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in decoded]}
        return score

    return annotate(docs, scorer, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", keep=keep, **SCAN)
