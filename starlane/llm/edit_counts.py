"""Token counts that follow edits, from pre-token segment trees.

A document's state is a segment tree over its pre-tokens: leaves hold runs of
``LEAF_PIECES`` pre-tokens, every node the characters and the tokens below it.
Leaves begin at pre-token cuts, and the byte-level pattern looks at most two
characters past a pre-token's end and never back, so after an edit

* leaves that end two or more characters before it are untouched,
* from the first old cut at or after its end that is a cut of the new text
  again, everything is as before.

Only the leaves in between are cut and encoded again; their sums and those of
their ancestors are updated.  Counts equal those of encoding the new text as a
whole, special strings being ordinary text.

Edge cases: null and empty texts have an empty tree; edits are given in
characters of the old text, sorted and made disjoint (of overlapping edits
the first wins; positions beyond the text are its end); no edits change
nothing; repeated rows have equal states.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.byte_tokens import ByteTokens, worker_tokens
from starlane.llm.common import annotate
from starlane.llm.pretoken import Pieces

LEAF_PIECES = 64
MAX_LEAF_PIECES = 512     # a leaf that grew beyond this is split at the next chance
LOOK_AHEAD = 2
ROWS_AT_ONCE = 96          # a chunk of texts costs some ten arrays and a tree several numbers a word
EDIT = "struct<begin:int,end:int,replacement:string>"
TREE = "tree_chars array<int>, tree_tokens array<int>"


class SegmentTree:
    """Sums over leaves in two implicit binary heaps (node 1 is the root)."""

    def __init__(self, chars: list[int], tokens: list[int]):
        width = 1 << max(0, (max(len(chars), 1) - 1).bit_length())
        self.width = width
        self.chars, self.tokens = ([0] * (2 * width) for _ in range(2))
        self.chars[width:width + len(chars)] = chars
        self.tokens[width:width + len(tokens)] = tokens
        for heap in (self.chars, self.tokens):
            for node in range(width - 1, 0, -1):
                heap[node] = heap[2 * node] + heap[2 * node + 1]

    @classmethod
    def load(cls, chars, tokens) -> SegmentTree:
        tree = cls.__new__(cls)
        tree.chars, tree.tokens = list(chars), list(tokens)
        tree.width = len(tree.chars) // 2
        return tree

    def find(self, position: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf holding ``position``."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if position >= before + self.chars[node] and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return node - self.width, before

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.width
        self.chars[node], self.tokens[node] = chars, tokens
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]


def _leaves(pieces: Pieces, counts: np.ndarray, a: int, b: int, size: int = LEAF_PIECES):
    """(chars, tokens) lists of leaves over pieces ``a`` to ``b``."""
    at = np.arange(a, b, size)
    if not len(at):
        return [], []
    tokens = np.add.reduceat(counts[a:b], at - a)
    ends = np.append(pieces.starts[at[1:]], pieces.ends[b - 1])
    return (ends - pieces.starts[at]).tolist(), tokens.tolist()


def build(texts: list[str], tokens: ByteTokens) -> list[SegmentTree]:
    pieces = Pieces(texts).byte_level()
    counts = tokens.cache.counts(pieces)
    stops = np.cumsum(np.bincount(pieces.doc, minlength=len(texts)))
    out, a = [], 0
    for b in stops.tolist():
        out.append(SegmentTree(*_leaves(pieces, counts, a, b)))
        a = b
    return out


def clean_edits(edits, length: int) -> list[tuple[int, int, str]]:
    out, last = [], 0
    for e in sorted(edits or (), key=lambda e: (e["begin"], e["end"])):
        begin = min(max(e["begin"], 0), length)
        end = min(max(e["end"], begin), length)
        if begin >= last:
            out.append((begin, end, e["replacement"] or ""))
            last = end
    return out


def apply_edit(old: str, final: str, tree: SegmentTree, begin: int, end: int, size: int, shift_before: int,
               tokens: ByteTokens) -> tuple[SegmentTree, int]:
    """(tree, characters encoded again) after one edit.

    Edits are applied from the last to the first: left of ``begin`` stands the
    ``old`` text still, right of it the ``final`` one, where positions are
    larger by ``shift_before`` (what the edits before this one add)."""
    shift = size - (end - begin)
    total = tree.chars[1] + shift

    def new(a: int, b: int) -> str:
        return old[a:min(b, begin)] + final[max(a, begin) + shift_before:b + shift_before]

    if not tree.chars[1]:
        return build([new(0, total)], tokens)[0], total
    first, start = tree.find(max(begin - LOOK_AHEAD, 0))
    last, at = tree.find(max(end - 1, 0))
    stop = at + tree.chars[last + tree.width]
    while True:
        # cut what the leaves first..last now hold, with context after it
        goal = stop + shift
        whole = goal >= total
        context = total if whole else min(total, goal + 64)
        pieces = Pieces([new(start, context)]).byte_level()
        if whole:
            n = len(pieces.starts)
            stop, last = tree.chars[1], tree.width - 1
            break
        # a cut at the old leaf end that its two following characters confirm
        n = int(np.searchsorted(pieces.ends, goal - start, side="right"))
        sure = context == total or goal + LOOK_AHEAD <= context
        if stop >= end and sure and (pieces.ends[n - 1] if n else 0) == goal - start:
            break
        last += 1  # not a cut any more: take the next leaf in
        while last < tree.width and not tree.chars[last + tree.width]:
            last += 1
        stop += tree.chars[last + tree.width]
    pieces.starts, pieces.ends, pieces.doc = pieces.starts[:n], pieces.ends[:n], pieces.doc[:n]
    pieces.hashes = pieces.hashes[:n]
    counts = tokens.cache.counts(pieces)
    for leaf in range(first + 1, last + 1):
        if tree.chars[leaf + tree.width]:
            tree.set(leaf, 0, 0)
    if n <= MAX_LEAF_PIECES:
        tree.set(first, max(stop + shift - start, 0), int(counts.sum()))
    else:  # too much for one leaf: new leaves in its place, the sums of the others stay
        w = tree.width
        chars, sums = _leaves(pieces, counts, 0, n)
        old_c, old_t = tree.chars[w:2 * w], tree.tokens[w:2 * w]
        tree = SegmentTree(old_c[:first] + chars + old_c[last + 1:], old_t[:first] + sums + old_t[last + 1:])
    return tree, max(stop + shift - start, 0)


def apply_edits(text: str, tree: SegmentTree, edits, tokens: ByteTokens) -> tuple[str, SegmentTree, int]:
    """(new text, tree, characters encoded again) after all edits of a text.

    The new text is joined once, and each edit looks at a few leaves of it."""
    todo = clean_edits(edits, len(text))
    parts, at, shifts, shift = [], 0, [], 0
    for begin, end, replacement in todo:
        parts += [text[at:begin], replacement]
        at = end
        shifts.append(shift)
        shift += len(replacement) - (end - begin)
    final = "".join([*parts, text[at:]])
    again = 0
    for (begin, end, replacement), before in zip(reversed(todo), reversed(shifts)):
        tree, n = apply_edit(text, final, tree, begin, end, len(replacement), before, tokens)
        again += n
    return final, tree, again


def token_trees(docs: DataFrame, tokenizer: str, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the state ``tree_chars, tree_tokens`` and ``n_tokens``."""

    def scorer():
        tokens = worker_tokens(tokenizer, special=False)

        def score(texts):
            trees = build([t.decode() for t in texts], tokens)
            return {"tree_chars": [t.chars for t in trees], "tree_tokens": [t.tokens for t in trees],
                    "n_tokens": [t.tokens[1] for t in trees]}
        return score

    return annotate(docs, scorer, f"{TREE}, n_tokens bigint", keep=keep, rows_at_once=ROWS_AT_ONCE)


def update_trees(state: DataFrame, tokenizer: str, edits: str = "edits", keep: list[str] | None = None,
                 with_text: bool = True) -> DataFrame:
    """Apply the ``edits`` column to ``state``: new text, trees and counts,
    with ``n_tokens_before`` and ``n_reencoded`` (characters encoded again)."""

    def scorer():
        tokens = worker_tokens(tokenizer, special=False)

        def score(texts, chars, sums, changes):
            rows = []
            for t, c, s, e in zip(texts, chars, sums, changes):
                tree = SegmentTree.load(c, s)
                rows.append((tree.tokens[1], *apply_edits(t.decode(), tree, e, tokens)))
            out = {"tree_chars": [r[2].chars for r in rows], "tree_tokens": [r[2].tokens for r in rows],
                   "n_tokens_before": [r[0] for r in rows], "n_tokens": [r[2].tokens[1] for r in rows],
                   "n_reencoded": [r[3] for r in rows], "n_chars": [r[2].chars[1] for r in rows]}
            return out | ({"text": [r[1] for r in rows]} if with_text else {})
        return score

    fields = f"{TREE}, n_tokens_before bigint, n_tokens bigint, n_reencoded bigint, n_chars bigint"
    return annotate(state, scorer, fields + (", text string" if with_text else ""), keep=keep,
                    more=["tree_chars", "tree_tokens", edits], rows_at_once=ROWS_AT_ONCE)


# Personal data that a corpus revision masks.
MASKS = ((r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]"),
         (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "[IP]"),
         (r"\b\d[\d -]{6,}\d\b", "[NUMBER]"))


def revision_edits(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the ``edits`` of a revision: personal data masked, runs of
    spaces cut to one and an attribution line appended."""

    def scorer():
        import re

        rules = [(re.compile(p), r) for p, r in MASKS] + [(re.compile(r" {2,}"), " ")]

        def score(texts, notes):
            out = []
            for t, note in zip(texts, notes):
                t = t.decode()
                found = [{"begin": m.start(), "end": m.end(), "replacement": r} for p, r in rules for m in p.finditer(t)]
                out.append(found + [{"begin": len(t), "end": len(t), "replacement": note}])
            return {"edits": out}
        return score

    # concat_ws skips nulls: a row without source or language gets a shorter line
    noted = docs.withColumn("note", F.concat(F.lit("\nSource: "), F.concat_ws(", ", "source", "lang"), F.lit(".")))
    names = docs.columns if keep is None else keep
    return annotate(noted, scorer, f"edits array<{EDIT}>", keep=[c for c in names if c != "note"], more=["note"],
                    rows_at_once=ROWS_AT_ONCE)
