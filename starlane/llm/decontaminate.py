"""Benchmark decontamination: test n-grams as a broadcast hash set.

Words are runs of ``[0-9a-z]`` (after lower-casing A-Z) and non-ASCII
characters.  Each benchmark item yields its windows of ``n`` consecutive
words; a shorter item that has words is one window.  The window hashes are
broadcast, every document window is looked up, and each hit is verified word
by word before it counts.

Only a bounded number of windows is broadcast at once (``block_windows``,
counted before).  A larger benchmark is taken in blocks of that size: each
block is one more pass over the documents, adding to what the earlier ones
found.

Edge cases: null and empty texts have no words and no hits; a null item id
marks words but is not listed; repeated rows and ids count once; an empty
benchmark marks nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import annotate, shared_dir, written
from starlane.llm.textscan import ALNUM, Scan, in_sorted

WINDOW_WORDS = 10
# Windows broadcast at once: about 100 bytes each, so under 0.1 GB.
BLOCK_WINDOWS = 500_000
# Scanned at once: a word needs some 150 bytes of arrays beside its text.
SCAN = {"rows_at_once": 500, "chunk_bytes": 250_000}

SPANS = "array<struct<begin:bigint,end:bigint>>"


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """One row per item window: ``item, size, hash, words``."""

    def scorer():
        def score(texts):
            scan = Scan(texts, ALNUM, lower=True)
            rows = [[] for _ in texts]
            for d in range(len(texts)):
                a, c = int(scan.first[d]), int(scan.count[d])
                size = min(n, c)
                for i in range(a, a + c - size + 1) if c else ():
                    words = b" ".join(scan.bytes[scan.starts[k]:scan.ends[k]].tobytes()
                                      for k in range(i, i + size))
                    rows[d].append({"size": size, "words": words})
            return {"windows": rows}
        return score

    found = annotate(benchmark.select(F.col("item_id").cast("string").alias("item"), "text"), scorer,
                     "windows array<struct<size:int,words:binary>>", keep=["item"], **SCAN)
    return found.select("item", F.explode("windows").alias("w")).select("item", "w.size", "w.words").distinct()


class WindowTable:
    """Lookup of window hashes to their words and items (one block)."""

    def __init__(self, rows):
        self.by_size: dict[int, tuple[np.ndarray, dict]] = {}
        grouped: dict[int, dict[bytes, list]] = {}
        for item, size, words in rows:
            grouped.setdefault(size, {}).setdefault(bytes(words), []).append(item)
        for size, windows in grouped.items():
            texts = list(windows)
            _, hashes = Scan(texts, ALNUM).windows(size)
            known: dict[int, dict[bytes, list]] = {}
            for h, t in zip(hashes.tolist(), texts):
                known.setdefault(h, {})[t] = [i for i in windows[t] if i is not None]
            self.by_size[size] = (np.unique(hashes), known)

    def hits(self, scan: Scan):
        """Verified hits: (first word, window size, items)."""
        for size, (sorted_hashes, known) in self.by_size.items():
            at, hashes = scan.windows(size)
            found = np.flatnonzero(in_sorted(hashes, sorted_hashes))
            for w, h in zip(at[found].tolist(), hashes[found].tolist()):
                words = b" ".join(scan.bytes[scan.starts[k]:scan.ends[k]].tobytes()
                                  for k in range(w, w + size))
                items = known[h].get(words)
                if items is not None:
                    yield w, size, items


def _block_scorer(table):
    def scorer():
        windows = WindowTable(table.value)

        def score(texts, spans=None, items=None):
            scan = Scan(texts, ALNUM, lower=True)
            delta = np.zeros(len(scan.starts) + 1, dtype=np.int64)
            names = [set(i or ()) for i in items] if items else [set() for _ in texts]
            if spans:  # what earlier blocks found, as word positions
                for d, old in enumerate(spans):
                    for s in old or ():
                        delta[scan.first[d] + s["begin"]] += 1
                        delta[scan.first[d] + s["end"]] -= 1
            for w, size, ids in windows.hits(scan):
                delta[w] += 1
                delta[w + size] -= 1
                names[scan.doc[w]].update(ids)
            hit = np.cumsum(delta[:-1]) > 0
            n_hit = scan.per_text(hit, scan.doc)
            out, chars = [], []
            for d in range(len(texts)):
                a, c = int(scan.first[d]), int(scan.count[d])
                runs, cuts = [], []
                if n_hit[d]:
                    edge = np.diff(hit[a:a + c].astype(np.int8), prepend=np.int8(0), append=np.int8(0))
                    for b, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                        runs.append({"begin": b, "end": e})
                        cuts.append({"begin": int(scan.starts[a + b] - scan.begin[d]),
                                     "end": int(scan.ends[a + e - 1] - scan.begin[d])})
                out.append(runs)
                chars.append(cuts)
            return {"n_words": scan.count, "n_hit": n_hit, "hit_items": [sorted(x) for x in names],
                    "hit_words": out, "hit_bytes": chars}
        return score
    return scorer


def mark_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS,
              block_windows: int = BLOCK_WINDOWS, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_words, n_hit, hit_items, hit_words, hit_bytes``.

    ``hit_words``/``hit_bytes`` are merged spans of hit words (adjacent ones
    with what stands between them), as word positions and as byte offsets of
    the UTF-8 text.  ``keep`` names the
    columns to return (all by default).
    """
    spark = docs.sparkSession
    fields = ("n_words bigint, n_hit bigint, hit_items array<string>, "
              f"hit_words {SPANS}, hit_bytes {SPANS}")
    windows = written(benchmark_windows(benchmark, n), shared_dir(spark, "benchmark-windows"))
    blocks = max(1, -(-windows.count() // block_windows))
    found = docs
    for k in range(blocks):
        part = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k)
        rows = [(r["item"], r["size"], r["words"]) for r in part.collect()]  # bounded by block_windows
        table = spark.sparkContext.broadcast(rows)
        last = k == blocks - 1
        found = annotate(found, _block_scorer(table), fields, keep=keep if last else None,
                         more=["hit_words", "hit_items"] if k else None, **SCAN)
        if not last:
            found = written(found, shared_dir(spark, "decontaminate"))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "document", **options) -> DataFrame:
    """Remove contaminated documents, or with ``action="span"`` the hit words.

    Columns stay those of ``docs``.  A span cut leaves the text before and
    after it; untouched texts come back byte for byte, null included.
    """
    # the row travels whole, so its columns may have any names
    rows = docs.select(F.struct("*").alias("row"), "text")
    if action == "document":
        return mark_hits(rows, benchmark, **options, keep=["row"]).where("n_hit = 0").select("row.*")
    if action != "span":
        raise ValueError("action is 'document' or 'span'")
    marked = mark_hits(rows, benchmark, **options)

    def scorer():
        def score(texts, spans):
            cut = []
            for t, ss in zip(texts, spans):
                parts, at = [], 0
                for s in ss or ():
                    parts.append(t[at:s["begin"]])
                    at = s["end"]
                cut.append(b"".join([*parts, t[at:]]).decode())
            return {"cut_text": cut}
        return score

    kept = annotate(marked, scorer, "cut_text string", more=["hit_bytes"], **SCAN)
    return kept.select(*[F.when(F.col("n_hit") > 0, F.col("cut_text")).otherwise(F.col("text")).alias(c)
                         if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def digest(marked: DataFrame) -> DataFrame:
    """The query's columns from the operator's output."""
    items = F.col("hit_items")
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(items)), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
