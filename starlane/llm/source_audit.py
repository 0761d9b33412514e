"""Source divergence audit: how far each source's word use lies from the
other sources and from the whole of its language.

The steps are those of a CountVectorizer per language with ``minDF`` and the
largest integer as ``vocabSize`` (so no term is cut), and of a Summarizer per
group: every document becomes an exact sparse vector of term counts, the
vectors of a (lang, source) group are summed, with the number of non-zeros,
and a language keeps the terms that are in at least ``min_docs`` of its
documents.  A vocabulary has no bound, so it is a table here, one row a term,
and neither collected nor broadcast; a vector's coordinates are the terms
themselves.  ``vocabulary`` gives them their integer index where one is wanted.

With N the group's count and V the size of the language's vocabulary, every
kept term has ``p = 1 + floor(1e9 * (count + 1) / (N + V))`` in the group; the
divergence of p from q is ``floor((p - q)^2 / q)``.  All of it is integers.

Pairs of sources are evaluated sparsely: the terms that a source lacks all
have the same p there, so a pair's sum is that of two histograms of counts and
of a correction for the terms that both have.  The corrections are summed in
the tasks that hold the terms: what is shuffled is a row a pair and slice, not
a row a pair and term.

Hot sources and words: document vectors are summed before the shuffle, a
term's row holds one count a source, and the first ranks are picked in each
task before rows move.

Edge cases: null text, lang and source count as empty; an empty or wordless
text is a document without terms; repeated rows are documents of their own;
ties of value are broken by the item's UTF-8 bytes; a language without kept
terms has pairs of value 0 and no terms; a lone source has no pairs; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlane.llm.common import annotate, one_by_one, shared_dir, written
from starlane.llm.components import BROADCAST_ROWS, if_small
from starlane.llm.textscan import Scan
from starlane.operators.keys import assign_dense_keys

MIN_DOCS = 3            # minDF
TOP_TERMS = 200         # ranks of the term report
SCALE = 1_000_000_000
SLICE_PAIRS = 1_000_000     # pairs of counts evaluated at once; bounds memory only
LETTERS = np.zeros(256, dtype=bool)     # terms [a-z and non-ASCII]+
LETTERS[0x61:0x7B] = True
LETTERS[0x80:] = True


def _vectors(texts: list[bytes]) -> dict:
    """Distinct terms of each text and their counts, as Arrow lists."""
    import pyarrow as pa

    scan = Scan(texts, LETTERS, lower=True)
    ends = np.cumsum(scan.ends - scan.starts)
    at = np.concatenate([[0], ends]).astype(np.int64)
    letters = scan.bytes[scan.inside]
    words = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(at), pa.py_buffer(letters)).dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(len(words.dictionary), 1)
    cells, counts = np.unique(scan.doc * size + codes, return_counts=True)
    lists = np.searchsorted(cells, np.arange(len(texts) + 1) * size).astype(np.int32)
    terms = words.dictionary.take(pa.array(cells % size)).cast(pa.string())
    return {"terms": pa.ListArray.from_arrays(pa.array(lists), terms),
            "counts": pa.ListArray.from_arrays(pa.array(lists), pa.array(counts.astype(np.int64)))}


def document_vectors(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with its sparse count vectors: ``terms`` (distinct, in no
    order) and ``counts``."""
    return annotate(docs, lambda: _vectors, "terms array<string>, counts array<bigint>", keep=keep)


def group_sums(vectors: DataFrame, by: list[str]) -> DataFrame:
    """Sum and number of non-zeros of the vectors of each group, as rows
    ``(*by, term, cf, df)``; summed in the tasks first."""
    cells = vectors.select(*by, F.explode(F.arrays_zip("terms", "counts")).alias("c"))
    return cells.select(*by, F.col("c.terms").alias("term"), F.col("c.counts").alias("n")) \
        .groupBy(*by, "term").agg(F.sum("n").alias("cf"), F.count(F.lit(1)).alias("df"))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row a kept term: ``lang, term, cf, df`` and its ``sources``, an
    array of (source, cf) with at most one entry a source."""
    named = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                        "text")
    sums = group_sums(document_vectors(named, ["lang", "source"]), ["lang", "source"])
    return sums.groupBy("lang", "term").agg(
        F.sum("cf").alias("cf"), F.sum("df").alias("df"),
        F.collect_list(F.struct("source", "cf")).alias("sources")).where(F.col("df") >= min_docs)


def vocabulary(kept: DataFrame) -> DataFrame:
    """``lang, term, cf, df, index``: each language's terms numbered from 0 by
    falling count, then term."""
    ranked = kept.select("lang", (-F.col("cf")).alias("less"), "term", "cf", "df")
    keyed = assign_dense_keys(ranked, ["less", "term"], "index", group="lang").df
    return keyed.select("lang", "term", "cf", "df", (F.col("index") - 1).alias("index"))


def _p(count, total, size):
    """SQL of ``1 + floor(1e9 * (count + 1) / (total + size))``; null without terms."""
    return (f"CASE WHEN {size} > 0 THEN 1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(20,0))"
            f" DIV CAST({total} + {size} AS DECIMAL(20,0))) END")


def _f(p, q):
    return f"((({p}) - ({q})) * (({p}) - ({q})) DIV ({q}))"


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shares(counts: np.ndarray, total: np.ndarray, size: np.ndarray) -> np.ndarray:
    """p of int64 counts; exact also where 1e9 * (count + 1) exceeds 64 bits."""
    below = total + size
    if len(counts) and int(counts.max()) >= 2**63 // SCALE - 1:
        return np.array([1 + SCALE * (int(c) + 1) // int(b) for c, b in zip(counts, below)], dtype=np.int64)
    return 1 + SCALE * (counts + 1) // below


def _corrections(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, fix): over the terms that both sources have, what
    the pair's true divergence differs from the two histograms' values."""
    # the groups as short numbers, with what p needs
    numbered = groups.select("lang", "source", "g", "total", "size")
    # (a generator in the same projection would run before the numbering)
    entries = kept.select("lang", F.monotonically_increasing_id().alias("t"), "sources") \
        .select("t", "lang", F.explode("sources").alias("s")) \
        .select("t", "lang", F.col("s.source").alias("source"), F.col("s.cf").alias("cf"))
    known = entries.join(if_small(numbered), ["lang", "source"]).select("t", "g", "cf", "total", "size")
    if numbered.count() > BROADCAST_ROWS:  # the join moved the entries: bring each term's together again
        known = known.repartition("t").sortWithinPartitions("t")

    def run(batches):
        import pyarrow as pa

        def pairs(t, g, cf, total, size):
            order = np.argsort(t, kind="stable")
            t, g, cf, total, size = (x[order] for x in (t, g, cf, total, size))
            begin = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            many = np.diff(np.append(begin, len(t)))
            p, p0 = _shares(cf, total, size), _shares(np.zeros_like(cf), total, size)
            partners = np.repeat(many, many)
            first = np.repeat(begin, many)
            edges = np.cumsum(partners)
            lo = 0
            while lo < len(t):  # entries in slices: each meets the entries of its term
                hi = max(lo + 1, int(np.searchsorted(edges, (edges[lo - 1] if lo else 0) + SLICE_PAIRS, side="right")))
                reps = partners[lo:hi]
                a = np.repeat(np.arange(lo, hi), reps)
                b = first[a] + np.arange(len(a)) - np.repeat(np.cumsum(reps) - reps, reps)
                a, b = a[a != b], b[a != b]
                fix = _divergence(p[a], p[b]) - _divergence(p[a], p0[b]) - _divergence(p0[a], p[b]) \
                    + _divergence(p0[a], p0[b])
                key = np.lexsort((g[b], g[a]))
                ga, gb, fix = g[a][key], g[b][key], fix[key]
                if len(ga):
                    new = np.flatnonzero(np.concatenate([[True], (ga[1:] != ga[:-1]) | (gb[1:] != gb[:-1])]))
                    yield pa.RecordBatch.from_arrays([pa.array(ga[new]), pa.array(gb[new]),
                                                      pa.array(np.add.reduceat(fix, new))], names=["a", "b", "fix"])
                lo = hi

        held = None     # the last term of a batch may go on in the next
        for batch in one_by_one(batches):
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            cut = int(np.flatnonzero(cols[0] != cols[0][-1])[-1]) + 1 if (cols[0] != cols[0][-1]).any() else 0
            if cut:
                yield from pairs(*[c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None:
            yield from pairs(*held)

    found = known.mapInArrow(run, "a bigint, b bigint, fix bigint")
    return found.groupBy("a", "b").agg(F.sum(F.col("fix").cast("decimal(38,0)")).alias("fix"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` ranks the other
    sources of the language, part ``term`` the source's own terms against the
    language (the first ``top``)."""
    path = shared_dir(docs.sparkSession, "source-audit")
    kept = written(kept_terms(docs, min_docs), f"{path}/terms")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("cf").alias("lang_total"))
    entries = kept.select("lang", "term", F.col("cf").alias("lang_cf"), F.explode("sources").alias("s")) \
        .select("lang", "term", "lang_cf", F.col("s.source").alias("source"), F.col("s.cf").alias("cf"))
    # counts of each group as a histogram: what its terms alone say
    hist = written(entries.groupBy("lang", "source", "cf").agg(F.count(F.lit(1)).alias("terms")), f"{path}/histograms")
    totals = hist.groupBy("lang", "source").agg(F.sum(F.col("cf") * F.col("terms")).alias("total"))
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")) \
        .distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left") \
        .na.fill(0, ["total", "size", "lang_total"]).withColumn("g", F.monotonically_increasing_id())
    groups = written(groups, f"{path}/groups")

    # terms against the language
    mine = entries.join(if_small(groups), ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), F.expr(_p("cf", "total", "size")).alias("p"),
        F.expr(_p("lang_cf", "lang_total", "size")).alias("q")).where("p > q") \
        .select("lang", "source", "item", F.expr(_f("p", "q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = mine.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # pairs: two histograms, and the terms that both have
    zero = F.expr(_p("0", "total", "size"))
    side = groups.select("lang", "source", "g", "total", "size", zero.alias("p0"))
    other = side.select("lang", F.col("source").alias("item"), F.col("g").alias("h"), F.col("p0").alias("q0"))
    base = side.join(if_small(written(other, f"{path}/others")), "lang").where("g <> h")
    base = written(base.withColumn("f0", F.expr(_f("p0", "q0"))), f"{path}/pairs")
    shares = hist.join(if_small(groups.select("lang", "source", "g", "total", "size")), ["lang", "source"]) \
        .select("g", "terms", F.expr(_p("cf", "total", "size")).alias("p"))
    shares = written(shares.groupBy("g", "p").agg(F.sum("terms").alias("terms")), f"{path}/shares")

    def margin(here: str, f: str) -> DataFrame:
        """Per pair, the sum over one side's histogram beyond f0."""
        met = base.join(shares.withColumnRenamed("g", here), here)
        return met.groupBy("g", "h").agg(
            F.sum(F.expr(f"CAST(terms AS DECIMAL(20,0)) * CAST(({f}) - f0 AS DECIMAL(20,0))")).alias("fix"))

    fixes = margin("g", _f("p", "q0")).unionByName(margin("h", _f("p0", "p"))) \
        .unionByName(_corrections(kept, groups).toDF("g", "h", "fix")) \
        .groupBy("g", "h").agg(F.sum(F.col("fix").cast("decimal(38,0)")).alias("fix"))
    value = F.coalesce(F.expr("CAST(size AS DECIMAL(20,0)) * CAST(f0 AS DECIMAL(20,0))"), F.lit(0)) \
        + F.coalesce("fix", F.lit(0))
    pairs = base.join(fixes, ["g", "h"], "left").select("lang", "source", "item", value.cast("bigint").alias("value")) \
        .withColumn("rank", F.row_number().over(order))
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))) \
        .select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS low FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(low, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), vocab AS (
  SELECT lang, term, count(*) AS cf FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}
), groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (
  SELECT g.lang, g.source, v.term, v.cf AS lang_cf, coalesce(c.n, 0) AS n
  FROM groups g JOIN vocab v USING (lang) LEFT JOIN
       (SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term) c
       ON c.lang = g.lang AND c.source = g.source AND c.term = v.term
), shares AS (
  SELECT lang, source, term, n,
         1 + {SCALE}::HUGEINT * (n + 1) // (sum(n) OVER s + count(*) OVER s) AS p,
         1 + {SCALE}::HUGEINT * (lang_cf + 1) // (sum(lang_cf) OVER s + count(*) OVER s) AS q
  FROM cells WINDOW s AS (PARTITION BY lang, source)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), all_pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
