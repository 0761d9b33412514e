"""Prefix trie and source audit against their SQL on awkward tables, the
language model against a plain Katz model."""

import math
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import duckdb
import numpy as np
import pytest

from starlane.llm import katz, prefix_trie, source_audit
from starlane.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm import helpers as H

TURNS = "conv_id bigint, turn bigint, role string, text string, depth string, n bigint, block string"


def by_sql(name, **tables):
    con = duckdb.connect()
    for t, df in tables.items():
        con.register(t, df.toArrow())
    return sorted(con.execute(ORACLE[name]).fetchall(), key=repr)


def rows_of(df, cast=tuple):
    return sorted((cast(r) for r in df.collect()), key=repr)


# ---- op11 -------------------------------------------------------------------------

def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*rng.sample(range(700), 150), -40, -200]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 30])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice("uuua") if t else None,
                         rng.choice(["x", "x", "x", "yy", "", None, "é\n"])))
    rows += [(c, t, "u", "same") for c in range(1000, 1120) for t in range(7)]      # one large group of copies
    rows += [(None, 0, "u", "nobody's"), (5, 0, "u", "x"), (5, 0, "u", "x")]
    return [(*r, "d", 1, "b") for r in rows]


@pytest.mark.parametrize("blocks", [1, 5])
def test_trie_equals_sql(spark, blocks):
    turns = spark.createDataFrame(conversations(blocks), TURNS)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", blocks)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = rows_of(prefix_trie.prefix_trie(turns))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == by_sql("op11_prefix_trie", conversations=turns)


def test_trie_of_few_and_no_rows(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    # the base is absent and the own turns are fewer than those it would give
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 3)
    [only] = prefix_trie.prefix_trie(spark.createDataFrame([(c, 0, "u", "x", "", 0, "")], TURNS)).collect()
    assert (only.conv_id, only.depth, only.parent_conv_id, only.n_convs, only.n_children, only.n_leaves) == (c, 0, None, 1, 0, 1)


def test_extents_are_the_widest_runs():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 17, 64):
        values = rng.integers(0, 5, n)
        table = prefix_trie.sparse_table(values)
        at, depth = np.repeat(np.arange(n), 6), np.tile(np.arange(6), n)
        left, right = prefix_trie.extents(table, at, depth)
        for i, d, lo, hi in zip(at, depth, left, right):
            a = b = i
            while a > 0 and values[a] >= d:
                a -= 1
            while b + 1 < n and values[b + 1] >= d:
                b += 1
            assert (lo, hi) == (a, b)


# ---- op12 -------------------------------------------------------------------------

def test_audit_equals_sql_on_awkward_rows(spark):
    rng = random.Random(2)
    words = ["a", "B", "c1d", "é", "Éa", "日本", "the", "the", "the", "x-y", "z\x00q"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "fr", None, ""]),
             rng.choice(["s1", "s2", "S1", None])) for i in range(80)]
    rows += [(1, "rare", "xx", "s1"), (2, None, "xx", "s2"), (3, "", "yy", "s1"), (1, "rare", "xx", "s1")]
    docs = spark.createDataFrame([(*r, 0, 0.5, "t", "v", "p", "i") for r in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, value double, "
                                 "term string, rank string, part string, item string")
    got = rows_of(source_audit.divergence(docs))
    assert got == by_sql("op12_source_audit", documents=docs)
    assert {r[4] for r in got if r[0] == "xx"} == {0} and not [r for r in got if r[0] == "yy"]
    assert source_audit.divergence(H.no_docs(spark)).count() == 0


def test_vectors_and_vocabulary(spark):
    docs = spark.createDataFrame([(1, "b a B", "en", "s"), (2, "a c-c", "en", "s"), (3, None, "en", "t"), (4, "a b", "de", "s")],
                                 "doc_id bigint, text string, lang string, source string")
    vectors = {r.doc_id: dict(zip(r.terms, r.counts)) for r in source_audit.document_vectors(docs).collect()}
    assert vectors == {1: {"a": 1, "b": 2}, 2: {"a": 1, "c": 2}, 3: {}, 4: {"a": 1, "b": 1}}
    kept = source_audit.kept_terms(docs, min_docs=1)
    index = {(r.lang, r.term): r["index"] for r in source_audit.vocabulary(kept).collect()}
    assert index == {("en", "a"): 0, ("en", "b"): 1, ("en", "c"): 2, ("de", "a"): 0, ("de", "b"): 1}


def test_shares_are_exact_beyond_64_bits():
    big = 2**40
    got = source_audit._shares(np.array([big, 3]), np.array([5 * big, 5 * big]), np.array([7, 7]))
    assert got.tolist() == [1 + 10**9 * (c + 1) // (5 * big + 7) for c in (big, 3)]


# ---- op13 -------------------------------------------------------------------------

def plain_katz(rows, order):
    docs = [(d, d is None or zlib.crc32(str(d).encode()) % 5 != 1, [*H.WORD.findall(H.lower_ascii(t)), None]) for d, t in rows]
    count, total, follow = [Counter() for _ in range(order + 1)], Counter(), defaultdict(list)
    for _, train, w in docs:
        for n in range(1, order + 1) if train else ():
            padded = ["<s>"] * (n - 1) + w
            count[n].update(tuple(padded[i:i + n]) for i in range(len(w)))
    stars = [None]
    for n in range(1, order + 1):
        of = Counter(count[n].values())
        spare = min(max(of[1] / (of[1] + 2 * of[2]) if of[1] else 0.5, 0.1), 0.9)
        star = {}
        for r in range(1, 6):
            turing = (r + 1) * of[r + 1] / of[r] if of[r] else 0
            star[r] = turing if 0 < turing < r else r - spare
        stars.append(lambda r, star=star: star[r] if r <= 5 else r - (5 - star[5]))
        if n > 1:
            for g, c in count[n].items():
                total[g[:-1], n] += c
                follow[g[:-1], n].append(g[-1])
    size, kinds = sum(count[1].values()), len(count[1])
    unknown = 1 - sum(map(stars[1], count[1].values())) / size if size else 1.0

    @lru_cache(None)
    def p(g):
        n, h = len(g), g[:-1]
        if n == 1:
            return stars[1](count[1][g]) / size if count[1][g] else unknown
        if count[n][g]:
            return stars[n](count[n][g]) / total[h, n]
        return back(h) * p(g[1:]) if total[h, n] else p(g[1:])

    @lru_cache(None)
    def back(h):
        seen = follow[h, len(h) + 1]
        return (1 - sum(p((*h, w)) for w in seen)) / (1 - sum(p((*h[1:], w)) for w in seen))

    for h, n in list(follow)[:40]:      # every context's probabilities add up to one
        assert sum(p((*h, w)) for (w,) in count[1]) + p((*h, "never seen")) == pytest.approx(1)
    out = []
    for d, train, w in docs:
        padded = ["<s>"] * (order - 1) + w
        out.append((d, not train, len(w), sum(count[1][x,] > 0 for x in w), size,
                    sum(math.log10((count[1][x,] + 0.5) / (size + 0.5 * (kinds + 1))) for x in w),
                    sum(math.log10(p(tuple(padded[i:i + order]))) for i in range(len(w)))))
    return out


def agree(got, want):
    key = lambda r: (str(r[0]), *r[2:4], round(r[5], 5), round(r[6], 5))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


@pytest.mark.parametrize("order, packet", [(2, 4_500_000), (3, 3_000)])
def test_scores_equal_a_plain_katz_model(spark, order, packet):
    docs = spark.createDataFrame(H.edge_rows() + [
        (20 + i, H.prose(i % 7, 40) + " " + H.prose(i, 5), "en", "a", 0, 0.5, "x", "y", "z", "w", "v") for i in range(40)], H.DOC_SCHEMA)
    got = katz.score_texts(docs.repartition(3), katz.training_rows(), order, packet_tokens=packet, part_keys=50)
    agree(got.collect(), plain_katz([(r.doc_id, r.text) for r in docs.collect()], order))


def test_scores_of_few_and_no_rows(spark):
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 5 == 1)
    rows = [(held, "a b"), (held, None)]        # nothing to train on
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = katz.score_texts(docs, katz.training_rows()).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got) == \
        [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert katz.score_texts(H.no_docs(spark), katz.training_rows()).count() == 0


def test_discounts_leave_a_share_for_the_unseen():
    for counts in ([5, 3, 2, 1, 1, 1], [0, 0, 0, 0, 0, 0], [1, 0, 0, 0, 0, 9], [3, 9, 1, 1, 1, 1]):
        low = sum((i + 1) * c for i, c in enumerate(counts))
        d = katz.Discounts(low + 100, sum(counts) + 4, counts)
        r = np.arange(1, 40)
        assert (d(r) > 0).all() and (d(r) < r).all() and 0 < d.unknown < 1


def test_registered_queries_on_the_small_tables(spark):
    table = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "conversations")}
    assert rows_of(QUERIES["op11_prefix_trie"](spark, SF_SMALL)) == by_sql("op11_prefix_trie", **table)
    assert rows_of(QUERIES["op12_source_audit"](spark, SF_SMALL)) == by_sql("op12_source_audit", **table)
    docs = table["documents"].select("doc_id", "text").collect()
    agree(QUERIES["op13_katz_backoff"](spark, SF_SMALL).collect(), plain_katz(map(tuple, docs), 2))
