"""Near duplicates, line dedup and the component machinery."""

import random

import pytest

from starlane.llm import components as component_steps
from starlane.llm import line_dedup, near_dup
from starlane.llm.common import shared_dir
from starlane.llm.components import components, link_buckets
from starlane.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import helpers as H


def python_components(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_of_chains_stars_and_random_links(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)]
    links += [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(250)] + [(5, 5), (1, 0), (1, 0)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint"), shared_dir(spark, "test-cc"))
    expected = {n: c for n, c in python_components(links).items() if any(n in p and p[0] != p[1] for p in links)}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(expected) and dict(rows) == expected


def test_components_without_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint"), shared_dir(spark, "test-cc")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_link_buckets_loses_no_link(spark, seed):
    """Buckets whose nodes are linked by an arbitrary relation: the rounds
    must find the components that all pairs would give."""
    rng = random.Random(seed)
    place = {n: rng.random() for n in range(120)}
    buckets = {b: rng.sample(range(120), rng.choice([2, 3, 10, 60])) for b in range(25)}

    def linked(a, b):
        return abs(place[a] - place[b]) < 0.02

    pairs = {(min(a, b), max(a, b)) for ns in buckets.values() for a in ns for b in ns if a != b}
    expected = python_components([p for p in pairs if linked(*p)])
    near = spark.createDataFrame(list(place.items()), "node bigint, at double")
    members = spark.createDataFrame([(b, n, n % 7) for b, ns in buckets.items() for n in ns],
                                    "bucket bigint, node bigint, order bigint")

    def verify(found):
        both = found.join(near.toDF("a", "x"), "a").join(near.toDF("b", "y"), "b")
        return both.where("abs(x - y) < 0.02").select("a", "b")

    labels, _ = link_buckets(spark, members, verify, shared_dir(spark, "test-buckets"))
    assert {r.node: r.label for r in labels.collect()} == expected


def test_op5_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    expected = H.near_components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_minhash_near_dedup"](spark, SF_SMALL).collect()}
    assert got == expected and any(c != d for d, (_, c) in expected.items())


def near_copies():
    """A chain of edits: neighbours are similar, the ends are not."""
    words = H.prose(50, 400).split()
    rows = []
    for i in range(40):
        rows.append((100 + i, " ".join(words)))
        words[(i * 37) % 400] = f"edit{i}"
    return rows


def test_op5_finds_chains_and_copies(spark):
    rows = near_copies() + [(500 + i, near_copies()[20][1]) for i in range(30)] + [(900, H.prose(51, 200))]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs).collect()}
    assert got == H.near_components(rows)


def test_op5_group_of_copies_that_are_mostly_not_linked(spark):
    """Copies with own edits: one large bucket, few links, by prefix keys."""
    rng = random.Random(9)
    words = H.prose(60, 150).split()
    rows = []
    for i in range(150):
        own = list(words)
        for k in range(rng.randint(0, 6)):
            own[rng.randrange(150)] = f"own{i}x{k}"
        rows.append((i, " ".join(own)))
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    expected = H.near_components(rows)
    assert got == expected and 20 < len({c for _, c in expected.values()}) < 140


def test_op5_edge_rows(spark):
    docs = H.edge_docs(spark)
    rows = near_dup.near_duplicates(docs).collect()
    assert len(rows) == len(H.edge_rows())
    expected = H.near_components([(r[0], r[1]) for r in H.edge_rows() if r[0] is not None])
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (*expected[r.doc_id], expected[r.doc_id][1] == r.doc_id)
    kept = near_dup.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and {1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13} <= set(ids) and not {2, 3} & set(ids)


def test_op5_keeps_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, H.prose(1, 50))] * 3 + [(2, None)] * 2, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in near_dup.keep_first(docs).collect()) == [1, 2, 2]


def test_op5_empty_table(spark):
    assert near_dup.near_duplicates(H.no_docs(spark)).count() == 0
    assert near_dup.keep_first(H.no_docs(spark)).count() == 0


def test_tensored_banding_recall():
    """Two collections of m groups of r minhashes meet pairs of 0.85."""
    import numpy as np

    rng = np.random.default_rng(0)
    missed = 0
    for _ in range(300):
        common = rng.integers(0, 1 << 63, 850).astype(np.uint64)
        sets = [np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 75).astype(np.uint64)])) for _ in range(2)]
        doc = np.concatenate([np.full(len(s), i) for i, s in enumerate(sets)])
        _, _, keys = near_dup._summaries(doc, np.concatenate(sets), 2, near_dup.GROUPS, near_dup.ROWS)
        missed += not all((keys[side, 0] == keys[side, 1]).any() for side in range(2))
    assert missed <= 1


def test_op6_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    expected = H.removed_lines(rows)
    got = {(r.doc_id, p) for r in QUERIES["op6_line_dedup"](spark, SF_SMALL).collect() for p in r.removed}
    assert expected and len(expected ^ got) <= 0.005 * len(expected)


def test_op6_edge_rows(spark):
    docs = H.edge_docs(spark)
    rows = line_dedup.line_decisions(docs).collect()
    assert len(rows) == len(H.edge_rows())
    with_id = {r[0]: r[1] for r in H.edge_rows() if r[0] is not None}
    got = {(r.doc_id, p) for r in rows for p in r.removed if r.doc_id is not None}
    assert got == H.removed_lines(list(with_id.items()))
    for r in rows:
        if r.doc_id is not None:
            assert r.n_lines == sum(1 for x in (with_id[r.doc_id] or "").split("\n") if x.strip())
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns
    texts = {}
    for r in kept.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[4] == [None] and texts[5] == [""] and texts[6] == ["   \n\t "]
    assert 2 not in texts and texts[13] == [H.prose(5, 50)]
    assert texts[12] == [with_id[12]] and texts[9] == [with_id[9]]


def test_op6_shingles_cover_every_character():
    for line in ("a", "one two", "日本語のテキストです。とても長い行", "x" * 30 + " y", "  A  b\tc "):
        norm, found = H.line_shingles(line)
        covered = set()
        for i in range(len(norm)):
            for n in range(1, 10):
                if norm[i:i + n] in found:
                    covered |= set(range(i, min(i + n, len(norm))))
        assert covered >= {i for i, c in enumerate(norm) if c != " "}


def test_op6_shingles_equal_brute_force(spark):
    lines = ["a", "one two", "x" * 8, "x" * 9 + " y", "abcdefgh ijklmnopq rstuvwxyzabcdefghij k",
             "日本語のテキストです。とても長い行 and words", "https://example.org/" + H.prose(70, 20).replace(" ", "/")]
    df = spark.createDataFrame([(x,) for x in lines], "norm string").select("norm", line_dedup._shingles(9).alias("s"))
    for r in df.collect():
        norm, s = r.norm, []
        for i, c in enumerate(norm):
            run = norm[max(0, i - 8):i]
            if c != " " and (i == 0 or norm[i - 1] == " " or (len(run) == 8 and " " not in run)):
                s.append(norm[i:i + 9])
        assert r.s == s


def test_op6_inserted_and_deleted_character_in_a_long_token(spark):
    """Runs without spaces: an edit must not shift what is compared after it."""
    rng = random.Random(4)
    token = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789/_-") for _ in range(200))
    script = "".join(chr(rng.randrange(0xac00, 0xd7a0)) for _ in range(200))
    rows, expected = [], set()
    for k, t in enumerate((token, script)):
        copies = [t, t[:20] + "s" + t[20:], t[:90] + "s" + t[90:], t[:50] + t[51:]]
        rows += [(10 * k + i, f"see {c}") for i, c in enumerate(copies)]
        expected |= {(10 * k + i, 0) for i in range(1, 4)}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, p) for r in line_dedup.line_decisions(docs).collect() for p in r.removed}
    assert got == expected


def test_op6_unicode_white_space(spark):
    """Lines that differ in kinds of white space only are equal; a line of
    nothing else is blank."""
    line = H.prose(80, 12)
    odd = ["\u00a0", "\u2009", "\u3000", "\u202f", "\u1680", "\u0085", "\u2028", "\t", " \u00a0 "]
    rows = [(0, f"{line}\n ")]
    rows += [(1 + i, f"{w}{line.replace(' ', w)}{w}\n{w}{w}") for i, w in enumerate(odd)]
    rows += [(100, "Quelle surprise\u00a0! Oui\u00a0; non\u00a0?"), (101, "Quelle surprise ! Oui ; non ?"), (102, "\u00a0")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_lines, r.removed) for r in line_dedup.line_decisions(docs).collect()}
    expected = {0: (1, []), 100: (1, []), 101: (1, [0]), 102: (0, [])}
    assert got == expected | {1 + i: (1, [0]) for i in range(len(odd))}
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert kept == {d: t for d, t in rows if d in (0, 100, 102)}


def test_op6_empty_table(spark):
    assert line_dedup.line_decisions(H.no_docs(spark)).count() == 0
    assert line_dedup.dedup_lines(H.no_docs(spark)).count() == 0


def test_op6_runs_no_python_on_executors(spark):
    plan = QUERIES["op6_line_dedup"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("lines", [200, 400])
def test_op6_alike_lines_are_not_compared_in_all_pairs(spark, monkeypatch, lines):
    """Lines of one shape (12 common words, 5 own ones) with a few true copies
    among them: every copy is found, and the pairs grow with the lines."""
    rng = random.Random(lines)
    common, rows = H.prose(90, 12).split(), []
    for i in range(lines):
        own = ["".join(rng.choices("bcdfgklmnprstvz", k=7)) for _ in range(5)]
        rows.append((2 * i, " ".join(common + own)))
        if i % 20 == 0:
            rows.append((2 * i + 1, " ".join(common + own) + "!"))
    compared = []
    for module in (line_dedup, component_steps):
        plain = module.hub_pairs

        def counted(*args, plain=plain):
            first, pairs = plain(*args)
            compared.append(pairs.count())
            return first, pairs
        monkeypatch.setattr(module, "hub_pairs", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, p) for r in line_dedup.line_decisions(docs).collect() for p in r.removed}
    assert got == H.removed_lines(rows) and len(got) == lines // 20
    assert sum(compared) <= 12 * lines


def test_op6_reads_no_sets_of_lines_that_only_share_a_bucket(spark, monkeypatch):
    """Lines of other content that meet in a bucket (a common phrase) are told
    apart by their bitmaps: only copies have their sets read."""
    rng = random.Random(6)
    phrase = H.prose(91, 3)
    word = lambda: "".join(rng.choices("bcdfgklmnprstvz", k=9))
    rows = [(i, " ".join([phrase] + [word() for _ in range(12)])) for i in range(400)]
    rows += [(1000 + i, rows[i][1] + "!") for i in range(10)]
    read = {}
    plain = line_dedup.written

    def counted(df, path):
        out = plain(df, path)
        read[path.rsplit("/", 1)[-1]] = read.get(path.rsplit("/", 1)[-1], 0) + out.count()
        return out
    monkeypatch.setattr(line_dedup, "written", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, p) for r in line_dedup.line_decisions(docs).collect() for p in r.removed}
    assert got == H.removed_lines(rows) and len(got) == 10
    assert read["met-members"] > 100       # they do share buckets
    assert 20 <= read["sets"] <= 40


def test_op6_large_buckets_lose_no_link(spark, monkeypatch):
    """The same lines by all pairs of small buckets and by the prefix filter."""
    rng = random.Random(7)
    words = H.prose(92, 14).split()
    rows = []
    for i in range(150):
        own = list(words)
        for k in rng.sample(range(14), rng.choice([1, 2, 4])):
            own[k] = "".join(rng.choices("bcdfg", k=8))
        rows.append((i, "\n".join([" ".join(own), " ".join(reversed(own))])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = []
    for limit in (256, 3):
        monkeypatch.setattr(line_dedup, "LARGE_BUCKET", limit)
        found.append({(r.doc_id, p) for r in line_dedup.line_decisions(docs).collect() for p in r.removed})
    assert found[0] == found[1] and found[0]
