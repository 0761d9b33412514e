"""Filtering operators decide by row, and leave other columns alone."""

from starlane.llm import decontaminate, line_dedup, near_dup
from starlane.llm.common import annotate
from tests.llm import helpers as H

CLASHES = ("n_words bigint, n_hit string, dropped_id bigint, gone_pos string, gone_key string, tree_chars string, "
           "score double, stays string, row string, text_key bigint, hit_items string, k_id string, component string")
SCHEMA = f"doc_id bigint, text string, {CLASHES}"
EXTRA = (42, "x", 7, "p", "k", "t", 0.5, "s", "r", 1, "h", "i", "c")


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def test_near_dup_removes_rows_not_ids(spark):
    a, b, c, d, e = (H.prose(i, 60) for i in range(5))
    rows = [(5, a), (None, a), (None, b), (None, c), (7, d), (7, e), (8, d)]
    kept = near_dup.keep_first(docs_of(spark, rows)).collect()
    assert sorted(((r.doc_id or 0, r.text) for r in kept)) == sorted([(5, a), (0, b), (0, c), (7, d), (7, e)])
    assert all(tuple(r)[2:] == EXTRA for r in kept)


def test_equal_rows_leave_one_and_wordless_ones_all(spark):
    a = H.prose(9, 40)
    rows = [(1, a), (1, a), (None, a), (2, ""), (2, ""), (3, None)]
    kept = near_dup.keep_first(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.text) == [(1, a)]
    assert len(kept) == 4


def test_sets_are_made_once_a_text(spark, monkeypatch):
    made = []
    add = near_dup.SetStore.add
    monkeypatch.setattr(near_dup.SetStore, "add", lambda self, needed: (add(self, needed), made.append(self.parts[-1].count())))
    base = H.prose(3, 200).split()
    rows = []
    for i in range(60):     # near copies without id, and as many under one id
        near = [*base]
        near[i] = f"w{i}"
        rows += [(None if i % 2 else 4, " ".join(near))] * (1 + i % 3)
    near_dup.near_duplicates(docs_of(spark, rows)).collect()
    assert 0 < sum(made) <= 60


def test_near_dup_scans_little_text_at_once(spark):
    def scorer():
        return lambda texts: {"held": [sum(map(len, texts))] * len(texts)}

    docs = spark.createDataFrame([(i, "x" * 100_000) for i in range(8)] + [(9, "y" * 600_000)], "doc_id bigint, text string")
    held = {r.doc_id: r.held for r in annotate(docs.coalesce(1), scorer, "held bigint", **near_dup.SCAN).collect()}
    assert held.pop(9) == 600_000 and len(held) == 8     # a text stays whole, alone
    assert max(held.values()) <= near_dup.SCAN["chunk_bytes"]


def test_other_columns_stay(spark):
    lines = "\n".join(H.prose(i, 20) for i in range(3))
    bench = spark.createDataFrame([("i1", H.prose(50, 30))], "item_id string, text string")
    rows = [(1, lines), (2, lines + "\n" + H.prose(7, 20)), (3, H.prose(50, 30)), (4, None)]
    docs = docs_of(spark, rows)
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(*r, *EXTRA) for r in rows if r[0] != 3], key=repr)
    cut = {r.doc_id: tuple(r)[2:] for r in decontaminate.decontaminate(docs, bench, action="span").collect()}
    assert cut == {i: EXTRA for i in (1, 2, 3, 4)}
    once = line_dedup.dedup_lines(docs)
    assert once.columns == docs.columns
    got = {r.doc_id: (r.text, tuple(r)[2:]) for r in once.collect()}
    assert got == {1: (lines, EXTRA), 2: (H.prose(7, 20), EXTRA), 3: (H.prose(50, 30), EXTRA), 4: (None, EXTRA)}


def test_decontamination_scans_a_bounded_text_at_once(spark, monkeypatch):
    asked = []
    inner = decontaminate.annotate
    monkeypatch.setattr(decontaminate, "annotate", lambda *a, **k: asked.append(k) or inner(*a, **k))
    docs = spark.createDataFrame([(i, "alpha beta gamma " + "delta " * i) for i in range(4)], "doc_id bigint, text string")
    items = spark.createDataFrame([("i1", "beta gamma delta delta")], "item_id string, text string")
    for action in ("document", "span"):
        assert decontaminate.decontaminate(docs, items, action=action, n=4).count() == (2 if action == "document" else 4)
    assert len(asked) == 5 and all(k["chunk_bytes"] <= 250_000 and k["rows_at_once"] <= 500 for k in asked)
