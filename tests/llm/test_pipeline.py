"""The corpus pipeline, stage by stage, against brute force."""

import corpus_pipeline
from starlane.llm.common import shared_dir, written
from tests.llm import helpers as H

SF = "/root/testdata/sf0.001"


def test_stages_in_order_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns, root = docs.columns, shared_dir(spark, "test-pipeline")
    before = None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = written(stage(spark, docs, SF), f"{root}/{k}")
        if name != "bpe":
            assert docs.columns == columns
            after = {r.doc_id: r.text for r in docs.collect()}
            assert set(after) <= set(before)
        if name == "line_dedup":
            gone = H.removed_lines(list(before.items()))
            expected = {}
            for d, t in before.items():
                lines = [x for i, x in enumerate(t.split("\n")) if (d, i) not in gone]
                if not any((d, i) in gone for i in range(len(t.split("\n")))) or any(x.strip() for x in lines):
                    expected[d] = "\n".join(lines)
            assert sum(after.get(d) != t for d, t in expected.items()) + len(set(after) - set(expected)) <= 2
        if name == "near_dedup":
            components = H.near_components(list(before.items()))
            assert set(after) == {d for d, (_, c) in components.items() if c == d}
        if name == "decontamination":
            assert set(after) == {d for d, t in before.items() if not H.benchmark_hits(t, items)[1]}
    assert docs.count() == len(before) and "ids_sha256" in docs.columns


def test_pipeline_of_empty_and_edge_tables(spark):
    for make in (H.edge_docs, H.no_docs):
        docs = make(spark)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = written(stage(spark, docs, SF), f"{shared_dir(spark, 'test-pipeline')}/{k}")
        ids = [r.doc_id for r in docs.collect()]
        if make is H.no_docs:
            assert ids == []
        else:  # copies go, awkward but clean rows stay
            assert {1, 4, 5, 6, 9, 10, 11} <= set(ids) and 2 not in ids and None in ids


def test_near_dedup_stage_links_from_080(spark):
    """Copies of 0.80 to 0.85 go too; those below 0.80 stay."""
    rows, kept = [], set()
    for k in range(12):
        words = H.prose(300 + k, 300).split()
        rows.append((10 * k, " ".join(words)))
        kept.add(10 * k)
        for i, edits in ((1, 6), (2, 9)):
            copy = list(words)
            for e in range(edits):
                copy[15 + 30 * e] = f"own{k}x{i}x{e}"
            rows.append((10 * k + i, " ".join(copy)))
            a, b = H.shingles(rows[-1 - i][1]), H.shingles(rows[-1][1])
            percent = 100 * len(a & b) / len(a | b)
            assert 80 <= percent < 85 if i == 1 else percent < 80
    components = H.near_components(rows, percent=80)
    expected = {d for d, (_, c) in components.items() if c == d}
    assert kept <= expected and not {10 * k + 1 for k in range(12)} & expected
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF).collect()}
    assert got == expected
