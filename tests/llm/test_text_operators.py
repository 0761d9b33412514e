"""Operators on single texts: hashes, tokens, decontamination, rules."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starlane import session
from starlane.llm import bpe, decontaminate, edit_counts, quality_rules, token_index
from starlane.llm.byte_tokens import ByteTokens
from starlane.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import helpers as H

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def noise(n, seed=5):
    rng = random.Random(seed)
    chars = "abc 'sStTdlrReveéÉñßΣςİı K  \t\n\r\x0b\x1c\x85  12٣½Ⅷ.,!'#\"<|>日本語한🙂क्षि\x00"
    return ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(n)] + [
        "", " ", "it's we're I'LL 'tis ''s '", "<|startoftext|>hello's<|endoftext|> x<|endoftext|>"]


def test_speculative_bpe_equals_the_library():
    library, own = Tokenizer.from_file(WORD_BPE), bpe.WordBpe(WORD_BPE)
    rng = random.Random(2)
    texts = noise(1500) + ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    ids, decoded = own.encode(texts)
    assert 0 < own.merged < len(own.cache.slots)  # some words pass the pair check, some are merged
    for t, i, d in zip(texts, ids, decoded):
        expected = library.encode(t, add_special_tokens=False).ids
        assert i.tolist() == expected, t
        assert d == own.decode(expected) == library.decode(expected, skip_special_tokens=False)


def test_a_very_long_word_is_merged_in_reasonable_time():
    import time

    library, own = Tokenizer.from_file(WORD_BPE), bpe.WordBpe(WORD_BPE)
    rng = random.Random(7)
    word = "".join(rng.choices("etaoinshrdlu\u65e5\u672c", k=100_000))
    began = time.process_time()
    ids, _ = own.encode([word])
    assert time.process_time() - began < 20
    assert ids[0].tolist() == library.encode(word, add_special_tokens=False).ids


def test_byte_tokens_equal_the_library_with_and_without_special_tokens():
    texts = noise(800, seed=8)
    for special in (True, False):
        library = Tokenizer.from_file(BYTE_BPE)
        library.encode_special_tokens = not special
        own = ByteTokens(BYTE_BPE, special=special)
        assert [i.tolist() for i in own.encode(texts)] == [
            e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_piece_cache_refills_when_full():
    own = ByteTokens(BYTE_BPE)
    own.cache.limit = 50
    texts = [H.prose(i, 100) for i in range(20)]
    library = Tokenizer.from_file(BYTE_BPE)
    for t in texts:
        assert own.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids


def test_op8_on_the_table(spark):
    library = Tokenizer.from_file(WORD_BPE)
    got = {r.doc_id: r for r in QUERIES["op8_bpe"](spark, SF_SMALL).collect()}
    for d, t in documents(spark):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_encode_decode_returns_ids_and_text(spark):
    rows = bpe.encode_decode(H.edge_docs(spark), WORD_BPE).collect()
    library = Tokenizer.from_file(WORD_BPE)
    assert len(rows) == len(H.edge_rows())
    for r in rows:
        assert list(r.token_ids) == library.encode(r.text or "", add_special_tokens=False).ids


def test_op1_reads_back_every_document(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    got = {r.doc_id: r for r in QUERIES["op1_token_index"](spark, SF_SMALL).collect()}
    start = 0
    for d, t in sorted(documents(spark)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[d].start, got[d].n_tokens) == (start, len(ids))
        assert got[d].ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_op1_edge_rows(spark):
    docs = H.edge_docs(spark)
    index = token_index.write_token_index(docs, BYTE_BPE, keys_per_bucket=3)
    got = token_index.id_checksums(index, docs.select("doc_id")).unionByName(token_index.keyless_checksums(index))
    rows = sorted((r.start, r.doc_id, r.n_tokens) for r in got.collect())
    assert len(rows) == len(H.edge_rows())
    assert [r[0] for r in rows] == np.cumsum([0] + [r[2] for r in rows[:-1]]).tolist()
    ids = [r[1] for r in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:]) and ids.count(3) == 2
    absent = spark.createDataFrame([(10 ** 9 + i,) for i in range(1000)], "doc_id bigint")
    assert index.lookup(absent).count() == 0


def test_op1_repeated_key_is_read_by_several_tasks(spark, monkeypatch):
    """A key with most of the rows: every record comes back, and no task
    reads them all."""
    docs = spark.createDataFrame([(7 if i % 3 else i, H.prose(i, 20 + i % 9)) for i in range(600)],
                                 "doc_id bigint, text string")

    def reader():
        from pyspark import TaskContext

        return lambda ids: (TaskContext.get().partitionId(), zlib.crc32(ids.astype("<u4").tobytes()))

    # tiny shards stay apart
    monkeypatch.setitem(session.ENGINE_CONF, "spark.sql.adaptive.coalescePartitions.enabled", "false")
    index = token_index.write_token_index(docs, BYTE_BPE)
    rows = index.records(index.lookup(docs.select("doc_id")), reader, "task int, crc bigint").collect()
    library = Tokenizer.from_file(BYTE_BPE)
    expected = sorted((d, zlib.crc32(np.array(library.encode(t, add_special_tokens=False).ids + [2], dtype="<u4").tobytes()))
                      for d, t in docs.collect())
    assert sorted((r.key, r.crc) for r in rows) == expected
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows[:-1]]).tolist()
    assert len({r.task for r in rows if r.key == 7}) > 1


def test_op1_empty_table(spark):
    docs = H.no_docs(spark)
    index = token_index.write_token_index(docs, BYTE_BPE)
    assert token_index.id_checksums(index, docs.select("doc_id")).count() == 0
    assert token_index.keyless_checksums(index).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_rejects_strangers(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    values = {k: np.arange(len(keys)) for k in ("shard", "offset", "copies", "start")}
    bucket = token_index.Bucket(token_index.pack_bucket(keys, values))
    known, slots = bucket.find(keys)
    assert known.all() and sorted(slots.tolist()) == list(range(len(keys)))
    assert (bucket.values["offset"][slots] == np.arange(len(keys))).all()
    strangers = rng.integers(1 << 63, (1 << 64) - 1, 10_000, dtype=np.uint64)
    assert bucket.find(strangers)[0].sum() == 0


def test_op7_on_the_table(spark):
    items = [(str(i), t) for i, t in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in QUERIES["op7_decontamination"](spark, SF_SMALL).collect()}
    dirty = 0
    for d, t in documents(spark):
        words, hit, found = H.benchmark_hits(t, items)
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (got[d].n_words, got[d].n_hit, got[d].n_items, got[d].items_sha256, got[d].contaminated) == (
            words, hit, len(found), names, hit > 0)
        dirty += hit > 0
    assert dirty


BENCH = [(1, H.prose(3, 50)), (2, "three"), (None, "ONE two"), (4, None), (5, ""), (1, H.prose(3, 50))]


@pytest.mark.parametrize("block", [500_000, 7])
def test_op7_edge_rows_in_one_block_or_many(spark, block):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    docs = H.edge_docs(spark).withColumnRenamed("node", "hit_items")
    rows = decontaminate.mark_hits(docs, bench, block_windows=block).collect()
    assert len(rows) == len(H.edge_rows())
    for r in rows:
        words, hit, found = H.benchmark_hits(r.text, BENCH)
        assert (r.n_words, r.n_hit, r.hit_items) == (words, hit, sorted(str(i) for i in found - {None}))


def test_op7_removes_documents_or_spans(spark):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    docs = H.edge_docs(spark)
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    clean = [r for r in H.edge_rows() if not H.benchmark_hits(r[1], BENCH)[1]]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, clean))
    cut = decontaminate.decontaminate(docs, bench, action="span").collect()
    assert len(cut) == len(H.edge_rows())
    texts = {r.doc_id: r.text for r in cut}
    # adjacent hit words are one span, with what stands between them
    assert texts[12] == "\n" + H.prose(4, 50) and texts[4] is None and texts[8] == ""
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.decontaminate(docs, empty).count() == docs.count()
    assert decontaminate.decontaminate(H.no_docs(spark), bench).count() == 0


def test_op10_base_counts_and_verdicts(spark):
    got = {r.doc_id: r for r in QUERIES["op10_quality_rules"](spark, SF_SMALL).collect()}
    for d, t in documents(spark):
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == H.base_stats(t)
        assert not (r.base_failed and r.kept)


def test_op10_keeps_good_and_rejects_junk(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op10_quality_rules"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.1 * len(junk)


def test_op10_distance_is_the_mahalanobis_distance_of_the_kept_half(spark):
    """The last model equals moments recomputed by hand from its own half."""
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 2)) @ np.array([[1.0, 0.6], [0.0, 0.8]])
    x[:80] += 25.0  # outliers must not move the estimate
    rows = spark.createDataFrame([("g", float(a), float(b)) for a, b in x], "grp string, a double, b double")
    model = quality_rules.group_estimates(rows, ["a", "b"], np.array([0.01, 0.01]),
                                          token_index.shared_dir(spark, "test-mcd"), 10).first()
    inverse = np.array(model.inverse).reshape(2, 2)
    scatter, clean = np.linalg.inv(inverse), np.cov(x[80:].T)
    assert np.abs(np.array(model.centre) - x[80:].mean(axis=0)).max() < 0.3
    # half of all rows is 62.5 % of the clean ones, so the factor for one half
    # is too large by 3.26 / 2.43 = 1.34 (chi-square with 2 degrees); the shape holds
    assert abs(np.trace(scatter) / np.trace(clean) - 1.34) < 0.15
    assert np.abs(scatter / np.trace(scatter) - clean / np.trace(clean)).max() < 0.05


def test_op10_edge_rows(spark):
    rows = quality_rules.quality_verdicts(H.edge_docs(spark), keep=["doc_id", "text", "kept", "score"], min_group=2).collect()
    assert len(rows) == len(H.edge_rows())
    for r in rows:
        assert tuple(r[c] for c in [*quality_rules.BASE, "base_failed"]) == H.base_stats(r.text)
    assert quality_rules.quality_verdicts(H.no_docs(spark)).count() == 0


def test_op4_counts_after_any_edits():
    library = Tokenizer.from_file(BYTE_BPE)
    library.encode_special_tokens = True
    tokens = ByteTokens(BYTE_BPE, special=False)
    rng = random.Random(4)
    for text in noise(40, seed=3) + [H.prose(i, 700) for i in range(6)]:
        for _ in range(4):
            tree = edit_counts.build([text], tokens)[0]
            edits = [{"begin": (a := rng.randint(0, len(text) + 2)), "end": a + rng.choice([0, 1, 5, 300]),
                      "replacement": rng.choice([None, "", "x", " 's", H.prose(rng.random(), 900)])}
                     for _ in range(rng.randint(0, 4))]
            new, tree, again = edit_counts.apply_edits(text, tree, edits, tokens)
            expected = text
            for a, b, r in reversed(edit_counts.clean_edits(edits, len(text))):
                expected = expected[:a] + r + expected[b:]
            assert new == expected and tree.chars[1] == len(new)
            assert tree.tokens[1] == len(library.encode(new, add_special_tokens=False).ids)


def test_op4_reencodes_only_around_the_edit():
    tokens = ByteTokens(BYTE_BPE, special=False)
    text = H.prose(9, 20_000)
    tree = edit_counts.build([text], tokens)[0]
    _, _, again = edit_counts.apply_edits(text, tree, [{"begin": 50_000, "end": 50_003, "replacement": "é"}], tokens)
    assert again < 2_000


def test_op4_on_the_table_and_edge_rows(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    library.encode_special_tokens = True
    rows = QUERIES["op4_edit_token_counts"](spark, SF_SMALL).collect()
    assert len(rows) == len(documents(spark)) and all(r.n_edits >= 1 for r in rows)
    for docs in (H.edge_docs(spark), H.no_docs(spark)):
        state = edit_counts.token_trees(docs, BYTE_BPE)
        done = edit_counts.update_trees(edit_counts.revision_edits(state), BYTE_BPE).collect()
        assert len(done) == docs.count()
        for r in done:
            assert r.n_tokens == len(library.encode(r.text, add_special_tokens=False).ids)
            assert r.n_chars == len(r.text)
