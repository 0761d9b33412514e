"""What a Python worker holds at once is bounded by bytes, not by rows."""

import sys

import pytest

np = pytest.importorskip("numpy")

from starlane.llm.bpe import SCAN, encode_digests  # noqa: E402
from starlane.llm.common import annotate  # noqa: E402
from starlane.llm.pretoken import PieceCache, Pieces  # noqa: E402


def test_arrow_batches_are_bounded_by_bytes(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        docs = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")
        annotate(docs, lambda: lambda texts: {"n": [len(t) for t in texts]}, "n int")  # sets what it needs

        def sizes(batches):
            import pyarrow as pa

            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["b"])
        got = [r[0] for r in docs.mapInArrow(sizes, "b bigint").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert sum(got) > 20_000_000 and max(got) < 5_000_000


def test_bpe_takes_little_text_at_once(spark, monkeypatch):
    import public_tokenizers

    import starlane.llm.bpe as bpe

    seen = {}
    monkeypatch.setattr(bpe, "annotate", lambda *a, **k: seen.update(k))
    for run in (encode_digests, bpe.encode_decode):
        run(None, public_tokenizers.path("word_bpe_49k.json"), keep=[])
        assert seen.items() >= SCAN.items() and SCAN["chunk_bytes"] <= 250_000 and SCAN["rows_at_once"] <= 500


def test_piece_cache_is_compact_and_right_when_refilled():
    cache = PieceCache(lambda words: ([[len(w), sum(w.encode())] for w in words], []), limit=3000)
    rng = np.random.default_rng(3)
    for _ in range(40):
        words = [f"w{i}" if i % 3 else "x" * (i % 50 + 1) for i in rng.integers(0, 5000, 400).tolist()]
        pieces = Pieces([" ".join(words)]).words()
        slots = cache.lookup(pieces)
        ids, sizes = cache.gather(slots)
        own = [pieces.piece(i) for i in range(len(pieces.starts))]
        assert sizes.tolist() == [2] * len(own)
        assert ids.tolist() == [v for w in own for v in (len(w), sum(w.encode()))]
        assert (np.diff(cache.known.astype(object)) > 0).all() and len(cache.known) == len(cache.slots) <= 3800
    held = sys.getsizeof(cache.known) + sys.getsizeof(cache.slots)
    assert held <= 16 * len(cache.known) + 1000     # a dict of them: over 100 bytes each
