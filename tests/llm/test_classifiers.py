"""Toxicity grammar and PU quality: held-out accuracy, parts, edge cases."""

import zlib

import numpy as np
import pytest

from starlane.llm import quality_pu, toxicity
from starlane.llm.queries import QUERIES
from starlane.llm.textscan import ALNUM, Scan
from tests.llm import helpers as H

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def accuracy(rows, labels, name):
    pairs = [(r.predicted, labels[r.doc_id][name]) for r in rows if r.held_out and r.doc_id in labels]
    return sum(p == y for p, y in pairs) / len(pairs)


def test_op2_held_out_accuracy(spark, labels):
    rows = QUERIES["op2_toxicity"](spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert accuracy(rows, labels, "toxic") >= 0.95


def test_op3_held_out_accuracy(spark, labels):
    rows = QUERIES["op3_quality_classifier"](spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert accuracy(rows, labels, "quality") >= 0.95


def events(text, words=("idiot",)):
    terms = {int(h): 1.0 for h in toxicity.word_hash(list(words))}
    totals = toxicity.clause_events([text.encode()], toxicity.Lexicon(terms), toxicity.Grammar())[0]
    return {e for e, v in zip(toxicity.EVENTS, totals) if v}


def test_grammar_marks_clauses():
    assert events("what an Idiot") == {"insult"}
    assert events("you are an idiot") == {"insult_aimed"}
    assert events("this is not an idiot") == {"insult_negated"}
    assert events("not here. an idiot") == {"insult"}
    assert events("not one two three four five idiot") == {"insult"}
    assert events("someone said that idiot") == {"insult_reported"}
    assert events("someone said: idiot") == {"insult_reported"}
    assert events("someone said it. so. idiot") == {"insult"}
    assert events("I will kill you; you will kill") == {"threat", "threat_aimed"}
    assert events("nothing to see") == set()


def test_composition_equals_the_cascade():
    """The composed machine maps every symbol sequence as the parts in a row."""
    import itertools

    parts = [toxicity.negation(2), toxicity.report(), toxicity.aim()]
    whole = toxicity.compose(toxicity.compose(parts[0], parts[1], toxicity.SYMBOLS), parts[2], toxicity.SYMBOLS)
    for sequence in itertools.product(toxicity.SYMBOLS, repeat=4):
        states, at = [p.start for p in parts], whole.start
        for symbol in sequence:
            label, weight = symbol, 1.0
            for i, p in enumerate(parts):
                states[i], label, w = p.step(states[i], label)
                weight *= w
            at, got, got_weight = whole.step(at, symbol)
            assert (got, got_weight) == (label, weight)


def test_stems_match_inflected_words():
    scan = Scan([b"lowei loweischaft"], ALNUM)
    whole, *stems = toxicity.term_hashes(scan)
    assert stems[1][1] != 0 and stems[1][0] == 0 and whole[0] != stems[1][1]


def train_rows(spark):
    docs = [(i, H.prose(i, 40) + (" stupidly vile" if i % 3 == 0 else "")) for i in range(240)]
    labels = [(i, int(i % 4 > 0), int(i % 3 == 0)) for i, _ in docs]
    return docs, spark.createDataFrame(labels + labels[:5] + [(None, 1, 1), (7, None, None)], LABELS)


def test_op2_edge_rows(spark):
    docs, labels = train_rows(spark)
    model = toxicity.train(spark.createDataFrame(docs, "doc_id bigint, text string"), labels)
    assert model.terms
    edge = H.edge_docs(spark)
    rows = toxicity.score_toxicity(edge, model).collect()
    assert len(rows) == len(H.edge_rows()) and all(0 <= r["score"] < 0.5 for r in rows)
    kept = toxicity.drop_toxic(edge, spark.createDataFrame([], LABELS))
    assert kept.columns == edge.columns and kept.count() == edge.count()
    assert toxicity.score_toxicity(H.no_docs(spark), model).count() == 0


def test_op3_edge_rows(spark):
    docs, labels = train_rows(spark)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    model = quality_pu.train(frame, labels)
    rows = quality_pu.score_quality(H.edge_docs(spark), model).collect()
    assert len(rows) == len(H.edge_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    blank = quality_pu.train(frame, spark.createDataFrame([], LABELS))
    assert {r["score"] for r in quality_pu.score_quality(frame, blank).collect()} == {0.5}
    assert quality_pu.score_quality(H.no_docs(spark), model).count() == 0


def test_class_prior_and_non_negative_risk():
    """Two overlapping clusters: the prior is near the true share and the
    scores separate them although no negative was ever labelled."""
    rng = np.random.default_rng(5)
    good, bad = rng.normal(0, 1, (6000, 3)), rng.normal(3, 1, (1500, 3))
    positive, unlabelled = good[:3000], rng.permutation(np.vstack([good[3000:], bad]))
    prior = quality_pu.class_prior(positive, unlabelled)
    assert 0.55 <= prior <= 0.75   # true share: 3000 of 4500
    net = quality_pu.fit_pu(positive, unlabelled, prior)
    assert (net.score(good) >= 0.3).mean() > 0.95 and (net.score(bad) < 0.3).mean() > 0.9


def test_op3_class_prior_is_of_the_whole_corpus(spark):
    """The ids with the smallest hash are nearly all bad here, the corpus is
    nearly all good: the prior must be the corpus' share."""
    from pyspark.sql import functions as F

    ids = [r.id for r in spark.range(1200).orderBy(F.xxhash64(F.lit(1), "id"), "id").collect()]
    bad = set(ids[:150]) | set(ids[200:250])
    docs = [(i, "#$ 99 %%% " * 40 + f"{i} !!!" if i in bad else H.prose(i, 60)) for i in range(1200)]
    docs.append((None, H.prose(7, 60)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    good = [i for i in ids if i not in bad]
    labels = spark.createDataFrame([(i, 1, 0) for i in good], LABELS)
    model = quality_pu.train(frame, labels, positive_rows=800, unlabelled_rows=200)
    # true share: 1001 of 1201 (the smallest ratio lies somewhat below); of the sample: 50 of 200
    assert 0.65 <= model.prior <= 0.87


def test_corpus_shares_are_exact(spark):
    texts = [H.prose(i, 10 + i) for i in range(90)] + [None, ""]
    x = quality_pu.text_features([(t or "").encode() for t in texts])
    net = quality_pu._fit(x[:40], x[40:], lambda out, n: (quality_pu._sigmoid(out) - (np.arange(len(out)) < n)) / len(out))
    u = np.round(net.output(x), 9)
    cuts = np.quantile(u, np.linspace(0, 1, 12))
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    expected = [(u >= c).mean() for c in np.round(cuts, 9)]
    assert np.allclose(quality_pu.corpus_shares(frame, net, cuts), expected)
