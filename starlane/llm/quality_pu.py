"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled good texts; everything else is unlabelled web
text, good and bad.  A small network over text statistics minimises the
non-negative unbiased risk

    prior * R+(g) + max(0, R_u-(g) - prior * R_p-(g))

where R+ and R_p- are the positives' mean losses as good and as bad, and R_u-
the unlabelled texts' mean loss as bad.  The class prior is estimated too:
where a classifier of positives against unlabelled is most sure, unlabelled
texts are nearly all good, so their share there against the positives' share
bounds the prior from above; the smallest such ratio is taken.  The shares of
the unlabelled are counted over all texts of the corpus.

The samples that the networks are fitted on (positives and unlabelled texts)
are bounded by parameters; scores are computed for every whole text.  Labels, language, source and id are never inputs.

Edge cases: null and empty texts have zero statistics and get the score of
such texts; without positives or unlabelled texts every score is the prior
0.5; repeated rows score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import annotate, shared_dir, written
from starlane.llm.labels import labelled_sample
from starlane.llm.textscan import SPACED, Scan, mix, sorted_distinct

POSITIVE_ROWS = 10_000
UNLABELLED_ROWS = 20_000
HIDDEN = 24
STEPS = 2_500
FEATURES = ("log_words", "word_length", "symbols", "marks", "upper", "digits", "distinct", "runs", "windows", "long_words")


def text_features(texts: list[bytes]) -> np.ndarray:
    """One row of statistics per text."""
    scan = Scan(texts, SPACED)
    raw, n = scan.raw, len(texts)

    def counted(flags):
        total = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[scan.end] - total[scan.begin]).astype(float)

    def byte_flags(values):
        flags = np.zeros(256, dtype=bool)
        flags[list(values)] = True
        return flags[raw]

    words = np.maximum(scan.count, 1).astype(float)
    chars = counted(scan.inside & ((raw & 0xC0) != 0x80))
    plain = np.maximum(chars, 1)
    distinct = np.bincount(sorted_distinct(scan.doc, scan.hashes)[0], minlength=n)
    same = (scan.hashes[1:] == scan.hashes[:-1]) & (scan.doc[1:] == scan.doc[:-1])
    runs = np.bincount(scan.doc[1:], weights=same, minlength=n)
    at, hashes = scan.windows(8)
    fresh = np.bincount(sorted_distinct(scan.doc[at], mix(hashes))[0], minlength=n)
    windows = np.maximum(np.bincount(scan.doc[at], minlength=n), 1)
    long_words = np.bincount(scan.doc, weights=scan.ends - scan.starts > 12, minlength=n)
    return np.stack([
        np.log1p(scan.count), chars / words, np.log1p(20 * counted(byte_flags(b"#*$%&|<>~^_=+{}[]\\/@")) / words),
        np.log1p(20 * counted(byte_flags(b"!?")) / words), counted((raw >= 0x41) & (raw <= 0x5A)) / plain,
        counted((raw >= 0x30) & (raw <= 0x39)) / plain, distinct / words ** 0.9, runs / words,
        1 - np.minimum(fresh / windows, 1), long_words / words], axis=1)


@dataclass
class Network:
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def hidden(self, x):
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return z, np.tanh(z @ self.w1 + self.b1)

    def output(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[1] @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.output(x), -30, 30)))


def _fit(positive: np.ndarray, unlabelled: np.ndarray, grads, seed: int = 7) -> Network:
    """Adam on a loss given by its gradients with respect to the outputs."""
    rng = np.random.default_rng(seed)
    both = np.vstack([positive, unlabelled])
    net = Network(np.median(both, axis=0), both.std(axis=0) + 0.02,
                  rng.normal(0, 0.5, (both.shape[1], HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    moments = [[np.zeros_like(np.asarray(p, dtype=float)) for p in (net.w1, net.b1, net.w2, net.b2)] for _ in range(2)]
    for t in range(1, STEPS + 1):
        p = positive[rng.integers(0, len(positive), 512)]
        u = unlabelled[rng.integers(0, len(unlabelled), 1024)]
        x = np.vstack([p, u])
        z, h = net.hidden(x)
        out = h @ net.w2 + net.b2
        g = grads(out, len(p))
        back = np.outer(g, net.w2) * (1 - h * h)
        params = [net.w1, net.b1, net.w2, net.b2]
        steps = [z.T @ back + 1e-4 * net.w1, back.sum(axis=0), h.T @ g + 1e-4 * net.w2, g.sum()]
        for i, s in enumerate(steps):
            moments[0][i] = 0.9 * moments[0][i] + 0.1 * s
            moments[1][i] = 0.999 * moments[1][i] + 0.001 * s * s
            rate = 0.01 * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
            params[i] = params[i] - rate * moments[0][i] / (np.sqrt(moments[1][i]) + 1e-8)
        net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3])
    return net


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, shares=None) -> float:
    """Share of good texts among the unlabelled, from a classifier that tells
    positives from unlabelled: the smallest ratio of the two shares above any
    threshold that keeps at least a third of the positives.

    ``shares(network, cuts)`` gives the share of the unlabelled at or above
    each of the ascending cuts; without it, the half of ``unlabelled`` that
    the classifier has not seen is taken.

    A low estimate only scales the scores of good texts, while a high one
    would stop the bad ones from being learned, so no margin is added."""

    def grads(out, n_p):
        target = np.zeros(len(out))
        target[:n_p] = 1
        weight = np.where(target > 0, 0.5 / n_p, 0.5 / (len(out) - n_p))
        return weight * (_sigmoid(out) - target)

    half_p, half_u = len(positive) // 2, len(unlabelled) // 2
    net = _fit(positive[:half_p], unlabelled[:half_u], grads)
    p = np.sort(net.output(positive[half_p:]))
    cuts = np.quantile(p, np.linspace(0.0, 0.67, 68))
    share_p = 1 - np.searchsorted(p, cuts) / len(p)
    if shares is None:
        u = np.sort(net.output(unlabelled[half_u:]))
        share_u = 1 - np.searchsorted(u, cuts) / len(u)
    else:
        share_u = shares(net, cuts)
    return float(np.clip((share_u / np.maximum(share_p, 1e-9)).min(), 0.02, 0.98))


def corpus_shares(docs: DataFrame, net: Network, cuts: np.ndarray) -> np.ndarray:
    """Share of all texts of ``docs`` at or above each of the ascending cuts,
    by one aggregate."""
    rounded = np.round(cuts, 9)  # outputs of other batches may differ in the last bits

    def scorer():
        return lambda texts: {"reached": np.searchsorted(rounded, np.round(net.output(text_features(texts)), 9), "right")}

    rows = annotate(docs.select("text"), scorer, "reached int", keep=[]).groupBy("reached").count().collect()
    times = np.zeros(len(cuts) + 1)  # at most one row for each number of cuts reached
    for r in rows:
        times[r["reached"]] = r["count"]
    return np.cumsum(times[::-1])[::-1][1:] / times.sum()


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Network:
    """Minimise the non-negative risk (logistic loss)."""

    def grads(out, n_p):
        p, u = out[:n_p], out[n_p:]
        bad_p, bad_u = np.logaddexp(0, p), np.logaddexp(0, u)
        negative = bad_u.mean() - prior * bad_p.mean()
        g = np.zeros(len(out))
        if negative >= 0:
            g[:n_p] = prior * ((_sigmoid(p) - 1) - _sigmoid(p)) / n_p
            g[n_p:] = _sigmoid(u) / len(u)
        else:  # overfitted negatives: step back along the negative part only
            g[:n_p] = prior * _sigmoid(p) / n_p
            g[n_p:] = -_sigmoid(u) / len(u)
        return g

    return _fit(positive, unlabelled, grads)


@dataclass
class QualityModel:
    prior: float
    network: Network | None

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), 0.5)
        return self.network.score(text_features(texts))


def train(docs: DataFrame, labels: DataFrame, positive_rows: int = POSITIVE_ROWS,
          unlabelled_rows: int = UNLABELLED_ROWS) -> QualityModel:
    """Fit on at most ``positive_rows`` trusted good texts outside the
    held-out part and ``unlabelled_rows`` texts of the corpus, taken by the
    hash of their id; the class prior's shares are of all texts."""
    path = shared_dir(docs.sparkSession, "quality-pu")
    good = labelled_sample(docs, labels, "quality", positive_rows, f"{path}/good", only=1)
    ids = written(docs.where("doc_id IS NOT NULL").select("doc_id").distinct()
                  .orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(unlabelled_rows), f"{path}/ids")
    web = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text")  # at most unlabelled_rows

    def matrix(df):
        def scorer():
            return lambda texts: {"x": text_features(texts).tolist()}
        rows = annotate(df, scorer, "x array<double>", keep=[]).collect()  # bounded by the samples
        # a fixed order: training must not depend on the order of partitions
        return np.array(sorted(tuple(r["x"]) for r in rows))

    positive, unlabelled = matrix(good.select("text")), matrix(web)
    if len(positive) < 2 or len(unlabelled) < 2:
        return QualityModel(0.5, None)
    rng = np.random.default_rng(3)
    positive, unlabelled = rng.permutation(positive), rng.permutation(unlabelled)
    prior = class_prior(positive, unlabelled, lambda net, cuts: corpus_shares(docs, net, cuts))
    return QualityModel(prior, fit_pu(positive, unlabelled, prior))


def score_quality(docs: DataFrame, model: QualityModel, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is better text)."""

    def scorer():
        return lambda texts: {"score": model.score(texts)}

    return annotate(docs, scorer, "score double", keep=keep)
