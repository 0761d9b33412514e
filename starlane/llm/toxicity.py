"""Toxicity by a composed grammar of weighted finite-state transducers.

A text is cut into clauses, and each word becomes a symbol: insult, threat,
target, negation, report or other.  Three transducers read the symbols in a
cascade and mark insults and threats (classes of words, without transducers of
their own) as negated, reported or aimed at someone named before them; they are
composed into one machine, which scores matched clauses
(with their marks), not isolated words: "not an idiot" and "they said he is
an idiot" are other events than "you idiot".

Targets, negations, reports and threats are short closed lists.  The insult
lexicon (words and word stems, since insults are inflected and compounded) is
learned from a bounded sample of labelled texts: terms found almost only in
toxic texts, reduced to those needed to cover each toxic text a few times.
The weight of each kind of clause event is fitted by a logistic model held
near prior weights, so events that the sample lacks keep sensible ones.

Edge cases: null and empty texts have no events and score as the base rate of
eventless texts; repeated rows score alike; with no labels the lexicon is
empty and every score is the prior's.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import annotate, as_bytes, one_by_one, shared_dir, text_chunks
from starlane.llm.labels import labelled_sample
from starlane.llm.textscan import ALNUM, Scan, mix, span_hashes

SAMPLE_ROWS = 20_000      # labelled texts that lexicon and weights are fitted on
MIN_SUPPORT = 4           # toxic sample texts that a term must occur in
MIN_PRECISION = 0.5       # lower bound of the share of toxic texts among its texts
COVER = 3                 # terms wanted in each toxic text
MAX_TERMS = 4_000         # candidate terms (a bound on what reaches the driver)
STEMS = (4, 5, 6, 7)      # stem lengths in bytes

# Fixed closed word lists, all languages of the corpus together.
TARGETS = "you your yours yourself he him she her they them du dich dir ihr euch sie tu te toi vous usted ustedes él ella ellos".split()
NEGATIONS = "not no never nor neither isn aren cannot nicht kein keine keinen nie niemals pas jamais aucun aucune nunca jamás ningún ninguna".split()
REPORTS = "said says say wrote writes claimed claims quoted quote called calls told sagte sagt schrieb nannte behauptet dit disait écrit appelle dijo dice escribió llamó".split()
THREATS = "kill murder hurt beat destroy shoot stab burn töten umbringen schlagen vernichten tuer frapper détruire brûler matar golpear destruir quemar".split()

SYMBOLS = ("other", "insult", "threat", "target", "negation", "report", "end")
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
EVENTS = ("insult", "insult_aimed", "threat", "threat_aimed", "insult_negated", "threat_negated",
          "insult_reported", "threat_reported")
# prior weight of each event, and of the intercept
PRIOR = {"insult": 3.0, "insult_aimed": 3.5, "threat": 0.3, "threat_aimed": 1.5, "insult_negated": 0.3,
         "threat_negated": 0.0, "insult_reported": 0.5, "threat_reported": 0.0}
PRIOR_BIAS = -3.0
CLAUSE_ENDS = b".,;:!?()\n\""


@dataclass
class Transducer:
    """Deterministic weighted transducer: ``arcs[state][symbol]`` is
    (next state, output, weight); a missing arc copies its symbol and stays."""

    start: str
    arcs: dict[str, dict[str, tuple[str, str, float]]] = field(default_factory=dict)

    def step(self, state: str, symbol: str) -> tuple[str, str, float]:
        return self.arcs.get(state, {}).get(symbol, (state, symbol, 1.0))


def compose(first: Transducer, second: Transducer, symbols) -> Transducer:
    """Run ``second`` on the output of ``first``; weights multiply."""
    start = (first.start, second.start)
    out, todo, seen = Transducer(repr(start)), [start], {start}
    while todo:
        a, b = todo.pop()
        row = out.arcs.setdefault(repr((a, b)), {})
        for s in symbols:
            na, mid, wa = first.step(a, s)
            nb, label, wb = second.step(b, mid)
            row[s] = (repr((na, nb)), label, wa * wb)
            if (na, nb) not in seen:
                seen.add((na, nb))
                todo.append((na, nb))
    return out


def negation(reach: int = 4) -> Transducer:
    """Insults and threats up to ``reach`` words after a negation are negated."""
    t = Transducer("n0")
    t.arcs["n0"] = {"negation": (f"n{reach}", "negation", 1.0)}
    for k in range(1, reach + 1):
        nxt = f"n{k - 1}"
        t.arcs[f"n{k}"] = {s: (nxt, s, 1.0) for s in ("other", "target", "report")} | {
            "insult": (nxt, "insult_negated", 0.5), "threat": (nxt, "threat_negated", 0.5),
            "negation": (f"n{reach}", "negation", 1.0), "end": ("n0", "end", 1.0)}
    return t


def report() -> Transducer:
    """What follows a verb of saying in its clause, or in the next one, is reported."""
    t = Transducer("plain")
    t.arcs["plain"] = {"report": ("said", "report", 1.0)}
    marked = {"insult": "insult_reported", "threat": "threat_reported"}
    for state, after in (("said", "next"), ("next", "plain")):
        t.arcs[state] = {s: (state, m, 0.5) for s, m in marked.items()}
        t.arcs[state] |= {"report": ("said", "report", 1.0), "end": (after, "end", 1.0)}
    return t


def aim() -> Transducer:
    """Plain insults and threats after a target in the same clause are aimed."""
    t = Transducer("none")
    t.arcs["none"] = {"target": ("aimed", "target", 1.0)}
    t.arcs["aimed"] = {"insult": ("aimed", "insult_aimed", 1.25), "threat": ("aimed", "threat_aimed", 1.5),
                       "end": ("none", "end", 1.0)}
    return t


class Grammar:
    """The composed machine as tables over (state, symbol)."""

    def __init__(self):
        t = compose(negation(), report(), SYMBOLS)
        t = compose(t, aim(), SYMBOLS)
        names = list(t.arcs)
        place = {n: i for i, n in enumerate(names)}
        self.start = place[t.start]
        self.next = [[place[t.step(n, s)[0]] for s in SYMBOLS] for n in names]
        self.event = [[EVENTS.index(o) if (o := t.step(n, s)[1]) in EVENTS else -1 for s in SYMBOLS] for n in names]
        self.weight = [[t.step(n, s)[2] for s in SYMBOLS] for n in names]

    def run(self, symbols: list[int], weights: list[float]) -> list[float]:
        """Total weight of each event over one symbol sequence."""
        state, total = self.start, [0.0] * len(EVENTS)
        for s, w in zip(symbols, weights):
            e = self.event[state][s]
            if e >= 0:
                total[e] += w * self.weight[state][s]
            state = self.next[state][s]
        return total


def term_hashes(scan: Scan) -> list[np.ndarray]:
    """Hashes of each word and of its stems; a stem equals no whole word."""
    out = [scan.hashes]
    for k, n in enumerate(STEMS):
        cut = np.minimum(scan.starts + n, scan.ends)
        stem = mix(span_hashes(scan.bytes, scan.starts, cut) + np.uint64(1000 + k))
        stem[scan.ends - scan.starts <= n] = 0
        out.append(stem)
    return out


def word_hash(words: list[str]) -> np.ndarray:
    return Scan([w.encode() for w in words], ALNUM, lower=True).hashes if words else np.empty(0, np.uint64)


class Lexicon:
    """Symbol and weight of each word of a scan."""

    def __init__(self, terms: dict[int, float]):
        closed: dict[int, tuple[int, float]] = {}
        for symbol, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)):
            for h in word_hash(words).tolist():
                closed[h] = (symbol, 1.0)
        known = closed | {h: (INSULT, w) for h, w in terms.items()}
        self.hashes = np.array(sorted(known), dtype=np.uint64)
        self.symbol = np.array([known[h][0] for h in self.hashes.tolist()], dtype=np.int8)
        self.weight = np.array([known[h][1] for h in self.hashes.tolist()])

    def read(self, scan: Scan) -> tuple[np.ndarray, np.ndarray]:
        symbols = np.zeros(len(scan.starts), dtype=np.int8)
        weights = np.ones(len(scan.starts))
        for hashes in reversed(term_hashes(scan)):  # the whole word has the last say
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[at] == hashes
            symbols[hit], weights[hit] = self.symbol[at[hit]], self.weight[at[hit]]
        return symbols, weights


def clause_events(texts: list[bytes], lexicon: Lexicon, grammar: Grammar) -> np.ndarray:
    """Event totals per text.  Only texts with an insult or a threat run the
    machine; the others have no events."""
    scan = Scan(texts, ALNUM, lower=True)
    symbols, weights = lexicon.read(scan)
    out = np.zeros((len(texts), len(EVENTS)))
    ends = np.zeros(256, dtype=bool)
    ends[list(CLAUSE_ENDS)] = True
    for d in np.unique(scan.doc[(symbols == INSULT) | (symbols == THREAT)]).tolist():
        a, b = int(scan.first[d]), int(scan.first[d] + scan.count[d])
        stops = np.cumsum(ends[scan.raw[scan.begin[d]:scan.end[d]]])
        clause = stops[scan.starts[a:b] - scan.begin[d]]
        own_s, own_w, previous = [], [], clause[0]
        for s, w, c in zip(symbols[a:b].tolist(), weights[a:b].tolist(), clause.tolist()):
            if c != previous:
                own_s.append(END)
                own_w.append(1.0)
                previous = c
            own_s.append(s)
            own_w.append(w)
        out[d] = grammar.run(own_s, own_w)
    return out


def features(events: np.ndarray) -> np.ndarray:
    return np.log1p(events)


@dataclass
class ToxicityModel:
    terms: dict[int, float]
    weights: np.ndarray
    bias: float

    def score(self, events: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features(events) @ self.weights + self.bias)))


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, toxic, total): in how many sample texts each term occurs."""

    def count(batches):
        import pyarrow as pa

        for batch in one_by_one(batches):
            texts, label = as_bytes(batch.column(0)), np.array(batch.column(1).to_pylist())
            for first, part in text_chunks(texts):
                scan = Scan(part, ALNUM, lower=True)
                toxic = label[first:first + len(part)][scan.doc]
                for terms in term_hashes(scan):
                    keep = terms != 0
                    pair = np.unique(np.stack([terms[keep], scan.doc[keep].astype(np.uint64)
                                               * np.uint64(2) + toxic[keep].astype(np.uint64)]), axis=1)
                    term, where = np.unique(pair[0], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(term.view(np.int64)),
                         pa.array(np.bincount(where, weights=pair[1] % np.uint64(2)).astype(np.int64)),
                         pa.array(np.bincount(where).astype(np.int64))], names=["term", "toxic", "total"])

    return sample.mapInArrow(count, "term bigint, toxic bigint, total bigint") \
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("total").alias("total"))


def _lower_bound(hits: float, n: float) -> float:
    z = 1.96
    p = hits / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def learn_terms(sample: DataFrame) -> dict[int, float]:
    """Insult terms: candidates by precision, reduced by greedy covering."""
    top = _term_counts(sample).where((F.col("toxic") >= MIN_SUPPORT) & (F.col("toxic") >= MIN_PRECISION * F.col("total"))) \
        .orderBy(F.col("toxic").desc(), "total", "term").limit(MAX_TERMS).collect()
    candidates = {r["term"] & 0xFFFFFFFFFFFFFFFF: (r["toxic"], r["total"]) for r in top
                  if _lower_bound(r["toxic"], r["total"]) >= MIN_PRECISION}
    if not candidates:
        return {}
    known = np.array(sorted(candidates), dtype=np.uint64)

    def scorer():
        def score(texts, label):
            scan = Scan(texts, ALNUM, lower=True)
            found = [set() for _ in texts]
            for terms in term_hashes(scan):
                at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
                hit = np.flatnonzero(known[at] == terms)
                for d, k in zip(scan.doc[hit].tolist(), at[hit].tolist()):
                    if label[d]:
                        found[d].add(k)
            return {"found": [sorted(f) for f in found]}
        return score

    # toxic texts of the sample, each with its candidates: bounded by the sample
    rows = annotate(sample.where("label = 1"), scorer, "found array<int>", keep=[], more=["label"]).collect()
    texts_of: dict[int, list[int]] = {}
    for d, r in enumerate(rows):
        for k in r["found"]:
            texts_of.setdefault(k, []).append(d)
    need = np.full(len(rows), COVER)
    chosen: dict[int, float] = {}
    while texts_of:
        gain = {k: int((need[v] > 0).sum()) for k, v in texts_of.items()}
        best = max(gain, key=lambda k: (gain[k], -k))
        if gain[best] < MIN_SUPPORT:
            break
        need[texts_of.pop(best)] -= 1
        toxic, total = candidates[int(known[best])]
        chosen[int(known[best])] = math.log((toxic + 0.5) / (total - toxic + 0.5))
    return chosen


def fit_weights(events: np.ndarray, label: np.ndarray, strength: float = 2.0) -> tuple[np.ndarray, float]:
    """Logistic weights by Newton steps, held near the prior."""
    x = np.hstack([features(events), np.ones((len(events), 1))])
    prior = np.array([PRIOR[e] for e in EVENTS] + [PRIOR_BIAS])
    w = prior.copy()
    hold = np.full(len(w), strength)
    hold[-1] = 0.01
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - label) + hold * (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(hold)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn lexicon and weights from at most ``rows`` labelled texts outside
    the held-out part."""
    path = shared_dir(docs.sparkSession, "toxicity")
    sample = labelled_sample(docs, labels, "toxic", rows, f"{path}/sample")
    terms = learn_terms(sample)

    def scorer():
        lexicon, grammar = Lexicon(terms), Grammar()
        return lambda texts: {"events": clause_events(texts, lexicon, grammar).tolist()}

    got = annotate(sample, scorer, "events array<double>", keep=["label"]).collect()  # bounded by ``rows``
    if not got:
        return ToxicityModel(terms, np.array([PRIOR[e] for e in EVENTS]), PRIOR_BIAS)
    weights, bias = fit_weights(np.array([r["events"] for r in got]), np.array([r["label"] for r in got], dtype=float))
    return ToxicityModel(terms, weights, bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and the event totals behind it."""

    def scorer():
        lexicon, grammar = Lexicon(model.terms), Grammar()

        def score(texts):
            events = clause_events(texts, lexicon, grammar)
            return {"score": model.score(events), **{e: events[:, i] for i, e in enumerate(EVENTS)}}
        return score

    return annotate(docs, scorer, "score double, " + ", ".join(f"{e} double" for e in EVENTS), keep=keep)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` below the threshold, columns as they came."""
    scored = score_toxicity(docs.withColumn("keep_row", F.struct(*docs.columns)), train(docs, labels), keep=["keep_row"])
    return scored.where(F.col("score") < threshold).select("keep_row.*")
