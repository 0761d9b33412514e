"""Katz backoff language model over a corpus, and every text's log probability.

Tokens are the lower-cased (A-Z) words of a text and one end; the contexts
before a text's first word are start marks.  An n-gram seen r times in training
counts r* < r: the Good-Turing estimate (r + 1) n[r+1] / n[r] up to ``TURING``
times, r less the last estimate's discount beyond.  With C the times its context was
seen,

    P(w | context) = r* / C                            for a seen n-gram
    P(w | context) = a(context) P(w | shorter context)  for an unseen one

and a(context) = (1 - sum of r* / C) / (1 - sum of P(w | shorter context)),
both sums over the words seen there, so every context's probabilities add up to
one.  At the bottom what the known words leave goes to the unknown word, which
is therefore never impossible.  A context never seen hands on unchanged.

The corpus becomes packets, a few million tokens each, of word numbers and
documents.  The n-gram tables are partitioned by key (a 64-bit hash of the
words).  A packet sends each of its distinct n-grams once, with its training
count, and gets the total back; the table marks one packet as the owner of each
n-gram, which so enters its context's two sums exactly once, though no task
sees a whole context.  The contexts' sums go the same way.  Every packet then
walks its tokens down the orders.  A frequent word, context or passage is thus
one key of a packet like any other.

The tables are written to the shared folder and hold nothing but counts, so
they grow with the corpus; what reaches the driver are the counts of counts.
``order`` is 2 in the query: the tables of longer n-grams pass its disk limit.

Edge cases: a null or empty text is its end alone; rows without doc_id are
trained on; repeated rows count and score as often as they occur; with nothing
to train on every probability is that of the unknown word, one; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import as_bytes, one_by_one, shared_dir, text_chunks, written
from starlane.llm.textscan import SPACED, Scan, mix

ORDER = 2
TURING = 5                      # larger counts take the discount of this one
PACKET_TOKENS = 4_500_000       # tokens of a packet; a text stays whole
PART_KEYS = 2_000_000           # n-grams aimed at in one part of a table
END, START = (np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344))

_U = np.uint64


# ---- packets --------------------------------------------------------------------

def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, tokens of each text), ends included."""
    hashes, sizes = [], []
    for _, part in text_chunks(texts):
        scan = Scan(part, SPACED, lower=True)
        size = scan.count + 1
        out = np.full(int(size.sum()), END)
        out[np.arange(len(scan.hashes)) + scan.doc] = scan.hashes
        hashes.append(out)
        sizes.append(size)
    return np.concatenate(hashes), np.concatenate(sizes)


def _packet(number: int, hashes: np.ndarray, columns: dict) -> dict:
    """A packet row: distinct words by falling frequency, and the tokens as
    word numbers in two halves (the high one is nearly all zeros)."""
    words, at, times = np.unique(hashes, return_inverse=True, return_counts=True)
    rank = np.argsort(-times, kind="stable")
    place = np.empty(len(rank), dtype=np.uint32)
    place[rank] = np.arange(len(rank), dtype=np.uint32)
    at = place[at]
    return {"packet": number, "words": words[rank].tobytes(), "low": (at & 0xFFFF).astype(np.uint16).tobytes(),
            "high": (at >> 16).astype(np.uint16).tobytes(), **columns}


def packets(docs: DataFrame, train: Column, limit: int = PACKET_TOKENS) -> DataFrame:
    """One row a packet of ``docs`` (doc_id, text); ``train`` marks the rows to
    learn from."""
    rows = docs.select("doc_id", F.coalesce(train, F.lit(True)).alias("train"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = (f"packet bigint, words binary, low binary, high binary, doc_id array<{kind}>, train array<boolean>, "
              "sizes array<bigint>")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held, ids, flags, sizes, n = [], [], [], [], 0

        def close():
            row = _packet(number, np.concatenate(held), {"doc_id": ids, "train": flags, "sizes": sizes})
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = None
        for batch in one_by_one(batches):
            if schema is None:
                schema = pa.schema([("packet", pa.int64()), ("words", pa.binary()), ("low", pa.binary()),
                                    ("high", pa.binary()), ("doc_id", pa.list_(batch.schema.field(0).type)),
                                    ("train", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64()))])
            texts = as_bytes(batch.column(2))
            own, flag = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, part in text_chunks(texts):
                hashes, size = _tokens(part)
                if n and n + len(hashes) > limit:
                    yield close()
                    number += 1
                    held, ids, flags, sizes, n = [], [], [], [], 0
                held.append(hashes)
                ids += own[first:first + len(part)]
                flags += flag[first:first + len(part)]
                sizes += size.tolist()
                n += len(hashes)
        if n:
            yield close()

    return rows.mapInArrow(run, fields)


class Packet:
    """A packet's n-grams of every order.

    Of order n: ``ids`` the n-gram of each token; per distinct n-gram its
    ``keys``, its context ``above`` (0: start, else 1 + an n-gram of the order
    below) and ``lower`` (the n-gram without its first word)."""

    def __init__(self, row: dict, order: int, parts: int):
        self.words = np.frombuffer(row["words"], dtype=np.uint64)
        low, high = (np.frombuffer(row[c], dtype=np.uint16).astype(np.int64) for c in ("low", "high"))
        word = low | (high << 16)
        self.doc_id, self.train = row["doc_id"], np.array(row["train"], dtype=bool)
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        first = np.cumsum(self.sizes) - self.sizes
        self.trained = self.train[self.doc]
        self.ids, self.keys, self.above, self.lower = [word], [self.words], [None], [None]
        n_words = len(self.words)
        for n in range(2, order + 1):
            before = np.empty(len(word), dtype=np.int64)
            before[1:] = self.ids[-1][:-1] + 1
            before[first] = 0
            codes, at, ids = np.unique(before * n_words + word, return_index=True, return_inverse=True)
            above = codes // n_words
            context = np.concatenate([[START], self.keys[-1]])
            self.keys.append(mix((context[above] + _U(n)) * _U(0xA0761D6478BD642F) + self.words[codes % n_words]))
            self.lower.append(self.ids[-1][at])
            self.above.append(above)
            self.ids.append(ids)
        self.parts = parts

    def in_parts(self, keys: np.ndarray):
        """(order of the keys by part and key, [(part, from, to)])."""
        part = (keys % _U(self.parts)).astype(np.int64)
        order = np.lexsort((keys, part))
        edges = np.searchsorted(part[order], np.arange(self.parts + 1))
        return order, [(p, int(edges[p]), int(edges[p + 1])) for p in np.flatnonzero(np.diff(edges))]


def _pack(counts: np.ndarray) -> tuple[bytes, list]:
    """Counts as bytes; those of 255 and more also in a list."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes(), counts[small == 255].tolist()


def _unpack(small: bytes, large: list) -> np.ndarray:
    counts = np.frombuffer(small, dtype=np.uint8).astype(np.int64)
    if large:
        counts[counts == 255] = large
    return counts


# ---- the n-gram tables ------------------------------------------------------------

def _requests(made: DataFrame, order: int, parts: int) -> DataFrame:
    """Each packet's distinct n-grams with their training counts, a row a part."""

    def run(batches):
        import pyarrow as pa

        for b in one_by_one(batches):
            for row in b.to_pylist():
                p = Packet(row, order, parts)
                for n in range(1, order + 1):
                    keys, ids = p.keys[n - 1], p.ids[n - 1]
                    counts = np.bincount(ids[p.trained], minlength=len(keys))
                    by, slices = p.in_parts(keys)
                    keys, counts = keys[by], counts[by]
                    rows = [(row["packet"], n, part, keys[lo:hi].tobytes(), *_pack(counts[lo:hi]))
                            for part, lo, hi in slices]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=t) for c, t in zip(zip(*rows), (
                            pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())))],
                        names=["packet", "n", "part", "keys", "small", "large"])

    return made.mapInArrow(run, "packet bigint, n int, part int, keys binary, small binary, large array<bigint>")


def _total(group):
    """One part of a table: the totals of its n-grams, back to every packet."""
    import pyarrow as pa

    rows = sorted(group.to_pylist(), key=lambda r: r["packet"])
    keys = [np.frombuffer(r["keys"], dtype=np.uint64) for r in rows]
    counts = np.concatenate([_unpack(r["small"], r["large"]) for r in rows])
    _, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    totals = np.bincount(at, weights=counts).astype(np.int64)
    owner = np.zeros(len(at), dtype=bool)
    owner[first] = True
    seen = np.bincount(np.minimum(totals, TURING + 2), minlength=TURING + 3)
    stats = [int(totals.sum()), int((totals > 0).sum()), *map(int, seen[1:TURING + 2])]
    out, lo = [], 0
    for i, (r, k) in enumerate(zip(rows, keys)):
        here = slice(lo, lo + len(k))
        lo += len(k)
        small, large = _pack(totals[at[here]])
        out.append((r["packet"], r["n"], r["part"], small, large, np.packbits(owner[here]).tobytes(),
                    None if i else stats))
    return pa.Table.from_arrays(
        [pa.array(c, type=t) for c, t in zip(zip(*out), (
            pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())))],
        names=["packet", "n", "part", "small", "large", "owned", "stats"])


class Discounts:
    """r* of the n-grams of one order, from its counts of counts."""

    def __init__(self, total: int, distinct: int, counts: list[int]):
        self.total, self.distinct = total, distinct
        n = [0, *counts]
        spare = min(max(n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5, 0.1), 0.9)   # where no estimate can be made
        self.small = np.zeros(TURING + 1)
        for r in range(1, TURING + 1):
            turing = (r + 1) * n[r + 1] / n[r] if n[r] else 0.0
            self.small[r] = turing if 0 < turing < r else r - spare
        self.beyond = TURING - self.small[TURING]
        low = sum(n[1:TURING + 1])
        used = sum(n[r] * self.small[r] for r in range(1, TURING + 1)) \
            + total - sum(r * n[r] for r in range(1, TURING + 1)) - self.beyond * (distinct - low)
        # what the known words leave (of the first order)
        self.unknown = 1 - used / total if total else 1.0

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= TURING, self.small[np.minimum(counts, TURING)], counts - self.beyond)


def _discounts(answers: DataFrame, order: int) -> list[Discounts]:
    rows = answers.where("stats IS NOT NULL").select("n", F.posexplode("stats").alias("i", "x")) \
        .groupBy("n", "i").agg(F.sum("x").alias("x")).collect()     # a few numbers an order
    got = {(r["n"], r["i"]): int(r["x"]) for r in rows}
    return [Discounts(got.get((n, 0), 0), got.get((n, 1), 0), [got.get((n, i), 0) for i in range(2, TURING + 3)])
            for n in range(1, order + 1)]


# ---- weights and scores -----------------------------------------------------------

WEIGHED = ("packet bigint, n int, part int, keys binary, freed binary, lower binary, wanted binary, "
           "doc_id array<{}>, train array<boolean>, tokens array<bigint>, known array<bigint>, "
           "base binary, score binary, slot binary, slot_doc binary, slot_times binary, seen binary")


def _weigh(model: list[Discounts], order: int, parts: int, texts: int, schema):
    """A packet with its totals: what its own n-grams add to their contexts'
    sums, and its documents' scores but for the backoff weights, which are
    listed as (context, document, times)."""

    def run(left, right):
        import pyarrow as pa

        row = left.to_pylist()[0]
        p = Packet(row, order, parts)
        answers = sorted(right.to_pylist(), key=lambda r: (r["n"], r["part"]))
        counts, owned = [], []
        for n in range(1, order + 1):
            mine = [a for a in answers if a["n"] == n]
            by, _ = p.in_parts(p.keys[n - 1])
            totals = [_unpack(a["small"], a["large"]) for a in mine]
            c, o = np.empty(len(by), dtype=np.int64), np.empty(len(by), dtype=bool)
            c[by] = np.concatenate(totals)
            o[by] = np.concatenate([np.unpackbits(np.frombuffer(a["owned"], dtype=np.uint8), count=len(t)).astype(bool)
                                    for a, t in zip(mine, totals)])
            counts.append(c)
            owned.append(o)

        first = model[0]
        n_docs = len(p.sizes)
        chance = np.where(counts[0] > 0, first(counts[0]) / max(first.total, 1), first.unknown)
        base = np.log10((counts[0] + 0.5) / (first.total + 0.5 * (first.distinct + 1)))
        per_doc = lambda x: np.bincount(p.doc, weights=x, minlength=n_docs)
        known = per_doc(counts[0][p.ids[0]] > 0).astype(np.int64)
        log_p = np.log10(chance)[p.ids[0]]
        out, slots, offset = [], [], 0
        for n in range(2, order + 1):
            c, above, lower = counts[n - 1], p.above[n - 1], p.lower[n - 1]
            context = np.concatenate([[texts], counts[n - 2]])      # times each context was seen
            mass, seen = model[n - 1](c), c > 0
            add = owned[n - 1] & seen
            freed = np.bincount(above[add], weights=(c - mass)[add], minlength=len(context))
            below = np.bincount(above[add], weights=chance[lower][add], minlength=len(context))
            # backoff at this order: unseen n-grams of seen contexts
            ids = p.ids[n - 1]
            off = np.flatnonzero(~seen[ids] & (context[above[ids]] > 0))
            wanted = np.zeros(len(context), dtype=bool)
            wanted[above[ids[off]]] = True
            used = np.flatnonzero(wanted | (freed > 0))
            keys = np.concatenate([[START], p.keys[n - 2]])[used]
            by, cuts = p.in_parts(keys)
            used, keys = used[by], keys[by]
            for part, lo, hi in cuts:
                at = used[lo:hi]
                out.append({"packet": row["packet"], "n": n, "part": part, "keys": keys[lo:hi].tobytes(),
                            "freed": freed[at].tobytes(), "lower": below[at].tobytes(),
                            "wanted": np.packbits(wanted[at]).tobytes()})
            asked = used[wanted[used]]
            slot = np.full(len(context), -1, dtype=np.int64)
            slot[asked] = offset + np.arange(len(asked))
            cells, times = np.unique(slot[above[ids[off]]] * n_docs + p.doc[off], return_counts=True)
            slots.append((cells, times, context[asked]))
            offset += len(asked)
            chance = np.where(seen, mass / np.maximum(context[above], 1), 0.0)
            log_p = np.where(seen[ids], np.log10(np.where(seen, chance, 1.0))[ids], log_p)
        cells = np.concatenate([s[0] for s in slots] + [np.empty(0, dtype=np.int64)])
        times = np.concatenate([s[1] for s in slots] + [np.empty(0, dtype=np.int64)])
        asked = np.concatenate([s[2] for s in slots] + [np.empty(0, dtype=np.int64)])
        out.append({"packet": row["packet"], "n": 0, "doc_id": p.doc_id, "train": row["train"],
                    "tokens": row["sizes"], "known": known.tolist(), "base": per_doc(base[p.ids[0]]).tobytes(),
                    "score": per_doc(log_p).tobytes(), "slot": (cells // n_docs).astype(np.int32).tobytes(),
                    "slot_doc": (cells % n_docs).astype(np.int32).tobytes(),
                    "slot_times": times.astype(np.int32).tobytes(), "seen": asked.tobytes()})
        return pa.Table.from_pylist(out, schema=schema)

    return run


def _backoff(group):
    """One part of the contexts: freed mass over what the seen words have at
    the order below, to the packets that ask."""
    import pyarrow as pa

    rows = sorted(group.to_pylist(), key=lambda r: r["packet"])
    read = lambda c, t: [np.frombuffer(r[c], dtype=t) for r in rows]
    keys = read("keys", np.uint64)
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    freed = np.bincount(at, weights=np.concatenate(read("freed", np.float64)))
    lower = np.bincount(at, weights=np.concatenate(read("lower", np.float64)))
    weight = freed / (1 - lower)
    out, lo = [], 0
    for r, k in zip(rows, keys):
        here = at[lo:lo + len(k)]
        lo += len(k)
        wanted = np.unpackbits(np.frombuffer(r["wanted"], dtype=np.uint8), count=len(k)).astype(bool)
        if wanted.any():
            out.append((r["packet"], r["n"], r["part"], weight[here[wanted]].tobytes()))
    return pa.Table.from_arrays(
        [pa.array([o[i] for o in out], type=t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
        names=["packet", "n", "part", "weights"])


def _finish(left, right, total, schema):
    import pyarrow as pa

    row = left.to_pylist()[0]
    score = np.frombuffer(row["score"], dtype=np.float64).copy()
    slot, doc, times = (np.frombuffer(row[c], dtype=np.int32) for c in ("slot", "slot_doc", "slot_times"))
    if len(slot):
        answers = sorted(right.to_pylist(), key=lambda r: (r["n"], r["part"]))
        weights = np.concatenate([np.frombuffer(a["weights"], dtype=np.float64) for a in answers])
        logs = np.log10(weights / np.frombuffer(row["seen"], dtype=np.int64))
        score += np.bincount(doc, weights=logs[slot] * times, minlength=len(score))
    rows = len(score)
    return pa.Table.from_arrays(
        [pa.array(row["doc_id"], type=schema.field(0).type), pa.array([not t for t in row["train"]]),
         pa.array(row["tokens"], type=pa.int64()), pa.array(row["known"], type=pa.int64()),
         pa.array(np.full(rows, total)), pa.array(np.frombuffer(row["base"], dtype=np.float64)), pa.array(score)],
        names=schema.names)


def score_texts(docs: DataFrame, train: Column, order: int = ORDER, packet_tokens: int = PACKET_TOKENS,
                part_keys: int = PART_KEYS) -> DataFrame:
    """One row a row of ``docs`` (doc_id, text), learned from the rows that
    ``train`` marks: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score`` (add-half unigrams) and ``score`` (the model), both log10."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = docs.sparkSession
    path = shared_dir(spark, "katz")
    made = written(packets(docs, train, packet_tokens), f"{path}/packets")
    size = made.agg(F.sum(F.octet_length("low") / 2).alias("tokens"),
                    F.sum(F.size(F.filter("train", lambda t: t))).alias("texts")).first()
    # parts of a bounded number of n-grams, and enough for every core
    parts = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")),
                math.ceil(order * (size["tokens"] or 0) / part_keys))
    asked = _requests(made, order, parts)
    answers = written(asked.groupBy("n", "part").applyInArrow(
        _total, "packet bigint, n int, part int, small binary, large array<bigint>, owned binary, stats array<bigint>"),
        f"{path}/ngrams")
    model = _discounts(answers, order)
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = WEIGHED.format(kind)
    weigh = _weigh(model, order, parts, int(size["texts"] or 0), to_arrow_schema(StructType.fromDDL(fields)))
    weighed = written(made.groupBy("packet").cogroup(answers.groupBy("packet")).applyInArrow(
        lambda left, right: weigh(left, right), fields), f"{path}/weighed")
    weights = weighed.where("n > 0").select("packet", "n", "part", "keys", "freed", "lower", "wanted") \
        .groupBy("n", "part").applyInArrow(_backoff, "packet bigint, n int, part int, weights binary")
    weights = written(weights, f"{path}/contexts")
    result = (f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double")
    schema, total = to_arrow_schema(StructType.fromDDL(result)), model[0].total
    states = weighed.where("n = 0").select("packet", "doc_id", "train", "tokens", "known", "base", "score", "slot",
                                           "slot_doc", "slot_times", "seen")
    return states.groupBy("packet").cogroup(weights.groupBy("packet")).applyInArrow(
        lambda left, right: _finish(left, right, total, schema), result)


def training_rows(doc_id: str = "doc_id") -> Column:
    """The query's rule: all but the ids whose crc32 as text leaves 1 of 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 1, F.lit(True))
