"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct shingles of five words (fewer words: the
whole sequence).  Instead of one minhash group per table, two collections A
and B of ``m`` groups of ``r`` minhashes are computed; table (i, j) has the
key (A_i, B_j), so ``m * m`` tables need ``2 * m * r`` minhashes.  A pair of
similarity s meets in some table with probability (1 - (1 - s^r)^m)^2: at
s = 0.85 with r = 3 and m = 12, all but 0.00002.

Documents with equal sets (128-bit fingerprint) are one node.  Nodes that
meet in an A bucket and in some B bucket are candidates; every candidate link
is confirmed on the full sets, in rounds of a few hubs per bucket (see
``components``; the most central nodes first), so a bucket of thousands of copies costs a few comparisons a
node and still loses no link.  Pairs (A_i, B_j) are spelt out as table keys
only for buckets that the first round leaves unresolved.  A large bucket of
texts that are alike but mostly not linked (copies with many edits) would need
all its pairs; its nodes are compared by the exact prefix filter instead.

Edge cases: null and empty texts have no shingles and are linked with
nothing; equal texts are one node whatever their ids; rows without id share
their group's component and are not kept if it has an id; repeated rows get
equal results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import annotate, one_by_one, shared_dir, written
from starlane.llm.components import hub_pairs, if_small, link_buckets, shared_buckets, unresolved
from starlane.llm.components import components as merge
from starlane.llm.textscan import SPACED, Scan, mix, sorted_distinct, window_hashes

SHINGLE_WORDS = 5
MIN_PERCENT = 85
GROUPS = 12     # m: minhash groups in each collection
ROWS = 3        # r: minhashes in a group
LARGE_BUCKET = 64           # larger unresolved buckets go by prefix keys
COMMON_SHINGLES = 200_000   # frequent shingles whose counts order the prefixes
# The scan keeps some forty times its text in numpy arrays: small passes leave
# the worker small, and an Arrow batch is not copied whole into Python objects.
SCAN = {"rows_at_once": 500, "chunk_bytes": 250_000}

_U = np.uint64


def shingle_sets(texts: list[bytes], n: int = SHINGLE_WORDS):
    """(doc, hash) of the distinct shingles, sorted by doc then hash."""
    scan = Scan(texts, SPACED, lower=True)
    at, hashes = scan.windows(n)
    doc = scan.doc[at]
    short = np.flatnonzero((scan.count > 0) & (scan.count < n))
    if len(short):  # the whole sequence as one shingle
        whole = np.array([window_hashes(scan.hashes[scan.first[d]:scan.first[d] + scan.count[d]],
                                        int(scan.count[d]))[0] for d in short], dtype=np.uint64)
        doc, hashes = np.concatenate([doc, short]), np.concatenate([hashes, whole])
    return sorted_distinct(doc, hashes)


def _seeds(count: int, salt: int) -> np.ndarray:
    return mix((np.arange(1, count + 1, dtype=np.uint64) + _U(salt)) * _U(0x9E3779B97F4A7C15))


def _summaries(doc: np.ndarray, hashes: np.ndarray, n_docs: int, groups: int, rows: int):
    """Per text: set size, two fingerprint words, group keys of A and of B."""
    size = np.bincount(doc, minlength=n_docs).astype(np.int64)
    has = np.flatnonzero(size)
    at = (np.cumsum(size) - size)[has]
    f = np.zeros((2, n_docs), dtype=np.uint64)
    keys = np.zeros((2, n_docs, groups), dtype=np.uint64)
    if len(has):
        f[0, has] = np.add.reduceat(mix(hashes + _U(11)), at)
        f[1, has] = np.bitwise_xor.reduceat(mix(hashes ^ _U(0x5BF03635)), at)
        seeds = _seeds(2 * groups * rows, 77).reshape(2, groups, rows)
        for side in range(2):
            for g in range(groups):
                key = np.full(len(has), _U(side * groups + g + 1), dtype=np.uint64)
                for r in range(rows):
                    seed = seeds[side, g, r]
                    ranked = (hashes ^ (seed >> _U(1))) * (seed | _U(1))
                    ranked ^= ranked >> _U(32)
                    ranked *= _U(0xD6E8FEB86659FD93)
                    key = mix(key * _U(0xA0761D6478BD642F) + np.minimum.reduceat(ranked, at))
                keys[side, has, g] = key
    return size, f.view(np.int64), keys.view(np.int64)


def signatures(docs: DataFrame, keep: list[str], groups: int = GROUPS, rows: int = ROWS) -> DataFrame:
    """``n_shingles``, fingerprint ``f1, f2`` and group keys ``a, b`` of each text."""

    def scorer():
        def score(texts):
            size, f, keys = _summaries(*shingle_sets(texts), len(texts), groups, rows)
            lists = [[k.tolist() if n else [] for k, n in zip(keys[side], size)] for side in range(2)]
            return {"n_shingles": size, "f1": f[0], "f2": f[1], "a": lists[0], "b": lists[1]}
        return score

    return annotate(docs, scorer, "n_shingles bigint, f1 bigint, f2 bigint, a array<bigint>, b array<bigint>",
                    keep=keep, **SCAN)


class SetStore:
    """Full shingle sets of the nodes that candidates need, computed once each."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, path: str):
        self.docs, self.nodes, self.path, self.parts = docs, nodes, path, []

    def sets(self) -> DataFrame:
        out = self.parts[0]
        for p in self.parts[1:]:
            out = out.union(p)
        return out

    def add(self, needed: DataFrame) -> None:
        """Make sure that the sets of the distinct nodes ``needed`` are there."""
        if self.parts:
            needed = needed.join(self.sets().select("node"), "node", "left_anti")
        k = len(self.parts)
        needed = if_small(written(needed, f"{self.path}/wanted-{k}"))
        # one text per node stands for all with the same set; an id alone may be that of many texts
        ids = written(self.nodes.join(needed, "node", "left_semi")
                      .select("node", F.col("owner.doc_id").alias("id"), F.col("owner.text_key").alias("key")),
                      f"{self.path}/needed-{k}")
        texts = self.docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").join(
            if_small(ids), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))) \
            .select("node", "text")

        def scorer():
            def score(batch):
                doc, hashes = shingle_sets(batch)
                sets = np.split(hashes.view(np.int64), np.cumsum(np.bincount(doc, minlength=len(batch)))[:-1])
                return {"shingles": [s.tolist() for s in sets]}
            return score

        made = written(annotate(texts, scorer, "shingles array<bigint>", keep=["node"], **SCAN), f"{self.path}/sets-{k}")
        if made.count() > ids.count():  # repeated rows
            made = written(made.dropDuplicates(["node"]), f"{self.path}/single-sets-{k}")
        self.parts.append(made)

    def confirmed(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The pairs (a, b) with 100 * intersection >= percent * union."""
        self.add(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        sets = self.sets()
        # only the sets of these pairs are shuffled
        others = sets.toDF("b", "set_b").join(if_small(pairs.select("b")), "b", "left_semi")
        both = sets.toDF("a", "set_a").join(if_small(pairs), "a").join(others, "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - common
        return both.where(100 * common >= percent * union).select("a", "b")


def reachable(percent: int) -> str:
    """SQL: a node m and a hub h that share an element at 0-based positions
    ``pos`` of their ordered sets of size ``n`` can still reach the overlap
    that the similarity needs (at position 0: the sizes are close enough)."""
    return f"(100 + {percent}) * least(m.n - m.pos, h.n - h.pos) >= {percent} * (m.n + h.n)"


def prefix_keys(sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, order, n, pos) of prefix-filter keys of ``sets`` (node,
    shingles, order).

    In any fixed order of all shingles, two sets of similarity t share one of
    the first ``n - ceil(t * n) + 1`` elements of each, at positions that
    leave room for the overlap (``reachable``); other pairs are no links.  The
    filter is exact.  Rare shingles come first (counted on a part of the sets;
    the count only decides the order, not the result), so copies with many
    edits of their own meet nobody."""
    spark = sets.sparkSession
    counted = sets.where(F.pmod(F.xxhash64("node"), F.lit(8)) == 0).select(F.explode("shingles").alias("x")) \
        .groupBy("x").count().where("count > 1").orderBy(F.col("count").desc(), "x").limit(COMMON_SHINGLES)
    common = sorted((r["x"], r["count"]) for r in counted.collect())  # at most COMMON_SHINGLES
    table = spark.sparkContext.broadcast((np.array([c[0] for c in common], dtype=np.int64),
                                          np.array([c[1] for c in common], dtype=np.int64)))

    def run(batches):
        import pyarrow as pa

        known, counts = table.value
        for batch in one_by_one(batches):
            keys = []
            nodes, orders, shingles = (c.to_pylist() for c in batch.columns)
            for s in shingles:
                x = np.array(s, dtype=np.int64)
                times = np.zeros(len(x), dtype=np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                    times[known[at] == x] = counts[at[known[at] == x]]
                keys.append(x[np.lexsort((x, times))[:len(x) - -(-percent * len(x) // 100) + 1]])
            lengths = [len(k) for k in keys]
            which = np.repeat(np.arange(len(keys)), lengths)
            pos = np.concatenate([np.arange(n) for n in lengths])
            sizes = np.array([len(s) for s in shingles])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.array(nodes)[which]), pa.array(np.array(orders)[which]),
                 pa.array(sizes[which]), pa.array(pos.astype(np.int32))], names=["bucket", "node", "order", "n", "pos"])

    return sets.select("node", "order", "shingles").mapInArrow(
        run, "bucket bigint, node bigint, order bigint, n bigint, pos int")


def linked_rows(docs: DataFrame, percent: int = MIN_PERCENT, groups: int = GROUPS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, text_key,
    n_shingles, component_id`` (smallest doc_id reachable over links) and
    ``component``, a number of the group (null for texts without shingles).

    Ids may repeat with other texts or be missing; the group is of the text."""
    spark = docs.sparkSession
    path = shared_dir(spark, "near-dup")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    signed = written(signatures(keyed, ["doc_id", "text_key"], groups, rows), f"{path}/signed")
    nodes = signed.where("n_shingles > 0").groupBy("f1", "f2").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_key")).alias("owner"),
        F.first("n_shingles").alias("n"), F.first("a").alias("a"), F.first("b").alias("b"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), f"{path}/nodes")

    # nodes that share a bucket in A and one in B
    entries = nodes.select("node", F.posexplode(F.concat("a", "b")).alias("i", "bucket"))
    entries = entries.select("bucket", "node", (F.col("i") < groups).alias("in_a"))
    entries = written(shared_buckets(entries, f"{path}/shared"), f"{path}/entries")
    suspects = entries.groupBy("node").agg(
        F.max(F.col("in_a").cast("int")).alias("x"), F.min(F.col("in_a").cast("int")).alias("y"),
        (-F.sum("size")).alias("order")).where("x = 1 AND y = 0")  # order: central nodes first
    suspects = written(suspects.select("node", "order"), f"{path}/suspects")
    in_a = written(entries.where("in_a").join(if_small(suspects), "node").select("bucket", "node", "order"),
                   f"{path}/in-a")
    profile = nodes.select("node", "n", "b")
    store = SetStore(docs, nodes, path)

    # first round: one hub per A bucket; equal A_i already, and a table (i, j)
    # is shared if some B_j is equal too
    _, pairs = hub_pairs(in_a.withColumn("label", F.col("node")), 1, f"{path}/hubs")
    pairs = written(pairs, f"{path}/pairs")
    sized = written(profile.toDF("a", "n_a", "b_a").join(if_small(pairs), "a"), f"{path}/sized")
    sized = profile.toDF("b", "n_b", "b_b").join(if_small(sized, 200_000), "b")
    sized = sized.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) \
        .where(F.arrays_overlap("b_a", "b_b"))
    links = written(store.confirmed(written(sized.select("a", "b"), f"{path}/candidates"), percent),
                    f"{path}/links-first")
    labels = written(merge(links, f"{path}/first"), f"{path}/labels-first")

    # what is left: the tables (i, j) of the unresolved A buckets, if small
    left = written(unresolved(in_a, labels, f"{path}/mixed"), f"{path}/left")
    large = left.groupBy("bucket").count().where(F.col("count") > LARGE_BUCKET)
    large = if_small(written(large.select("bucket"), f"{path}/large"))
    small = written(left.join(large, "bucket", "left_anti").select("bucket", "node", "order"), f"{path}/small")
    tables = profile.join(if_small(small), "node") \
        .select("node", "order", "n", F.lit(0).alias("pos"), "bucket", F.explode("b").alias("b_key")) \
        .withColumn("bucket", F.xxhash64("bucket", "b_key")).drop("b_key")
    tables = shared_buckets(tables, f"{path}/table-keys").drop("size")
    # large ones: the prefix keys of their nodes
    crowd = written(left.join(large, "bucket", "left_semi").select("node", "order").distinct(), f"{path}/crowd")
    if not crowd.isEmpty():
        store.add(crowd.select("node"))
        keys = written(prefix_keys(store.sets().join(if_small(crowd), "node"), percent), f"{path}/prefixes")
        tables = tables.unionByName(shared_buckets(keys, f"{path}/prefix-keys").drop("size"))
    tables = written(tables, f"{path}/tables")
    labels, _ = link_buckets(spark, tables, lambda p: store.confirmed(p, percent), f"{path}/rounds", links, labels,
                             meets=reachable(percent))

    # only linked nodes change their name
    linked = nodes.select("node", "f1", "f2", "first_id").join(if_small(labels), "node")
    linked = written(linked, f"{path}/linked")
    least = written(linked.groupBy("label").agg(F.min("first_id").alias("component_id")), f"{path}/least")
    named = linked.join(if_small(least), "label").select("f1", "f2", F.col("component_id").alias("c"), "label")
    named = nodes.select("f1", "f2", "first_id", "node") \
        .join(if_small(written(named, f"{path}/named")), ["f1", "f2"], "left") \
        .select("f1", "f2", F.coalesce("c", "first_id").alias("component_id"),
                F.coalesce("label", "node").alias("component"))
    out = signed.select("doc_id", "text_key", "n_shingles", "f1", "f2").join(named, ["f1", "f2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.withColumn("component_id", component).select(
        "doc_id", "text_key", "n_shingles", "component_id", "component")


def near_duplicates(docs: DataFrame, percent: int = MIN_PERCENT, groups: int = GROUPS,
                    rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, n_shingles,
    component_id`` (smallest doc_id reachable over links) and ``kept``."""
    return linked_rows(docs, percent, groups, rows).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without near duplicates: of each group one row stays, that of
    the smallest id (rows without id last), then of the smallest text hash; of
    equal rows one.  Texts without words all stay.  Columns as they came."""
    path = shared_dir(docs.sparkSession, "near-dup-kept")
    found = linked_rows(docs, **options).where("n_shingles > 0")
    found = written(found.groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("times")), f"{path}/found")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("w"))
    first = written(first.select("component", "w.doc_id", "w.text_key"), f"{path}/first")
    # groups of one row are as they should be: only the others are looked up
    mine = first.select("component", F.col("doc_id").alias("w_id"), F.col("text_key").alias("w_key"))
    judged = found.join(mine, "component").select(
        "doc_id", "text_key", "times", (F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_key") == F.col("w_key"))).alias("stays"))
    judged = written(judged.where("NOT stays OR times > 1").select(
        F.col("doc_id").alias("j_id"), F.col("text_key").alias("j_key"), "stays"), f"{path}/judged")
    # the row travels whole, so its columns may have any names
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("k_id"), F.xxhash64("text").alias("k_key"))
    out = rows.join(if_small(judged), F.col("k_id").eqNullSafe(F.col("j_id")) & (F.col("k_key") == F.col("j_key")), "left")
    kept = out.where("stays IS NULL").select("row.*")
    once = out.where("stays").groupBy("k_id", "k_key").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return kept.unionByName(once.select("row.*"))
