"""Fuzzy line dedup by MinHash, in DataFrame expressions only.

Lines are cut at ``\\n`` and compared lower-cased, trimmed and with single
spaces (any Unicode white space counts as space).  A line's set holds its
character shingles: up to nine characters from every word start and, in runs
without spaces, from every character after the eighth, so each character is in
some shingle.  Equal lines are one node.
``BANDS`` bands of ``ROWS`` minhashes bring similar lines together (a pair of
similarity 0.8 is met with probability 1 - (1 - 0.8^ROWS)^BANDS, 0.998 here;
0.9 with 0.99995); every candidate link is verified by the exact Jaccard
similarity of the full sets; linked lines form components by distributed
union-find, and of each component only the first occurrence (smallest doc_id,
then position) stays.

Hot lines cost nothing extra: all aggregates have a partial step.  The most
central line of each bucket is compared with the others, then what is left of a
small bucket in all its pairs; in a large one lines meet again only where an
exact prefix filter lets them (see ``prefix_keys``), so lines of one shape that
are no copies are not compared in all their pairs.  Each line has a bitmap of
its set; pairs that these tell apart (see ``alike``, exact)
come to nothing inside the join, and only lines of the others have their sets
read.

Edge cases: blank lines are kept and never compared; null and empty texts have
no lines and come back as they are; a line shorter than a shingle is one
shingle; repeated rows (same id and text) get the same decisions; rows without
id are ordered first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import forget, shared_dir, written
from starlane.llm.components import (alike_pairs, by_centrality, components, hub_pairs, if_small, link_buckets,
                                     shared_buckets, unresolved)
from starlane.llm.near_dup import reachable
from starlane.session import child_names

SHINGLE_CHARS = 9
BANDS = 6
ROWS = 2
MIN_PERCENT = 80
ODD_SPACE = r"(?U)[\s&&[^ ]]|  "    # any Unicode white space but a single space
HUB_SHINGLES = 5_000_000             # hub sets that are broadcast hold so many longs at most (40 MB)
WORDS = 4                            # a line's bitmap: so many longs (a power of two)
LARGE_BUCKET = 256                   # what is left of larger buckets goes by prefix keys
BROADCAST_LONGS = 1_000_000          # rows of one long that are broadcast at most


def _shingle_pattern(chars: int) -> str:
    """Looks ahead at a shingle, then steps to the next anchor: a word start
    steps over ``chars - 1`` characters, each later one over itself."""
    return rf"(?=([^ ].{{0,{chars - 1}}}))(?:(?<![^ ])[^ ]{{1,{chars - 1}}}|[^ ]) *"


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def _lines(rows: DataFrame) -> DataFrame:
    """(doc_id, text_key, pos, norm, h1, h2) of every line that has a word."""
    cut = rows.select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    odd = F.col("line").rlike(ODD_SPACE)
    norm = F.trim(F.lower(F.when(odd, F.regexp_replace("line", r"(?U)\s+", " ")).otherwise(F.col("line"))))
    return cut.select("doc_id", "text_key", "pos", norm.alias("norm")).where("norm <> ''") \
        .withColumns({"h1": F.xxhash64("norm"), "h2": F.xxhash64(F.lit(7), "norm")})


def _shingles(chars: int):
    return F.regexp_extract_all("norm", F.lit(_shingle_pattern(chars)), 1)


def prefix_keys(members: DataFrame, hubs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, order, n, pos): finer buckets for ``members`` (bucket,
    node, order), whose buckets have the ``hubs`` (bucket, node); ``n`` is the
    size of the set.

    Within a bucket all sets are put in one order: shingles that the hub lacks
    come first, then those it has.  Two sets of similarity ``percent`` share
    one of the first ``n - ceil(percent * n) + 1`` of each, in any one order,
    so the filter is exact; lines that have only the hub's text in common
    begin with what is their own and do not meet."""
    kept = hubs.join(if_small(members.select("bucket").distinct()), "bucket", "left_semi")
    of_hub = sets.join(if_small(kept), "node").select("bucket", "n", F.col("s").alias("hub_s"))
    weight = kept.join(sets.select("node", "n"), "node").agg(F.sum("n")).first()[0] or 0
    of_hub = of_hub.drop("n")
    held = sets.join(if_small(members), "node")
    both = held.join(F.broadcast(of_hub) if weight <= HUB_SHINGLES else of_hub, "bucket")
    in_order = F.concat(F.array_sort(F.array_except("s", "hub_s")), F.array_sort(F.array_intersect("s", "hub_s")))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    keys = both.select("bucket", "node", "order", "n", F.slice(in_order, F.lit(1), length.cast("int")).alias("prefix"))
    return keys.select("bucket", "node", "order", "n", F.posexplode("prefix").alias("pos", "x")) \
        .select(F.xxhash64("bucket", "x").alias("bucket"), "node", "order", "n", "pos")


def _bitmap(k: int):
    """Word ``k`` of a set's bitmap: one bit a shingle, by its hash ``x``."""
    return F.expr(f"bit_or(CASE WHEN (x >> 6) & {WORDS - 1} = {k} THEN shiftleft(1L, CAST(x & 63 AS INT)) ELSE 0L END)")


def alike(percent: int) -> str:
    """SQL over nodes ``m`` and ``h``: their bitmaps differ in no more bits than
    the sets of a link may differ in shingles.

    Each bit that differs is of a shingle that one of them lacks, and at a
    similarity t at most (1 - t) / (1 + t) of both sizes are such, so no link is
    lost (``n`` may be larger than a set, not smaller); texts of other content
    differ in many more."""
    bits = " + ".join(f"bit_count(m.z{k} ^ h.z{k})" for k in range(WORDS))
    return f"(100 + {percent}) * ({bits}) <= (100 - {percent}) * (m.n + h.n)"


class LineSets:
    """Shingle sets of the lines that candidates need, each read once."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, firsts: DataFrame, chars: int, path: str):
        self.texts, self.nodes, self.firsts, self.chars, self.path, self.parts = texts, nodes, firsts, chars, path, []

    def sets(self) -> DataFrame:
        out = self.parts[0]
        for p in self.parts[1:]:
            out = out.unionByName(p)
        return out

    def add(self, needed: DataFrame) -> None:
        """Make sure that the sets of the distinct nodes ``needed`` are there,
        from one occurrence of each line."""
        if self.parts:
            needed = needed.join(self.sets().select("node"), "node", "left_anti")
        at = f"{self.path}/{len(self.parts)}"
        needed = written(needed, f"{at}/needed")
        if self.parts and needed.isEmpty():
            return
        wanted = written(self.nodes.select("node", "h1", "h2").join(if_small(needed), "node"), f"{at}/keys")
        wanted = written(self.firsts.join(if_small(wanted), ["h1", "h2"]).select("node", "h1", "h2", "first.*"),
                         f"{at}/wanted")
        # texts and lines that are not wanted stay where they are: one long a text and a line says which
        owners = written(wanted.select(F.xxhash64("doc_id", "text_key").alias("owner")).distinct(), f"{at}/owners")
        held = self.texts.withColumn("owner", F.xxhash64("doc_id", "text_key")) \
            .join(if_small(owners, BROADCAST_LONGS), "owner", "left_semi")
        lines = _lines(held)
        few = written(wanted.select("h1").distinct(), f"{at}/few")
        if few.count() <= BROADCAST_LONGS:
            lines = lines.join(F.broadcast(few), "h1", "left_semi")
        found = lines.alias("l").join(
            if_small(wanted).alias("w"), (F.col("l.h1") == F.col("w.h1")) & (F.col("l.h2") == F.col("w.h2"))
            & (F.col("l.pos") == F.col("w.pos")) & F.col("l.doc_id").eqNullSafe(F.col("w.doc_id"))
            & F.col("l.text_key").eqNullSafe(F.col("w.text_key")))
        sets = found.select("w.node", F.array_distinct(F.transform(
            _shingles(self.chars), lambda s: F.xxhash64(s))).alias("s"))
        sets = written(sets.select("node", F.size("s").cast("bigint").alias("n"), "s"), f"{at}/sets")
        if sets.count() > wanted.count():  # repeated rows hold a line's first occurrence more than once
            sets = written(sets.dropDuplicates(["node"]), f"{at}/single-sets")
        self.parts.append(sets)

    def confirmed(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The pairs (a, b) with 100 * intersection >= percent * union."""
        self.add(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        # only the sets of this round's pairs are shuffled
        alone = self.sets().select("node", "s")
        others = alone.toDF("b", "set_b").join(if_small(pairs.select("b")), "b", "left_semi")
        both = alone.toDF("a", "set_a").join(if_small(pairs), "a").join(others, "b")
        sizes = [F.size("set_a"), F.size("set_b")]
        common = F.size(F.array_intersect("set_a", "set_b"))
        return both.where(100 * common >= percent * (sizes[0] + sizes[1] - common)).select("a", "b")


def removed_lines(docs: DataFrame, percent: int = MIN_PERCENT, chars: int = SHINGLE_CHARS,
                  bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, text_key, pos) of every line that another one stands for."""
    spark = docs.sparkSession
    path = shared_dir(spark, "line-dedup")
    texts = _rows(docs)
    seen = written(_lines(texts).drop("norm"), f"{path}/lines")

    # signatures; a line's shingles are all in one task, so the partial step does the work
    cut = _lines(texts).select("h1", "h2", _shingles(chars).alias("all"))
    sized = cut.select("h1", "h2", F.size("all").cast("bigint").alias("n"), "all")  # repeats count: no less than the set
    shingle = sized.select("h1", "h2", "n", F.explode("all").alias("s")).select("h1", "h2", "n", F.xxhash64("s").alias("x"))
    words = [f"z{k}" for k in range(WORDS)]
    signature = shingle.groupBy("h1", "h2").agg(
        F.max("n").alias("n"), *[_bitmap(k).alias(f"z{k}") for k in range(WORDS)],
        *[F.min(F.hash(F.lit(k), "x")).alias(f"m{k}") for k in range(bands * rows)])
    keys = [F.xxhash64(F.lit(b), *[f"m{b * rows + r}" for r in range(rows)]) for b in range(bands)]
    nodes = written(signature.select("h1", "h2", "n", *words, F.array(*keys).alias("bands"))
                    .withColumn("node", F.monotonically_increasing_id()), f"{path}/nodes")
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    members = written(shared_buckets(members, f"{path}/shared"), f"{path}/met-members")
    met = by_centrality(members, f"{path}/met")
    profile = written(nodes.select("node", "n", *words).join(if_small(met, 200_000), "node"), f"{path}/profile")
    members = members.select("bucket", "node").join(if_small(profile, 200_000), "node")
    members = written(members, f"{path}/members")
    forget(spark, f"{path}/met-members", f"{path}/met", f"{path}/shared")
    firsts = seen.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "text_key", "pos")).alias("first"),
                                          F.count(F.lit(1)).alias("times"))
    firsts = written(firsts, f"{path}/firsts")
    store = LineSets(texts, nodes, firsts, chars, f"{path}/of")

    def verify(pairs: DataFrame) -> DataFrame:
        return store.confirmed(pairs, percent)

    # one hub a bucket; what bitmaps tell apart is no pair, and its sets are not read
    meets = alike(percent)
    hubs, pairs = hub_pairs(members.withColumn("label", F.col("node")), 1, f"{path}/hubs", meets)
    links = written(verify(written(pairs, f"{path}/pairs")), f"{path}/links")
    labels = None if links.isEmpty() else written(components(links, f"{path}/components"), f"{path}/labels")
    hubs = hubs.select("bucket", "node")
    left = members.join(if_small(hubs), ["bucket", "node"], "left_anti")
    left = written(unresolved(left, labels, f"{path}/mixed"), f"{path}/left")
    forget(spark, f"{path}/members")

    # what is left of a small bucket: all its pairs; of a large one: the prefix filter
    large = left.groupBy("bucket").count().where(F.col("count") > LARGE_BUCKET).select("bucket")
    large = if_small(written(large, f"{path}/large"))
    pairs = written(alike_pairs(left.join(large, "bucket", "left_anti"), meets), f"{path}/left-pairs")
    found = written(verify(pairs), f"{path}/left-links")
    if not found.isEmpty():
        links = links.union(found)
        labels = written(components(links, f"{path}/left-components"), f"{path}/left-labels")
    crowd = left.join(large, "bucket", "left_semi").drop("label")
    crowd = written(unresolved(crowd, labels, f"{path}/crowd-mixed"), f"{path}/crowd")
    if not crowd.isEmpty():
        hubs = hubs.join(if_small(written(crowd.select("bucket").distinct(), f"{path}/crowd-buckets")), "bucket", "left_semi")
        hubs = written(hubs, f"{path}/crowd-hubs")
        store.add(crowd.select("node").union(hubs.select("node")).distinct())
        keys = crowd.select("bucket", "node", "order")
        keys = written(prefix_keys(keys, hubs, store.sets(), percent), f"{path}/prefixes")
        keys = written(shared_buckets(keys, f"{path}/prefix-keys").drop("size"), f"{path}/prefixes-shared")
        keys = keys.join(if_small(profile.select("node", *words), 200_000), "node")
        keys = written(keys, f"{path}/finer")
        forget(spark, f"{path}/prefixes", f"{path}/prefix-keys", f"{path}/prefixes-shared")
        labels, _ = link_buckets(spark, keys, verify, f"{path}/rounds", links, labels, f"{reachable(percent)} AND {meets}")

    # first occurrence of each component; lines on their own only if they repeat
    own = firsts.select("h1", "h2", "first", "times")
    if labels is None:
        groups = own.where("times > 1").select("h1", "h2", F.col("first").alias("keeper"))
    else:
        linked = written(nodes.join(if_small(labels), "node").select("h1", "h2", "label"), f"{path}/linked")
        linked = own.join(if_small(linked), ["h1", "h2"], "left").where("times > 1 OR label IS NOT NULL")
        linked = written(linked, f"{path}/named")
        least = linked.where("label IS NOT NULL").groupBy("label").agg(F.min("first").alias("least"))
        least = written(least, f"{path}/least")
        groups = linked.join(if_small(least), "label", "left") \
            .select("h1", "h2", F.coalesce("least", "first").alias("keeper"))
    groups = written(groups, f"{path}/groups")
    # the rest is read by nobody from here on
    forget(spark, *[f"{path}/{n}" for n in child_names(spark, path) if n not in ("lines", "groups")])
    hit = seen.join(if_small(groups), ["h1", "h2"])
    same = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & F.col("text_key").eqNullSafe(F.col("keeper.text_key")) \
        & (F.col("pos") == F.col("keeper.pos"))
    # repeated rows have the same lines twice: one decision
    return hit.where(~same).select("doc_id", "text_key", "pos").distinct()


def line_decisions(docs: DataFrame, **options) -> DataFrame:
    """One row a row of ``docs``: ``doc_id, n_lines`` (with a word),
    ``n_removed`` and ``removed`` (positions from 0, ascending)."""
    gone = removed_lines(docs, **options).groupBy("doc_id", "text_key") \
        .agg(F.sort_array(F.collect_list("pos")).alias("removed"))  # at most the lines of one text
    lines = F.coalesce(F.size(F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"(?U)\S"))), F.lit(0))
    rows = _rows(docs).select("doc_id", "text_key",
                              F.when(F.col("text").isNull(), 0).otherwise(lines).cast("bigint").alias("n_lines"))
    g = gone.toDF("gone_id", "gone_key", "removed")
    out = rows.join(g, F.col("doc_id").eqNullSafe(F.col("gone_id"))
                    & F.col("text_key").eqNullSafe(F.col("gone_key")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", F.size(removed).cast("bigint").alias("n_removed"), removed.alias("removed"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the removed lines, columns as they came.

    A document all of whose lines are removed is dropped (its lines stand
    elsewhere); one that had no lines stays."""
    path = shared_dir(docs.sparkSession, "line-dedup-kept")
    gone = removed_lines(docs, **options).groupBy(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")) \
        .agg(F.collect_list("pos").alias("gone_pos"))
    gone = written(gone, f"{path}/gone")
    # the row travels whole, so its columns may have any names
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("k_id"), F.xxhash64("text").alias("k_key"))
    out = rows.join(if_small(gone, 200_000), F.col("k_id").eqNullSafe(F.col("gone_id"))
                    & (F.col("k_key") == F.col("gone_key")), "left")
    whole = F.col("row")["text"]
    lines = F.filter(F.split(whole, "\n", -1), lambda line, i: ~F.array_contains("gone_pos", i))
    text = F.when(F.col("gone_pos").isNull(), whole).otherwise(F.array_join(lines, "\n"))
    left = out.select("row", "gone_pos", text.alias("left_text"))
    left = left.where(F.col("gone_pos").isNull() | F.col("left_text").rlike(r"(?U)\S"))
    return left.select(*[F.col("left_text").alias("text") if c == "text" else F.col("row")[c].alias(c)
                         for c in docs.columns])
