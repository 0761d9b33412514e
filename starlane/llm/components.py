"""Connected components and links inside hot buckets, as DataFrame jobs.

Nodes are longs.  Nothing is gathered: every step is a join or an aggregate
with a partial step, and each result is written to the shared folder, so a
lost executor costs one step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlane.llm.common import written

# Rows of a few longs that are broadcast at most: under 100 MB.
BROADCAST_ROWS = 500_000
# Links that one task works on: small link sets need no shuffle.
LINKS_PER_TASK = 200_000


def if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a written table when its row count is within ``limit``.

    Larger ones are left to a shuffle join."""
    return F.broadcast(df) if df.count() <= limit else df


def _is_flat(edges: DataFrame) -> bool:
    """Every node points at one root and no root points anywhere."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in")) \
        .union(edges.select("v", F.lit(0), F.lit(1)))
    wrong = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return wrong.where("out > 1 OR (out > 0 AND in > 0)").isEmpty()


def components(links: DataFrame, path: str) -> DataFrame:
    """(node, label) of every linked node; the label is the smallest node.

    Alternates large-star and small-star steps (each node's neighbours are
    re-linked to its smallest neighbour) until every component is a star."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"),
                    f"{path}/edges-0")
    step = 0
    while True:
        small_set = edges.count() <= LINKS_PER_TASK
        if small_set:
            edges = edges.coalesce(1)
        if step == 0:
            edges = edges.distinct()
        if _is_flat(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")) \
                .union(edges.select("v", "v").distinct())
        step += 1
        # large star: larger neighbours of u move to the smallest of u and its neighbours
        both = edges.union(edges.select("v", "u"))
        if small_set:
            both = both.coalesce(1)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: u and its smaller neighbours move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least)
        edges = written(small.distinct(), f"{path}/edges-{step}")


def shared_buckets(members: DataFrame, path: str) -> DataFrame:
    """Rows of ``members`` (bucket, node, ...) whose bucket holds two nodes or
    more, with the bucket's ``size``."""
    several = members.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi"),
                                            F.count(F.lit(1)).alias("size")).where("lo <> hi")
    return members.join(if_small(written(several.select("bucket", "size"), path)), "bucket")


def by_centrality(shared: DataFrame, path: str) -> DataFrame:
    """(node, order): nodes in large buckets come first (a small order).

    The text that a group was copied from shares most buckets with the
    copies, so as a hub it links them all at once, while two copies may be
    too far apart."""
    return written(shared.groupBy("node").agg((-F.sum("size")).alias("order")), path)


def unresolved(members: DataFrame, labels: DataFrame | None, path: str) -> DataFrame:
    """``members`` (bucket, node, ...) of the buckets whose nodes are not all
    linked yet, with their ``label``; a node without link is its own."""
    if labels is None:
        marked = members.withColumn("label", F.col("node"))
    else:
        marked = members.join(if_small(labels), "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = marked.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    mixed = written(mixed.select("bucket"), path)
    return marked.join(if_small(mixed), "bucket", "left_semi").select(*members.columns, "label")


def hub_pairs(members: DataFrame, hubs: int, path: str, meets: str = "true") -> tuple[DataFrame, DataFrame]:
    """(hubs, pairs): the first ``hubs`` nodes of each bucket by ``order``, and
    the pairs (a < b) of a hub with the bucket's nodes of other components.

    ``meets`` is SQL over a node ``m`` and a hub ``h``: what a link of this
    bucket must satisfy."""
    rest = [c for c in members.columns if c not in ("bucket", "order", "node")]
    if hubs == 1:
        first = members.groupBy("bucket").agg(F.min(F.struct("order", "node", *rest)).alias("h")) \
            .select("bucket", "h.node", *[f"h.{c}" for c in rest])
    else:  # a group limit runs before the shuffle: only ``hubs`` rows per task and bucket move
        order = Window.partitionBy("bucket").orderBy("order", "node")
        first = members.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= hubs) \
            .select("bucket", "node", *rest)
    first = written(first, path)
    few = if_small(first, 4 * BROADCAST_ROWS // max(4, len(first.columns)))
    pairs = members.alias("m").join(few.alias("h"), (F.col("m.bucket") == F.col("h.bucket"))
                                    & (F.col("m.label") != F.col("h.label")) & F.expr(meets)) \
        .select(F.least("m.node", "h.node").alias("a"), F.greatest("m.node", "h.node").alias("b")).distinct()
    return first, pairs


def alike_pairs(members: DataFrame, meets: str) -> DataFrame:
    """All pairs (a < b) of nodes of other components that share a bucket and
    meet: for small buckets."""
    return members.alias("m").join(members.alias("h"), (F.col("m.bucket") == F.col("h.bucket"))
                                   & (F.col("m.node") < F.col("h.node")) & (F.col("m.label") != F.col("h.label"))
                                   & F.expr(meets)) \
        .select(F.col("m.node").alias("a"), F.col("h.node").alias("b")).distinct()


def link_buckets(spark: SparkSession, members: DataFrame, verify: Callable[[DataFrame], DataFrame],
                 path: str, known: DataFrame | None = None, labels: DataFrame | None = None,
                 meets: str = "true") -> tuple[DataFrame | None, DataFrame | None]:
    """(labels, links) after linking all nodes that share a bucket.

    ``members`` has (bucket, node, order); ``verify`` maps pairs (a, b) to those that are links; ``known`` links and
    their ``labels`` may be given.  Every pair of a bucket is either verified
    or already joined by verified links: each round compares a few hubs of
    every unresolved bucket with its other nodes, drops these hubs (all their
    pairs are done), merges the components and goes on with eight times as
    many hubs, until each bucket is of one component or used up.  Groups of
    true copies end after one or two rounds; a bucket whose nodes are not
    linked is compared in all its pairs, so callers with such buckets put an
    exact filter before it (``meets``)."""
    links, step, hubs = known, 0, 1 if known is None else 8
    while True:
        members = written(unresolved(members.drop("label"), labels, f"{path}/mixed-{step}"),
                          f"{path}/members-{step}")
        if members.isEmpty():
            return labels, links
        first, pairs = hub_pairs(members, hubs, f"{path}/hubs-{step}", meets)
        found = written(verify(written(pairs, f"{path}/pairs-{step}")), f"{path}/links-{step}")
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            labels = written(components(links, f"{path}/components-{step}"), f"{path}/labels-{step}")
        members = members.join(if_small(first.select("bucket", "node")), ["bucket", "node"], "left_anti")
        step, hubs = step + 1, min(8 * hubs, 4096)
