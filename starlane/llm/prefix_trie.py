"""Conversation prefix trie, from sorted sequences and their common prefixes.

Every conversation is a sequence of turns; a node of the trie is a distinct
sequence of first turns, its members are the conversations that begin with it.
In sorted order the members of a node are an interval, and the longest common
prefixes (LCP) of neighbours say where it ends: a prefix of depth d at place i
extends to the left and to the right as far as no LCP is below d.

The conversations are range-partitioned and sorted by their turns' digests (and
conv_id, so any number of equal ones spreads over partitions).  Each partition
is a block: it holds a sparse table of range minima over its LCPs, and every
candidate prefix (a conversation whole, and each neighbours' common prefix)
finds both ends of its interval by binary search over the table, independently
of all others.  What a node needs then are sums over its interval.

Prefixes that go on beyond a block's edge are few (no more than the edge's LCP
a block).  A second sparse table, over one LCP an edge and one minimum a block,
takes such a prefix from its block to the first one that has it, by the same
search; the blocks' shares of a node are added up under that block and depth.

A node's leaves are the places whose next neighbour does not contain them; its
saved tokens are the sums of the characters that neighbours share beyond the
node's parent.  So no node looks at its subtree.

Choices and edge cases: turns are ordered by turn (null first), then role and
digest, so ties have a fixed order and repeated rows stay; null role and text
are empty; rows without conv_id belong to no conversation; a conversation
without rebuilt turns is a member of the root alone; an empty table gives an
empty result; other columns are not read.  Texts are not moved: a turn travels
as a 128-bit digest and a length, and the digests of one conversation (32 bytes
a turn) are one value.  Of a node's ends, the conversations equal to it, the
digest is over all ids in order, so one task reads them as a stream, in slices.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import one_by_one, shared_dir, written
from starlane.llm.components import if_small

GROUP = 100         # conversations that share a base
SHARED_TURNS = 6    # a conversation takes fewer first turns than this from its base
ENDS_SLICE = 256    # ids in one row of a node's ends
DIGEST = 32         # hex digits of a turn's digest

NODE = ("block long, depth long, at_left boolean, at_right boolean, n long, conv_id long, children long, "
        "left_child boolean, leaves long, shared long, before long, parent_id long, parent_left boolean, "
        "parent_right boolean, ends_sha256 string, ends array<string>, "
        "first_key string, last_key string, first_chars array<int>, last_depth long, least long")


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns: array of digest and chars), one row a conversation."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn"), role.alias("role"), digest.alias("digest"), F.length(text).alias("chars")).alias("t"))
    # null turns sort first in an array of structs
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"], t["chars"])).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, key, chars): each conversation with the first h turns of its
    base in place of its own; ``key`` joins the digests."""
    own = sequences(turns)
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS).cast("int")
    heads = own.where(base == F.col("conv_id")).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED_TURNS - 1).alias("head"))
    both = own.withColumns({"base": base, "h": h}).join(heads, "base", "left")
    none = F.array().cast("array<struct<digest:string,chars:int>>")
    tail = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(none)
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), 1, F.greatest("h", F.lit(1)))).otherwise(none)
    whole = both.select("conv_id", F.concat(head, tail).alias("t"))
    return whole.select("conv_id", F.array_join(F.transform("t", lambda t: t["digest"]), "").alias("key"),
                        F.transform("t", lambda t: t["chars"]).alias("chars"))


# ---- sparse tables of range minima --------------------------------------------

def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minimum of each run of 2**k values."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    return levels


def extents(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) places of each query: how far from ``at`` no value between
    neighbours is below ``depth``.  Value i stands between places i - 1 and i,
    and value 0 is not used."""
    n = len(table[0])
    left, right = at.copy(), at.copy()
    for k in range(len(table) - 1, -1, -1):
        step, level = 1 << k, table[k]
        to = left - step        # the run of values left - step + 1 .. left
        ok = to >= 0
        ok[ok] = level[to[ok] + 1] >= depth[ok]
        left[ok] = to[ok]
        to = right + step       # the run right + 1 .. right + step
        ok = to < n
        ok[ok] = level[right[ok] + 1] >= depth[ok]
        right[ok] = to[ok]
    return left, right


def range_least(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minimum over left..right inclusive."""
    k = np.frexp(right - left + 1)[1] - 1
    out = np.empty(len(left), dtype=table[0].dtype)
    for level in np.unique(k):
        of = k == level
        out[of] = np.minimum(table[level][left[of]], table[level][right[of] + 1 - (1 << int(level))])
    return out


# ---- one block ----------------------------------------------------------------

def _common(digests: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """LCP of each sequence with the one before (0 for the first)."""
    n = len(size)
    both = np.concatenate([[0], np.minimum(size[1:], size[:-1])])
    seq = np.repeat(np.arange(n), both)
    pos = np.arange(len(seq)) - np.repeat(np.cumsum(both) - both, both)
    differs = (digests[start[seq] + pos] != digests[start[seq - 1] + pos]).any(axis=1)
    lcp = both.copy()
    bad, first = np.unique(seq[differs], return_index=True)
    lcp[bad] = pos[differs][first]
    return lcp


def _block_nodes(block: int, conv: np.ndarray, keys, chars, schema):
    """Arrow batch of the block's nodes and one row (depth -1) on its edges."""
    import pyarrow as pa

    n = len(conv)
    size = np.diff(chars.offsets.to_numpy()).astype(np.int64)
    start = np.cumsum(size) - size
    joined = "".join(keys).encode()
    text = np.frombuffer(joined, dtype=np.uint64) if joined else np.empty(0, dtype=np.uint64)
    text = text.reshape(-1, DIGEST // 8)
    lens = chars.flatten().to_numpy().astype(np.int64)
    total = np.concatenate([[0], np.cumsum(lens)])      # chars before each turn, over the block
    prefix = lambda i, d: total[start[i] + d] - total[start[i]]  # noqa: E731  chars of the first d turns
    lcp = _common(text, start, size)
    minima = sparse_table(lcp)

    # candidates: every whole sequence, and what neighbours share
    places = np.arange(n)
    at = np.concatenate([places, places[1:]])
    depth = np.concatenate([size, lcp[1:]])
    left, right = extents(minima, at, depth)
    wide = int(size.max(initial=0)) + 2
    _, once = np.unique(left * wide + depth, return_index=True)
    left, right, depth = left[once], right[once], depth[once]
    # an interval stands for all depths down to the next larger one's
    edge = lcp.copy()
    edge[0] = -1
    edge = np.append(edge, -1)
    above = np.maximum(edge[left], edge[right + 1])
    up_left, up_right = extents(minima, left, np.maximum(above, 0))
    own = np.searchsorted(left * wide + depth, up_left * wide + above)
    children = np.bincount(own[above >= 0], minlength=len(left))

    k = np.repeat(np.arange(len(left)), depth - above)
    d = above[k] + 1 + np.arange(len(k)) - np.repeat(np.cumsum(depth - above) - (depth - above), depth - above)
    l, r = left[k], right[k]  # noqa: E741
    own_depth = d == depth[k]
    top = d == above[k] + 1         # its parent is the larger interval
    pl, pr = np.where(top, up_left[k], l), np.where(top, up_right[k], r)
    ids = sparse_table(conv)
    has_parent = d > 0
    least = range_least(ids, l, r)
    parent = range_least(ids, np.where(has_parent, pl, l), np.where(has_parent, pr, r))
    # leaves: places whose next neighbour does not contain them; the last place is not known here
    leaf = np.concatenate([[0], np.cumsum(np.append(lcp[1:] < size[:-1], False))])
    shared = np.concatenate([[0], np.cumsum(np.concatenate([[0], prefix(places[1:], lcp[1:])]))])
    before = np.where(has_parent, prefix(l, np.maximum(d - 1, 0)), 0)
    at_left, at_right = l == 0, r == n - 1
    # conversations that end here: the first of the interval, up to the next longer one
    equal = np.concatenate([[False], (lcp[1:] == size[1:]) & (size[1:] == size[:-1])])
    runs = np.flatnonzero(~equal)
    run_end = np.append(runs[1:], n)
    ends_at = np.flatnonzero(size[l] == d)
    digests = np.full(len(l), None, dtype=object)
    lists = np.full(len(l), None, dtype=object)
    digests[:] = hashlib.sha256(b"").hexdigest()
    stop = run_end[np.searchsorted(runs, l[ends_at], side="right") - 1]
    for x, lo, hi in zip(ends_at, l[ends_at], stop):
        if at_left[x] or at_right[x]:
            lists[x] = [",".join(map(str, conv[i:min(i + ENDS_SLICE, hi)])) for i in range(lo, hi, ENDS_SLICE)]
        else:
            digests[x] = hashlib.sha256(",".join(map(str, conv[lo:hi])).encode()).hexdigest()
    lists = lists.tolist()
    m = len(l)

    def column(values, none_first=None):
        """The nodes' values with the edge row's before them."""
        return pa.concat_arrays([pa.array([none_first], type=values.type), values])

    edge_row = {"block": block, "depth": -1, "first_key": keys[0], "last_key": keys[-1],
                "first_chars": chars[0].as_py(), "last_depth": int(size[-1]),
                "least": int(lcp[1:].min(initial=2**40)), "n": n}
    nodes = {
        "block": np.full(m, block), "depth": d, "at_left": at_left, "at_right": at_right, "n": r - l + 1,
        "conv_id": least, "children": np.where(own_depth, children[k], 1), "left_child": at_left & (size[0] > d),
        "leaves": leaf[r + 1] - leaf[l], "shared": shared[r + 1] - shared[l + 1], "before": before, "parent_id": parent,
        "parent_left": pl == 0, "parent_right": pr == n - 1}
    arrays, names = [], []
    for f in schema:
        if f.name in nodes:
            values = pa.array(nodes[f.name]).cast(f.type)
        elif f.name == "ends_sha256":
            values = pa.array(digests.tolist(), type=f.type)
        elif f.name == "ends":
            values = pa.array(lists, type=f.type)
        else:
            values = pa.nulls(m, f.type)
        arrays.append(column(values, edge_row.get(f.name)))
        names.append(f.name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def block_nodes(ordered: DataFrame) -> DataFrame:
    """The nodes of every partition of the sorted (conv_id, key, chars)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(NODE))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        held = list(one_by_one(batches))    # one range partition: as large as a shuffle partition
        if not held:
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        conv = whole.column(0).to_numpy().astype(np.int64)
        chars = whole.column(2).combine_chunks()
        chars = chars.chunk(0) if isinstance(chars, pa.ChunkedArray) else chars
        batch = _block_nodes(TaskContext.get().partitionId(), conv, whole.column(1).to_pylist(), chars, schema)
        for i in range(0, batch.num_rows, 50_000):
            yield batch.slice(i, 50_000)

    return ordered.mapInArrow(run, NODE)


# ---- across blocks --------------------------------------------------------------

def _edges(edge_rows: DataFrame):
    """Per block in order, as arrays: number, LCP with the block before, the
    chars of that prefix, the last sequence's length, the least LCP inside."""
    blocks = sorted(r["block"] for r in edge_rows.select("block").collect())    # one number a partition
    spark = edge_rows.sparkSession
    after = spark.createDataFrame(list(zip(blocks[1:], blocks[:-1])), "block long, prior long")
    prior = edge_rows.select(F.col("block").alias("prior"), F.col("last_key").alias("prior_key"))
    met = edge_rows.join(F.broadcast(after), "block", "left").join(prior, "prior", "left")

    def run(batches):
        import pyarrow as pa

        for b in one_by_one(batches):
            out = []
            for block, key, chars, prior_key, last, least in zip(*[c.to_pylist() for c in b.columns]):
                common = -1
                if prior_key is not None:
                    if prior_key > key:
                        raise RuntimeError("the range partitions are out of order")
                    x, y = (np.frombuffer(k.encode(), dtype=f"S{DIGEST}") for k in (prior_key, key))
                    size = min(len(x), len(y))
                    common = int(np.append(x[:size] == y[:size], False).argmin())
                out.append((block, common, sum(chars[:max(common, 0)]), last, least))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*out)],
                                             names=["block", "common", "chars", "last", "least"])

    rows = met.select("block", "first_key", "first_chars", "prior_key", "last_depth", "least").mapInArrow(
        run, "block long, common long, chars long, last long, least long").collect()    # numbers, one row a partition
    return np.array(sorted(map(tuple, rows)), dtype=np.int64).reshape(-1, 5)


def _placed(nodes: DataFrame, edges: np.ndarray) -> DataFrame:
    """Nodes with ``crosses`` and, for those that reach beyond their block and
    for parents that do, the first block that has them (``home``,
    ``parent_home``); sums corrected by what only the edges know."""
    shared = nodes.sparkSession.sparkContext.broadcast(edges)    # five numbers a partition

    def run(batches):
        import pyarrow as pa

        e = shared.value
        number, common, chars, last, least = e.T
        next_common = np.append(common[1:], -1)
        # places 2i and 2i + 1 are the two ends of block i; the values between are LCPs
        line = np.empty(2 * len(e), dtype=np.int64)
        line[0::2], line[1::2] = common, least
        table = sparse_table(line)

        def home(i, depth):
            left, _ = extents(table, 2 * i, depth)
            return number[left // 2]

        for b in one_by_one(batches):
            got = {f: b.column(f).to_numpy(zero_copy_only=False) for f in
                   ("block", "depth", "at_left", "at_right", "n", "children", "left_child", "leaves", "shared",
                    "before", "parent_left", "parent_right")}
            i = np.searchsorted(number, got["block"])
            d = got["depth"]
            on_left, on_right = got["at_left"] & (common[i] >= d), got["at_right"] & (next_common[i] >= d)
            up_left, up_right = got["parent_left"] & (common[i] >= d - 1), got["parent_right"] & (next_common[i] >= d - 1)
            crosses, up_crosses = on_left | on_right, (up_left | up_right) & (d > 0)
            fixed = {
                "leaves": got["leaves"] + (got["at_right"] & (next_common[i] < last[i])),
                "shared": got["shared"] + np.where(on_left, chars[i], 0),
                "children": got["children"] - (got["left_child"] & (common[i] >= d + 1)),
                "home": np.where(on_left, home(i, d), got["block"]),
                "parent_home": np.where(up_crosses, np.where(up_left, home(i, np.maximum(d - 1, 0)), got["block"]), -1)}
            arrays = [pa.array(fixed[f].astype(np.int64)) if f in fixed else b.column(f) for f in
                      ("depth", "block", "n", "conv_id", "children", "leaves", "shared", "before", "parent_id",
                       "ends_sha256", "ends", "home", "parent_home")]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(crosses)], names=[
                "depth", "block", "n", "conv_id", "children", "leaves", "shared", "before", "parent_id",
                "ends_sha256", "ends", "home", "parent_home", "crosses"])

    return nodes.mapInArrow(run, "depth long, block long, n long, conv_id long, children long, leaves long, shared long, "
                            "before long, parent_id long, ends_sha256 string, ends array<string>, home long, "
                            "parent_home long, crosses boolean")


def _ends(pieces: DataFrame) -> DataFrame:
    """(home, depth, digest) of the ends of nodes, read as a stream: one slice
    of ids at a time, in order of block and slice."""

    def run(batches):
        import pyarrow as pa

        at, state = None, None
        done = []

        def close():
            if at is not None:
                done.append((*at, state.hexdigest()))

        for b in one_by_one(batches):
            for home, depth, piece in zip(*[b.column(c).to_pylist() for c in ("home", "depth", "piece")]):
                if (home, depth) != at:
                    close()
                    at, state = (home, depth), hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            if done:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done))), names=["home", "depth", "digest"])
                done.clear()
        close()
        if done:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done))), names=["home", "depth", "digest"])

    in_order = pieces.repartition("home", "depth").sortWithinPartitions("home", "depth", "block", "no")
    return in_order.mapInArrow(run, "home long, depth long, digest string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row a node of the trie of ``turns`` (conv_id, turn, role, text) with
    bases: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens`` and ``ends_sha256``."""
    path = shared_dir(turns.sparkSession, "prefix-trie")
    whole = written(rebuilt(turns), f"{path}/sequences")     # sampled for the ranges, then read
    ordered = whole.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = written(block_nodes(ordered), f"{path}/blocks")
    edges = _edges(found.where("depth = -1"))
    nodes = written(_placed(found.where("depth >= 0").drop("first_key", "last_key", "first_chars", "last_depth", "least"),
                            edges), f"{path}/nodes")

    # nodes that several blocks share
    parts = nodes.where("crosses")
    pieces = parts.where("ends IS NOT NULL").select("home", "depth", "block", F.posexplode("ends").alias("no", "piece"))
    across = parts.groupBy("home", "depth").agg(
        F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.sum("children").alias("children"),
        F.sum("leaves").alias("leaves"), F.sum("shared").alias("shared"), F.max("before").alias("before"),
        F.min("parent_id").alias("parent_id"), F.max("parent_home").alias("parent_home"),
        F.min(F.when(F.col("ends").isNotNull(), F.lit(None)).otherwise(F.col("ends_sha256"))).alias("ends_sha256"))
    across = across.join(_ends(pieces), ["home", "depth"], "left") \
        .withColumn("ends_sha256", F.coalesce("digest", "ends_sha256"))
    across = written(across, f"{path}/across")
    # a block's own nodes at its edge have their ends listed too
    alone = nodes.where("NOT crosses").withColumn("ends_sha256", F.when(
        F.col("ends").isNotNull(), F.sha2(F.array_join("ends", ","), 256)).otherwise(F.col("ends_sha256")))
    names = across.select(F.col("home").alias("parent_home"), (F.col("depth") + 1).alias("depth"),
                          F.col("conv_id").alias("known_parent"))
    columns = ["depth", "n", "conv_id", "children", "leaves", "shared", "before", "parent_id", "parent_home", "ends_sha256"]
    every = alone.select(*columns).unionByName(across.select(*columns))
    # the few shared nodes name the parents of nodes in every block: a broadcast of counted rows
    named = every.join(if_small(written(names, f"{path}/parents")), ["parent_home", "depth"], "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("known_parent", "parent_id"))
    return named.select("conv_id", "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"),
                        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                        (F.col("shared") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"), "ends_sha256")


ORACLE = f"""
WITH bits AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl
), convs AS (
  SELECT conv_id, conv_id - conv_id % {GROUP} AS base, xor(list_reduce(
           list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295) % {SHARED_TURNS} AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), bits
), t AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), digest) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), r AS (
  SELECT c.conv_id, t.pos, t.digest, t.chars FROM convs c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos, t.digest, t.chars FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h
), path AS (
  SELECT conv_id, row_number() OVER w AS depth, chars, string_agg(digest, '') OVER w AS key FROM r
  WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), node AS (
  SELECT key, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars
  FROM path GROUP BY key
), kids AS (
  SELECT left(key, length(key) - {DIGEST}) AS key, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT p.key, sum((n.n - 1) * n.chars) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
  FROM node n JOIN path p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids k ON k.key = n.key
  GROUP BY p.key
), ends AS (
  SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max_by(key, depth) AS key FROM path GROUP BY conv_id) GROUP BY key
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs,
       coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM node n JOIN below b ON b.key = n.key LEFT JOIN kids k ON k.key = n.key LEFT JOIN ends e ON e.key = n.key
LEFT JOIN node p ON n.depth > 0 AND p.key = left(n.key, length(n.key) - {DIGEST})
"""
