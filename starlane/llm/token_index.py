"""Token ids as binary shards, with a minimal perfect hash index over keys.

Layout of an output folder (any store that ``pyarrow.fs`` opens by URI):

``shard-NNNNNN.ids``   records in ascending key order; a record is a count
                       (little-endian u32) and so many raw ids (u16 if the
                       vocabulary fits, else u32)
``index-NNNNNN.mph``   one bucket of the index: levels of a minimal perfect
                       hash over the bucket's keys and, by slot, fingerprint,
                       shard, offset, copies and start
``manifest``           Parquet: shard, documents, ids, ids before it

A key is looked up in constant time: its bucket from its hash, one bit probe
per level, the slot's fingerprint to reject unknown keys, then one read at
the offset.  Buckets hold a bounded number of keys, so building one takes
bounded memory however many documents there are.

Documents are range-partitioned by (key, text hash), so a repeated key is
split over tasks too; its index entry has its first record and how many there
are, and all of them are read back by shard from the entries.  Files are
written under an attempt's name and renamed, so retries and lost executors
leave whole files.

Edge cases: null and empty texts are the end id alone; rows without key stand
first and are reached by reading the shards only; an empty table gives no
shards and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.byte_tokens import worker_tokens
from starlane.llm.common import as_bytes, one_by_one, shared_dir, text_chunks, written
from starlane.llm.components import if_small
from starlane.llm.textscan import mix

END_ID = 2
KEYS_PER_BUCKET = 200_000
LEVELS = 48
_U = np.uint64


# -- minimal perfect hash ---------------------------------------------------

def _probe(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    seed = _U((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix(keys + seed) % _U(bits)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ _U(0x6C62272E07BB0142)) >> _U(32)).astype(np.uint32)


class PerfectHash:
    """Keys that collide on a level's bit array go on to the next level; a
    key's slot is the number of set bits before its own."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.before = []
        total = 0
        for bits in levels:
            counts = np.cumsum(bits)
            self.before.append(total + counts - bits)
            total += int(counts[-1]) if len(counts) else 0
        self.placed = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = 2 * len(left)
            at = _probe(left, level, size)
            times = np.bincount(at, minlength=size)
            levels.append(times == 1)
            left = left[times[at] > 1]
        return cls(levels, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; any slot (or -1) for keys that were not indexed."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = _probe(keys[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = self.before[level][at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                return out
        if len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            known = self.rest[at] == keys[open_]
            out[open_[known]] = self.placed + at[known]
        return out


VALUES = (("print", np.uint32), ("shard", np.uint32), ("offset", np.uint64), ("copies", np.uint64), ("start", np.uint64))


def pack_bucket(keys: np.ndarray, values: dict[str, np.ndarray]) -> bytes:
    mph = PerfectHash.build(keys)
    order = np.argsort(mph.slots(keys))
    values = values | {"print": fingerprints(keys)}
    head = struct.pack("<4I", 1, len(keys), len(mph.levels), len(mph.rest))
    head += struct.pack(f"<{len(mph.levels)}Q", *map(len, mph.levels))
    body = b"".join(np.packbits(bits).tobytes() for bits in mph.levels)
    body += mph.rest.astype("<u8").tobytes()
    return head + body + b"".join(values[n][order].astype(kind).tobytes() for n, kind in VALUES)


class Bucket:
    def __init__(self, data: bytes):
        _, n, levels, rest = struct.unpack_from("<4I", data)
        at = 16
        sizes = struct.unpack_from(f"<{levels}Q", data, at)
        at += 8 * levels
        bits = []
        for size in sizes:
            packed = np.frombuffer(data, dtype=np.uint8, count=-(-size // 8), offset=at)
            bits.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        self.mph = PerfectHash(bits, np.frombuffer(data, dtype="<u8", count=rest, offset=at))
        at += 8 * rest
        self.values = {}
        for name, kind in VALUES:
            self.values[name] = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += n * np.dtype(kind).itemsize

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, slot) of each key: known if the stored fingerprint agrees."""
        slots = self.mph.slots(keys)
        known = slots >= 0
        known[known] = self.values["print"][slots[known]] == fingerprints(keys[known])
        return known, slots


# -- files ------------------------------------------------------------------

def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _publish(root: str, name: str, attempt: str, parts) -> None:
    """Write ``parts`` as ``root/name``: an attempt's file, then a rename."""
    store, folder = _store(root)
    store.create_dir(folder, recursive=True)
    with store.open_output_stream(f"{folder}/{name}.{attempt}.part") as f:
        for p in parts:
            f.write(p)
    try:
        store.move(f"{folder}/{name}.{attempt}.part", f"{folder}/{name}")
    except OSError:  # another attempt was first: the content is the same
        store.delete_file(f"{folder}/{name}")
        store.move(f"{folder}/{name}.{attempt}.part", f"{folder}/{name}")


def _attempt() -> str:
    from pyspark import TaskContext

    return str(TaskContext.get().taskAttemptId())


@dataclass
class TokenIndex:
    spark: SparkSession
    root: str
    id_bytes: int
    buckets: int
    repeats: bool = True    # some key has more than one record

    def lookup(self, keys: DataFrame, column: str = "doc_id") -> DataFrame:
        """(key, shard, offset, copies, start) of the known ones of ``keys``."""
        root = self.root
        by_bucket = keys.select(F.col(column).cast("bigint").alias("key")).where("key IS NOT NULL").distinct() \
            .withColumn("bucket", _bucket(F.col("key"), self.buckets)) \
            .repartition("bucket").sortWithinPartitions("bucket")

        def run(batches):
            import pyarrow as pa

            store, folder = _store(root)
            name, bucket = -1, None
            for batch in one_by_one(batches):
                ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                of = batch.column(1).to_numpy(zero_copy_only=False)
                for b in np.unique(of).tolist():
                    if b != name:
                        with store.open_input_stream(f"{folder}/index-{b:06d}.mph") as f:
                            name, bucket = b, Bucket(f.read())
                    mine = ids[of == b]
                    known, slots = bucket.find(mine.view(np.uint64))
                    slots = slots[known]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mine[known])] + [pa.array(bucket.values[n][slots].astype(np.int64))
                                                   for n in ("shard", "offset", "copies", "start")],
                        names=["key", "shard", "offset", "copies", "start"])

        if not self.buckets:
            return by_bucket.selectExpr("key", "0L AS shard", "0L AS offset", "0L AS copies", "0L AS start").where("false")
        return by_bucket.mapInArrow(run, "key bigint, shard bigint, offset bigint, copies bigint, start bigint")

    def entries(self) -> DataFrame:
        """(key, shard, offset, start) of every stored record."""
        entries, manifest = (self.spark.read.parquet(f"{self.root}/{n}") for n in ("entries", "manifest"))
        return entries.join(manifest.select("shard", "ids_before"), "shard") \
            .select("key", "shard", "offset", (F.col("ids_before") + F.col("before")).alias("start"))

    def records(self, found: DataFrame, make_reader, fields: str) -> DataFrame:
        """Read the records of looked-up keys; ``make_reader()`` returns a
        function from an id array to the values of ``fields``.

        A repeated key becomes one row per record, so that its shards are
        read in parallel."""
        if not self.repeats:
            return self.read(found, make_reader, fields)
        found = written(found, shared_dir(self.spark, "token-found"))
        once = found.where("copies = 1").select("key", "shard", "offset", "start")
        repeated = found.where("copies > 1").select(F.col("key").alias("repeated"))
        again = self.entries().join(if_small(repeated), F.col("key") == F.col("repeated")).drop("repeated")
        return self.read(once.unionByName(again), make_reader, fields)

    def read(self, placed: DataFrame, make_reader, fields: str) -> DataFrame:
        """The same for (key, shard, offset, start) rows, one a record."""
        from pyspark.sql.types import StructType

        root, width = self.root, self.id_bytes
        kind = np.dtype("<u2" if width == 2 else "<u4")
        out = StructType.fromDDL(f"key bigint, start bigint, n_tokens bigint, {fields}")
        placed = placed.select("key", "shard", "offset", "start") \
            .repartition("shard").sortWithinPartitions("shard", "offset")

        def run(batches):
            import pyarrow as pa

            store, folder = _store(root)
            read = make_reader()
            opened: list = [None, None]

            def shard(n):
                if opened[0] != n:
                    if opened[1] is not None:
                        opened[1].close()
                    path = f"{folder}/shard-{n:06d}.ids"
                    opened[:] = [n, store.open_input_file(path)]
                return opened[1]

            def record(key, n, offset, start):
                count = struct.unpack("<I", shard(n).read_at(4, offset))[0]
                ids = np.frombuffer(shard(n).read_at(count * width, offset + 4), dtype=kind)
                return (key, start, count, *read(ids))

            for batch in one_by_one(batches):
                rows = [record(*c) for c in zip(*(col.to_pylist() for col in batch.columns))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=t) for v, t in zip(zip(*rows), _arrow_types(out))], names=out.names)

        return placed.mapInArrow(run, out)


def _arrow_types(schema):
    from pyspark.sql.pandas.types import to_arrow_schema

    return [f.type for f in to_arrow_schema(schema)]


def _bucket(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(max(buckets, 1))).cast("int")


def write_token_index(docs: DataFrame, tokenizer: str, root: str | None = None, end_id: int = END_ID,
                      key: str = "doc_id", keys_per_bucket: int = KEYS_PER_BUCKET) -> TokenIndex:
    """Encode every text, write shards, manifest and index under ``root``."""
    import json

    spark = docs.sparkSession
    root = root or shared_dir(spark, "token-index")
    with open(tokenizer, encoding="utf-8") as f:
        vocabulary = json.load(f)
    largest = max([end_id, *vocabulary["model"]["vocab"].values(), *(t["id"] for t in vocabulary["added_tokens"])])
    width = 2 if largest < 1 << 16 else 4
    kind = np.dtype("<u2" if width == 2 else "<u4")
    ordered = docs.select(F.col(key).cast("bigint").alias("key"), "text") \
        .repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key", "text")

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        tokens = worker_tokens(tokenizer)
        end = np.array([end_id], dtype=kind)
        keys, sizes = [], []

        def encoded():
            for batch in one_by_one(batches):
                keys.extend(batch.column(0).to_pylist())
                for _, part in text_chunks(as_bytes(batch.column(1))):
                    for ids in tokens.encode([t.decode() for t in part]):
                        sizes.append(len(ids) + 1)
                        yield struct.pack("<I", len(ids) + 1) + np.append(ids.astype(kind), end).tobytes()

        first = next(records := encoded(), None)
        if first is None:
            return

        def stream():
            yield first
            yield from records

        _publish(root, f"shard-{shard:06d}.ids", _attempt(), stream())
        n = np.array(sizes, dtype=np.int64)
        before = np.cumsum(n) - n
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, type=pa.int64()), pa.array(np.full(len(n), shard)),
             pa.array(before * width + 4 * np.arange(len(n))), pa.array(before), pa.array(n)],
            names=["key", "shard", "offset", "before", "n"])

    entries = written(ordered.mapInArrow(write, "key bigint, shard bigint, offset bigint, before bigint, n bigint"),
                      f"{root}/entries")
    # one row per shard: bounded by the number of shuffle partitions
    totals = sorted(entries.groupBy("shard").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("ids"),
                                                  F.count("key").alias("keyed")).collect())
    starts, so_far = [], 0
    for shard, n_docs, ids, _ in totals:
        starts.append((shard, n_docs, ids, so_far))
        so_far += ids
    manifest = written(spark.createDataFrame(starts, "shard bigint, docs bigint, ids bigint, ids_before bigint"),
                       f"{root}/manifest")
    n_keys = sum(t[1] for t in totals)
    buckets = -(-n_keys // keys_per_bucket)
    first = entries.where("key IS NOT NULL").join(manifest.select("shard", "ids_before"), "shard").groupBy("key").agg(
        F.min(F.struct("shard", "offset", (F.col("ids_before") + F.col("before")).alias("start"))).alias("first"),
        F.count(F.lit(1)).alias("copies")).select("key", "first.*", "copies")

    def index(bucket, part):
        import pandas as pd

        keys = part["key"].to_numpy(np.int64).view(np.uint64)
        values = {n: part[n].to_numpy(np.int64) for n in ("shard", "offset", "copies", "start")}
        b = int(bucket[0])
        _publish(root, f"index-{b:06d}.mph", _attempt(), [pack_bucket(keys, values)])
        return pd.DataFrame({"bucket": [b], "keys": [len(part)]})

    repeats = False
    if buckets:
        built = first.withColumn("bucket", _bucket(F.col("key"), buckets)).groupBy("bucket") \
            .applyInPandas(index, "bucket int, keys bigint")
        distinct = written(built, f"{root}/buckets").agg(F.sum("keys")).first()[0] or 0
        repeats = distinct < sum(t[3] for t in totals)
    return TokenIndex(spark, root, width, buckets, repeats)


def id_checksums(index: TokenIndex, keys: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the records of ``keys``, read
    through the index; CRC-32 of the ids as little-endian u32."""

    def reader():
        return lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),)

    rows = index.records(index.lookup(keys), reader, "ids_crc32 bigint")
    return rows.withColumnRenamed("key", "doc_id")


def keyless_checksums(index: TokenIndex) -> DataFrame:
    """The same columns for rows without key, read in shard order."""
    def reader():
        return lambda ids: (zlib.crc32(ids.astype("<u4").tobytes()),)

    rows = index.read(index.entries().where("key IS NULL"), reader, "ids_crc32 bigint")
    return rows.withColumnRenamed("key", "doc_id")
