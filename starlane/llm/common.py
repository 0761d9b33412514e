"""Small shared helpers: tables, written stages, per-worker state."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

from starlane.session import apply_engine_conf, checkpoint_root, delete_path

# Text handed to one numpy pass (bytes); only bounds memory, never cuts a text.
CHUNK_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder of ``spark.checkpoint.dir``."""
    apply_engine_conf(spark)
    return f"{checkpoint_root(spark).rstrip('/')}/starlane-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage).

    The read uses the frame's own schema, so empty tables work too."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *paths: str) -> None:
    """Drop written stages that nothing reads any more."""
    for path in paths:
        delete_path(spark, path)


def worker_state(key: str, make: Callable):
    """State kept for the life of a Python worker (tokenizer tables, caches)."""
    store = sys.__dict__.setdefault("_starlane_worker_state", {})
    if key not in store:
        store[key] = make()
    return store[key]


def text_chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list]]:
    """(first row, texts) groups of about ``limit`` bytes; a text stays whole."""
    first, size, part = 0, 0, []
    for i, t in enumerate(texts):
        if part and size + len(t) > limit:
            yield first, part
            first, size, part = i, 0, []
        part.append(t)
        size += len(t) + 1
    if part:
        yield first, part


def as_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null becomes empty."""
    import pyarrow as pa

    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def one_by_one(batches: Iterable, rows: int | None = None) -> Iterator:
    """Skip empty Arrow batches; with ``rows``, cut the others to that many."""
    for b in batches:
        for at in range(0, b.num_rows, rows or max(b.num_rows, 1)):
            yield b.slice(at, rows or b.num_rows)


def annotate(df: DataFrame, make_scorer: Callable, fields: str, keep: list[str] | None = None,
             text: str = "text", more: list[str] | None = None, rows_at_once: int | None = None,
             chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Add columns computed from whole texts, one Arrow batch at a time.

    ``make_scorer()`` runs once per task and returns a function from a list of
    UTF-8 texts (and, with ``more``, lists of those columns' values) to a dict
    of equally long columns.  ``fields`` is the DDL of the new columns; input
    columns of the same names (or clashing in case) are replaced.  ``keep``
    names the input columns that stay (all by default).  ``rows_at_once`` cuts
    the batches where a row needs much more than its text, ``chunk_bytes`` the
    text that the function gets at once (a text stays whole).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    apply_engine_conf(df.sparkSession)  # bounds the Arrow batches
    new = StructType.fromDDL(fields)
    taken = {n.lower() for n in new.names}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    # columns travel under positions, so odd or repeated-looking names are safe
    quoted = [f"`{c.replace('`', '``')}`" for c in keep]
    inputs = [df[q].alias(f"k{i}") for i, q in enumerate(quoted)]
    inputs.append(df[text].alias("t"))
    extra = more or []
    inputs += [df[c].alias(f"m{i}") for i, c in enumerate(extra)]
    slim = df.select(*inputs)
    out = StructType(slim.schema.fields[:len(keep)] + new.fields)
    n_keep, n_more, names = len(keep), len(extra), new.names

    def run(batches):
        import pyarrow as pa

        schema = to_arrow_schema(out)
        score = make_scorer()
        for batch in one_by_one(batches, rows_at_once):
            texts = as_bytes(batch.column(n_keep))
            others = [batch.column(n_keep + 1 + i).to_pylist() for i in range(n_more)]
            cols = {n: [] for n in names}
            for first, part in text_chunks(texts, chunk_bytes):
                got = score(part, *[o[first:first + len(part)] for o in others])
                for n in names:
                    cols[n].append(pa.array(got[n], type=schema.field(n).type))
            arrays = [batch.column(i).cast(schema.field(i).type) for i in range(n_keep)]
            arrays += [pa.concat_arrays(cols[n]) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    result = slim.mapInArrow(run, out)
    return result.toDF(*keep, *names)
