"""Bounded samples of labelled rows and the hold-out rule they respect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import written


def held_out(doc_id: str = "doc_id"):
    """True for rows whose crc32 of the id as text is divisible by 5.

    Rows without id are not held out (they have no label either)."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, path: str,
                    only: int | None = None) -> DataFrame:
    """At most ``rows`` labelled texts outside the held-out part, as
    ``text, label``, written to ``path``.

    The sample is the rows with the smallest hash of doc_id, so it does not
    depend on partitioning; contradictory labels of one id count as their
    maximum.  ``only`` keeps one label value."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("label"))
    if only is not None:
        known = known.where(F.col("label") == only)
    ids = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), f"{path}-ids")
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # ids: at most ``rows``
    # the copies of a text and the rows of an id count once
    return written(texts.groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("r"))
                   .select("r.text", "r.label"), path)
