"""The corpus pipeline: five stages over ``documents``, each one operator of
``starlane.llm``.  Every stage reads what its predecessor wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starlane.llm.common import shared_dir, table, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay (op2)."""
    from starlane.llm.toxicity import drop_toxic

    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first stays; documents left without any go (op6)."""
    from starlane.llm.line_dedup import dedup_lines

    return dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (0.8 and more) stays (op5)."""
    from starlane.llm.near_dup import keep_first

    return keep_first(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go (op7)."""
    from starlane.llm.decontaminate import decontaminate

    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text (op8)."""
    import public_tokenizers

    from starlane.llm.bpe import encode_digests

    return encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"),
                          keep=[c for c in docs.columns if c != "text"])


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

# Learned scores, minhash components and BPE are beyond SQL; the stages are
# tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    root = shared_dir(spark, "corpus-pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{root}/{k}-{name}")
    return docs
