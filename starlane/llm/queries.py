"""The registered queries of this subpackage, over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.chat import ORACLE as CHAT_ORACLE
from starlane.llm.common import table
from starlane.llm.prefix_trie import ORACLE as TRIE_ORACLE
from starlane.llm.source_audit import ORACLE as AUDIT_ORACLE


def op1_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starlane.llm.token_index import id_checksums, keyless_checksums, write_token_index

    docs = table(spark, sf_dir, "documents")
    index = write_token_index(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return id_checksums(index, docs.select("doc_id")).unionByName(keyless_checksums(index))


def _verdict(scored: DataFrame, threshold: float) -> DataFrame:
    from starlane.llm.labels import held_out

    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starlane.llm.toxicity import score_toxicity, train

    docs = table(spark, sf_dir, "documents")
    return _verdict(score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")), keep=["doc_id"]), 0.5)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starlane.llm.quality_pu import score_quality, train

    docs = table(spark, sf_dir, "documents")
    return _verdict(score_quality(docs, train(docs, table(spark, sf_dir, "labels")), keep=["doc_id"]), 0.3)


def op4_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starlane.llm.common import shared_dir, written
    from starlane.llm.edit_counts import revision_edits, token_trees, update_trees

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    state = written(token_trees(docs, path), shared_dir(spark, "token-trees"))
    edited = revision_edits(state.drop("n_tokens"), keep=["doc_id", "text", "tree_chars", "tree_tokens"])
    done = update_trees(edited, path, keep=["doc_id", "edits"], with_text=False)
    return done.select("doc_id", F.size("edits").cast("bigint").alias("n_edits"), "n_tokens_before", "n_tokens",
                       "n_chars", "n_reencoded")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starlane.llm.near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starlane.llm.line_dedup import line_decisions

    return line_decisions(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starlane.llm.decontaminate import digest, mark_hits

    return digest(mark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                            keep=["doc_id"]))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from starlane.llm.bpe import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                          keep=["doc_id"])


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starlane.llm.chat import digest, format_conversations, text_parts

    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)],
                                  "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digest(format_conversations(turns.withColumn("parts", text_parts(F.col("text")))))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starlane.llm.quality_rules import BASE, quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", *BASE, "base_failed", "kept", "distance")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starlane.llm.prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starlane.llm.source_audit import divergence

    return divergence(table(spark, sf_dir, "documents"))


def op13_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starlane.llm.katz import score_texts, training_rows

    return score_texts(table(spark, sf_dir, "documents"), training_rows())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_index": op1_token_index,
    "op2_toxicity": op2_toxicity,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_edit_token_counts": op4_edit_token_counts,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_bpe": op8_bpe,
    "op9_chat_format": op9_chat_format,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_source_audit": op12_source_audit,
    "op13_katz_backoff": op13_katz_backoff,
    "pipeline": pipeline,
}
ORACLE: dict[str, str] = {"op9_chat_format": CHAT_ORACLE, "op11_prefix_trie": TRIE_ORACLE,
                          "op12_source_audit": AUDIT_ORACLE}
