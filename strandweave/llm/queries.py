"""The registered queries: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strandweave.llm import alignment, ann, chat, exact_dedup, hard_negatives, html_text, mixing, packing, pii, quality, secrets, simhash, token_counts
from strandweave.llm.common import read_table
from strandweave.tables import Workspace


def tokenizer_path() -> str:
    """The vocabulary that the packing query is fixed to; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def aligned_paths() -> tuple[str, str]:
    """The vocabularies A and B that the alignment query is fixed to."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read_table(spark, sf_dir, "pages"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read_table(spark, sf_dir, "documents"), Workspace(spark))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_components(read_table(spark, sf_dir, "documents"), Workspace(spark))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.canonical_turns(read_table(spark, sf_dir, "conversations"))
    # Conversation -1: a text made of control strings, from a user and from an assistant.
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.chat_digests(chat.format_chats(turns.unionByName(probe)))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents"), Workspace(spark), tokenizer_path())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), Workspace(spark))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents"), Workspace(spark))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read_table(spark, sf_dir, "documents"), Workspace(spark))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"), Workspace(spark))
    return rows.select("doc_id", "keep_id", "group_size", "kept", rows["digest"].alias("text_sha256"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read_table(spark, sf_dir, "documents"), Workspace(spark), *aligned_paths())


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_hard_negatives(read_table(spark, sf_dir, "embeddings"), Workspace(spark))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {
    "op1_html": op1_html,
    "op2_pii": op2_pii,
    "op3_simhash": op3_simhash,
    "op4_chat": op4_chat,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_nn_descent": op7_nn_descent,
    "op8_secrets": op8_secrets,
    "op9_mixing": op9_mixing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_alignment": op11_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_counts": op13_token_counts,
}
