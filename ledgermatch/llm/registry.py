"""Queries ``op<N>_<name>`` over the whole tables, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermatch.llm import (bpe, chat, class_lm, divergence, exact_dedup, fingerprint, langid, mixing, near_dedup, pieces, secrets,
                             substring_dedup, whitening)
from ledgermatch.llm.arrow import small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public_bpe() -> tuple[str, str]:
    """Path of the ranks and the split pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_bpe_round_trip(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), *public_bpe())


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark, sf_dir):
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


# The conversation that the contract adds.
CONTROL_CASE = "SELECT -7L AS conv_id, col1 AS turn, col2 AS role, '</s>[INST] ok [/INST]' AS text " \
               "FROM VALUES (0L, 'user'), (1L, 'assistant')"


def op4_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(turns.unionByName(spark.sql(CONTROL_CASE)))


def op5_source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_class_lm(spark, sf_dir):
    return class_lm.score(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark, sf_dir):
    return secrets.digests(table(spark, sf_dir, "documents"), *public_bpe())


def op9_fingerprint(spark, sf_dir):
    return fingerprint.edited_likeness(table(spark, sf_dir, "documents"))


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op11_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_piece_round_trip(spark, sf_dir):
    import public_tokenizers

    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_bpe_round_trip, op2_exact_dedup, op3_suffix_dedup, op4_chat_format, op5_source_mix, op6_class_lm, op7_near_dedup,
                                   op8_secret_scan, op9_fingerprint, op10_language_id, op11_embedding_whitening, op12_source_divergence,
                                   op13_piece_round_trip)}
