"""A training-data pipeline over ``documents``: language ID, exact dedup,
near dedup, source mixing and tokenising.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that the stage
before kept and returns a DataFrame, which is written as Parquet and read again
for the next one. All but the last return the columns of ``documents``:

* language ID drops rows without an identified language (``und`` or a
  calibrated probability below 0.5);
* exact dedup keeps the row with the largest identifier of each text;
* near dedup (shingles of five words, similarity 0.8 or more) keeps one row of
  each group, the smallest identifier's;
* source mixing returns each row as often as the mix takes it, 0 to 3 times;
* the last stage returns doc_id, n_tokens, ids (little-endian unsigned 32-bit
  integers) and decoded_sha256 of the decoded bytes, one row per row of the mix.

Empty tables pass through every stage; extra columns are carried to the last.
Stages are to be chained through ``results``, which writes between them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.llm import bpe, exact_dedup, langid, mixing, near_dedup
from ledgermatch.llm.arrow import small_batches
from ledgermatch.llm.registry import public_bpe, table
from ledgermatch.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return langid.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_dedup.near_dedup(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.mixed(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    ranks, pattern = public_bpe()
    coded = bpe.decode(bpe.encode(docs, ranks, pattern), ranks)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("bpe", tokenise),
]

#: Language ID is learned and the mix is a seeded subset-sum fit: not SQL.
ORACLE_SQL = None


def results(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Iterator[tuple[str, DataFrame]]:
    """(stage, its result) for the stages applied to ``docs`` in turn. Each
    result is written and read again: a stage reads its input several times, so
    plans that are only chained would grow with every stage."""
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        yield name, docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; the last one's result."""
    for _, docs in results(spark, table(spark, sf_dir, "documents"), sf_dir):
        pass
    return docs
