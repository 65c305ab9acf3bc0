"""Exact dedup by content sort, in DataFrame operations only.

The normalised texts are range-partitioned by splitters that Spark samples,
sorted (spilling to disk) by their first characters, hash and full bytes, so
equal texts are neighbours, and the sorted stream's neighbouring full
comparisons form the groups. Of a group the row
with the largest identifier stays (or the smallest, by parameter).

A text with very many copies would land in one range. Rows are first counted
by a 64-bit hash; the few hashes above the hot limit are aggregated on the map
side (one row per text and task is shuffled, however many copies there are)
and joined back as a broadcast. Fewer than 1 / HOT_SHARE hashes can be above
the limit, which bounds the broadcast.

Defined results: a null text equals the empty text. Texts are equal when
identical after lower-casing A-Z. Rows that repeat an identifier and a text
form one group in which exactly one row is kept. A null identifier is smaller
than any other. Empty tables give empty tables; extra columns stay in ``row``
and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.text import lower_ascii, whole_text

HOT_SHARE = 0.001     # a text with more than this share of all rows is hot
HOT_LEAST = 100       # and has at least so many rows
HEAD = 32             # characters in a splitter


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True,
                 carry_row: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept,
    text_sha256 (of the normalised text), with ``carry_row`` also ``row`` (the
    input row as a struct)."""
    text = whole_text(text_col)
    order = F.desc_nulls_last if largest else F.asc_nulls_first
    src = docs.select(F.col(id_col).alias("id"), text.alias("text"),
                      *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry_row else []))
    carried = ["row"] if carry_row else []
    # Equal normalised texts have equal lower-cased texts, so this hash only
    # ever counts too many rows as copies.
    by_hash = F.xxhash64(F.lower("text"))
    counts = src.groupBy(by_hash.alias("hot_h")).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > max(HOT_LEAST, HOT_SHARE * docs.count())).select("hot_h")
    # The row number breaks ties between rows that repeat an identifier.
    rows = (src.withColumn("nr", F.monotonically_increasing_id())
            .join(F.broadcast(hot), by_hash == F.col("hot_h"), "left"))
    norm = rows.withColumn("norm", lower_ascii(F.col("text"))).drop("text")

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Splitters are sampled from the first characters and, for texts that begin
    # alike, the hash: small keys, so the sample stays small for long texts.
    cold = (norm.where(F.col("hot_h").isNull()).drop("hot_h")
            .withColumns({"head": F.substring("norm", 1, HEAD), "h": F.xxhash64("norm")}).repartitionByRange(n, "head", "h"))
    # The range partitioning clusters these keys already: the window only sorts.
    ordered = Window.partitionBy("head", "h", "norm").orderBy(order("id"), order("nr"))
    cold_out = cold.select(
        "id", "nr", *carried, F.sha2("norm", 256).alias("text_sha256"),
        F.count(F.lit(1)).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("group_size"),
        F.first(F.struct("id", "nr")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("best"))

    hot_rows = norm.where(F.col("hot_h").isNotNull()).withColumn("text_sha256", F.sha2("norm", 256))
    hot_groups = hot_rows.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"), (F.max if largest else F.min)(F.struct("id", "nr")).alias("best"))
    hot_out = hot_rows.join(F.broadcast(hot_groups), "text_sha256").select(*cold_out.columns)
    return cold_out.unionByName(hot_out).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("nr") == F.col("best.nr")).alias("kept"), "text_sha256", *carried)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True) -> DataFrame:
    """``docs`` without the rows that repeat another row's text."""
    g = exact_groups(docs, id_col, text_col, largest, carry_row=True)
    return g.where("kept").select("row.*")
