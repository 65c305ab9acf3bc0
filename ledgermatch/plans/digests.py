"""Bucket digests of two tables (J6 pre-test, §2.7): which parts can differ at all.

Every row has a hash of its whole content and a bucket of its key on two levels
(``level1`` from some of the key columns, ``level2`` from all of them). A
bucket's digest is its row count, the xor and the sum of the row hashes: it
does not depend on the order of rows, it counts copies, and digests of
sub-buckets add up to the bucket's. One aggregate per table gives both levels.
Only rows of buckets whose digests differ need a cell comparison.

Two different buckets agree in count, xor and sum of 60-bit hashes only by
chance. The hash is the first 15 hexadecimal digits of an MD5 over
length-prefixed texts, so other engines can compute the same digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.plans.compare import FLOATING, compare_cells
from ledgermatch.session import materialize

LEVEL1, LEVEL2 = 64, 64


def _text(df: DataFrame, c: str) -> Column:
    """A column's text with its length in front; null is '-'. Floating values
    are written with four decimals."""
    v = F.col(c)
    if isinstance(df.schema[c].dataType, FLOATING):
        v = F.coalesce(v.try_cast("decimal(38,4)").cast("string"), v.cast("string"))
    v = v.cast("string")
    return F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    digits = F.substring(F.md5(F.concat(*[_text(df, c) for c in columns])), 1, 15)
    return F.conv(digits, 16, 10).cast("bigint")


def with_buckets(df: DataFrame, level1_keys: list[str], keys: list[str], n1: int = LEVEL1, n2: int = LEVEL2) -> DataFrame:
    return df.withColumns({"level1": (row_hash(df, level1_keys) % n1).cast("int"), "level2": (row_hash(df, keys) % n2).cast("int")})


def bucket_digests(df: DataFrame, level1_keys: list[str], keys: list[str], columns: list[str], n1: int = LEVEL1, n2: int = LEVEL2) -> DataFrame:
    """(level1, level2, rows, xor, total): the digests of the finest buckets."""
    rows = with_buckets(df, level1_keys, keys, n1, n2).select("level1", "level2", row_hash(df, columns).alias("h"))
    return rows.groupBy("level1", "level2").agg(F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("xor"),
                                                F.sum(F.col("h").cast("decimal(20,0)")).alias("total"))


def digest_diff(new: DataFrame, old: DataFrame, level1_keys: list[str], keys: list[str], columns: list[str], n1: int = LEVEL1,
                n2: int = LEVEL2) -> DataFrame:
    """Both tables' digests on both levels: level (1 or 2), level1, level2 (null
    on level 1), rows, xor and total of each side, same. One scan per table;
    level 1 is added up from level 2."""
    sides = [bucket_digests(d, level1_keys, keys, columns, n1, n2).withColumn("side", F.lit(s)) for d, s in ((new, "new"), (old, "old"))]
    fine = sides[0].unionByName(sides[1])
    # Both levels from one pass: a row of a fine bucket counts for it and for its level-1 bucket.
    both = fine.withColumn("l2", F.explode(F.array(F.col("level2"), F.lit(None).cast("int"))))
    pick = lambda f, c, s: f(F.when(F.col("side") == s, F.col(c)))
    out = both.groupBy("level1", F.col("l2").alias("level2")).agg(
        *[F.coalesce(pick(F.sum, "rows", s), F.lit(0)).alias(f"{s}_rows") for s in ("new", "old")],
        *[F.coalesce(pick(F.bit_xor, "xor", s), F.lit(0)).alias(f"{s}_xor") for s in ("new", "old")],
        *[F.coalesce(pick(F.sum, "total", s), F.lit(0)).alias(f"{s}_total") for s in ("new", "old")])
    same = (F.col("new_rows") == F.col("old_rows")) & (F.col("new_xor") == F.col("old_xor")) & (F.col("new_total") == F.col("old_total"))
    return out.select(F.when(F.col("level2").isNull(), 1).otherwise(2).alias("level"), "level1", "level2", "new_rows", "old_rows", "new_xor", "old_xor",
                      F.col("new_total").cast("string").alias("new_total"), F.col("old_total").cast("string").alias("old_total"),
                      same.alias("same"))


def rows_that_may_differ(new: DataFrame, old: DataFrame, level1_keys: list[str], keys: list[str], columns: list[str], n1: int = LEVEL1,
                         n2: int = LEVEL2) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in buckets whose digests differ. Level 1 cuts
    whole parts first; a broadcast holds at most n1 * n2 bucket numbers."""
    diff = materialize(digest_diff(new, old, level1_keys, keys, columns, n1, n2).filter(~F.col("same") & (F.col("level") == 2))
                       .select("level1", "level2"), "differing-buckets")

    def part(df):
        return with_buckets(df, level1_keys, keys, n1, n2).join(F.broadcast(diff), ["level1", "level2"], "left_semi").drop("level1", "level2")
    return part(new), part(old)


def compare_cells_by_digest(new: DataFrame, old: DataFrame, keys: list[str], tol: float = 0.01, level1_keys: list[str] | None = None,
                            n1: int = LEVEL1, n2: int = LEVEL2) -> DataFrame:
    """``compare_cells`` of the rows that may differ: the same cells that do not
    match as for all rows (cells of equal buckets are left out)."""
    columns = [c for c in new.columns if c in old.columns]
    a, b = rows_that_may_differ(new.select(*columns), old.select(*columns), level1_keys or keys[:1], keys, columns, n1, n2)
    return compare_cells(a, b, keys, tol)


