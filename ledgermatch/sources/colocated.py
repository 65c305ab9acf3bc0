"""Two tables stored so that they meet without a shuffle.

Both are written bucketed and sorted by a hash of the shared keys. Grouping a
bucketed table by (hash, keys) needs no exchange, and the two grouped sides
join bucket by bucket on the hash; the keys themselves, nulls included, are
compared as a condition.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.session import shared_dir

KEY_HASH = "__key_hash"


def stored(df: DataFrame, keys: list[str], buckets: int, name: str) -> DataFrame:
    """``df`` with the hash of its keys, written as a bucketed, sorted table in
    the shared folder and read back. One shuffle now, none in later comparisons
    with tables stored with the same keys and number of buckets."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (df.withColumn(KEY_HASH, F.xxhash64(*keys)).repartition(buckets, KEY_HASH)
       .write.format("parquet").option("path", shared_dir(spark, table)).bucketBy(buckets, KEY_HASH).sortBy(KEY_HASH).saveAsTable(table))
    return spark.table(table)


def aligned(new: DataFrame, old: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Both stored tables summed per key and side by side: keys, ``<m>_new``,
    ``<m>_old``, ``in_new``, ``in_old``. No exchange; null keys are equal."""
    def side(df, s):
        grouped = df.groupBy(KEY_HASH, *keys).agg(*[F.sum(m).alias(f"{m}_{s}") for m in measures], F.count(F.lit(1)).alias(f"__rows_{s}"))
        return grouped.select(F.col(KEY_HASH).alias(f"__h_{s}"), *[F.col(k).alias(f"__{s}_{k}") for k in keys],
                              *[f"{m}_{s}" for m in measures], F.lit(True).alias(f"in_{s}"))
    a, b = side(new, "new"), side(old, "old")
    # Written so that the hash alone is a join key and places the rows.
    same = F.col("__h_new") == F.col("__h_old")
    for k in keys:
        x, y = F.col(f"__new_{k}"), F.col(f"__old_{k}")
        same = same & F.coalesce(x == y, x.isNull() & y.isNull())
    j = a.hint("merge").join(b, same, "full_outer")
    yes = lambda s: F.coalesce(F.col(f"in_{s}"), F.lit(False)).alias(f"in_{s}")
    return j.select(*[F.when(F.col("in_new"), F.col(f"__new_{k}")).otherwise(F.col(f"__old_{k}")).alias(k) for k in keys],
                    *[f"{m}_{s}" for m in measures for s in ("new", "old")], yes("new"), yes("old"))
