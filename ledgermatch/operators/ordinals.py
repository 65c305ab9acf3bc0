"""Positions and running totals over all rows of a table (L2) without a task
that sorts them all.

Rows are range-partitioned by the order, each partition's total is added to
the totals of the partitions before it, and a window numbers the rows within
their partition only. The ranged rows are written once to the shared folder, so
totals and rows come from the same partitions even if an executor is lost. A
key with most of the rows is spread over many partitions as long as its rows
differ in the other order columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.session import materialize

BEFORE = (Window.unboundedPreceding, -1)


def running_total(df: DataFrame, order: list[Column], values: dict[str, str]) -> DataFrame:
    """``df`` with a column per entry of ``values`` (new name -> summed column):
    the sum over all rows up to and including the row, in ``order``.

    Rows that are equal in ``order`` get their places in an arbitrary but fixed
    sequence.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *order).withColumn("__pid", F.spark_partition_id()), "ordinal")
    totals = ranged.groupBy("__pid").agg(*[F.sum(v).alias(f"__s{i}") for i, v in enumerate(values.values())])
    before = Window.orderBy("__pid").rowsBetween(*BEFORE)      # one row per partition
    offsets = totals.select("__pid", *[F.coalesce(F.sum(f"__s{i}").over(before), F.lit(0)).alias(f"__b{i}") for i in range(len(values))])
    own = Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumns({f"__r{i}": F.sum(v).over(own) for i, v in enumerate(values.values())})
    out = out.join(F.broadcast(offsets), "__pid")              # bounded by the number of partitions
    return out.select(*df.columns, *[(F.col(f"__r{i}") + F.col(f"__b{i}")).alias(name) for i, name in enumerate(values)])


def with_ordinal(df: DataFrame, order: list[Column], out: str = "ordinal") -> DataFrame:
    """``df`` with ``out``: 1, 2, ... over all rows in ``order``."""
    return running_total(df.withColumn("__one", F.lit(1).cast("bigint")), order, {out: "__one"}).drop("__one")
