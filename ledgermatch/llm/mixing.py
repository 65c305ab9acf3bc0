"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by (source, exact length). Each source gets whole
repeats of itself and a remaining budget below its size. The budget is filled
per length in proportion, then greedily from long to short, and the last few
thousand words by a bounded-knapsack dynamic programme over the lengths still
available, first up to the budget and then as far above it as is nearer. Of few
documents all choices are tried; where only very long ones are left, the nearest
is taken, or one above for which shorter ones are given back. Of each length the planned number of documents is then selected in
a seeded hash order.

Defined results: a null text has size 0 and takes nothing. Null is a source of
its own, after all others. Equal hashes are ordered by identifier; rows that
repeat an identifier count as documents of their own. A source of size 0 has
target 0. Empty tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.text import whole_text
from ledgermatch.session import materialize

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)       # by the source's place, repeating
CAP = 3                   # a target is at most so many times its source's size
SEED = 20240229
RESERVE = (4096, 200_000)  # least and most words left to the dynamic programme
WORK = 10 ** 9             # lengths times words that it may look at
FEW = 4096                 # choices of documents that are all tried
BLOCK = 20000             # rows of one length that are ranked together


def fit_budget(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size to take so that their sizes add up to
    ``budget`` or as close to it as possible; at most ``counts`` of each."""
    total = sum(s * c for s, c in zip(sizes, counts))
    if budget >= total:
        return list(counts)
    if not total:
        return [0] * len(sizes)
    if len(sizes) <= FEW.bit_length() and math.prod(c + 1 for c in counts) <= FEW:
        sums = np.zeros(1, np.int64)     # of all choices, the last size's count changing fastest
        for s, c in zip(sizes, counts):
            sums = (sums[:, None] + s * np.arange(c + 1)).ravel()
        at = int(np.abs(sums - budget).argmin())
        return [int(k) for k in np.unravel_index(at, [c + 1 for c in counts])]
    reserve = min(max(WORK // len(sizes), RESERVE[0]), RESERVE[1])
    # In proportion, but for what the dynamic programme fills.
    take = [c * max(0, budget - reserve) // total for c in counts]
    left = budget - sum(t * s for t, s in zip(take, sizes))
    down = sorted((s, i) for i, s in enumerate(sizes) if s > 0)[::-1]
    for s, i in down:
        more = min(counts[i] - take[i], max(0, left - reserve) // s)
        take[i] += more
        left -= more * s
    open_sizes = [(s, i) for s, i in down if take[i] < counts[i]]
    if left > 3 * reserve:
        # All open lengths are above left - reserve: of them one document at most
        # is nearest; or one above it, for which shorter ones are given back.
        s, i = min(open_sizes, key=lambda x: abs(x[0] - left))
        best, off = list(take), left
        if abs(s - left) < off:
            best[i], off = best[i] + 1, abs(s - left)
        s, i = min(((s, i) for s, i in open_sizes if s > left), default=(0, 0))
        if s and off:
            back = fit_budget(sizes, take, s - left)
            if abs(s - left - sum(b * x for b, x in zip(back, sizes))) < off:
                best = [t - b for t, b in zip(take, back)]
                best[i] += 1
        return best
    # Bounded knapsack on the rest: reach[b] says that b words can be filled;
    # first[b] is the item that first reached b, so walking back uses each once.
    # First up to the budget; where that is not met, as far above it as is nearer.
    at, room = 0, left
    while True:
        items = []
        for s, i in open_sizes:
            n, k = min(counts[i] - take[i], room // s), 1
            while n > 0:
                k = min(k, n)
                items.append((s * k, i, k))
                n, k = n - k, k * 2
        reach, first = np.zeros(room + 1, bool), np.full(room + 1, -1, np.int32)
        reach[0] = True
        for number, (w, _, _) in enumerate(items):
            new = np.flatnonzero(reach[: room + 1 - w] & ~reach[w:]) + w
            reach[new], first[new] = True, number
            if reach[left]:
                break
        found = np.flatnonzero(reach)
        at = int(found[np.abs(found - left).argmin()])
        if at == left or room > left:
            break
        room = 2 * left - at
    while at:
        w, i, k = items[first[at]]
        take[i] += k
        at -= w
    return take


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    """One source's (size, n) rows, with its target: repeats and extra documents per size."""
    total, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    repeats = int(target // total) if total else 0
    budget = round(target - repeats * total)
    pdf = pdf.sort_values("size")
    pdf["extra"] = fit_budget(pdf["size"].tolist(), pdf["n"].tolist(), int(budget)) if repeats < CAP else 0
    pdf["repeats"] = repeats
    return pdf[["src", "no_src", "size", "n", "source_size", "target", "repeats", "extra"]]


def place_in_order(table: DataFrame, *order) -> DataFrame:
    """``table`` with ``place`` (0, 1, ...) in the order of the columns, from a
    range partitioning and the partitions' row counts."""
    n = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(table.repartitionByRange(n, *order).withColumn("pid", F.spark_partition_id()), "places")
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offsets = (ranged.groupBy("pid").agg(F.count(F.lit(1)).alias("c"))
               .select("pid", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset")))
    return (ranged.join(F.broadcast(offsets), "pid")
            .withColumn("place", F.col("offset") + F.row_number().over(Window.partitionBy("pid").orderBy(*order)) - 1)
            .drop("pid", "offset"))


def targets(sources: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources`` (src, no_src, source_size) with ``target``: shares of the
    total by weight; what exceeds ``cap`` times a source's size is shared
    again by weight among the others, until none is above."""
    placed = place_in_order(sources, F.col("no_src"), F.col("src"))
    weight = F.array(*[F.lit(w) for w in weights])
    placed = materialize(placed.withColumn("weight", F.get(weight, F.col("place") % len(weights))), "sources")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    share, capped = 0.0, -1
    while total:
        above = F.col("source_size") * cap < F.col("weight") * share
        r = placed.agg(F.count_if(above).alias("capped"), F.sum(F.when(above, F.col("source_size") * cap)).alias("full"),
                       F.sum(F.when(~above, F.col("weight"))).alias("w")).first()
        if r["capped"] == capped or not r["w"]:
            break
        capped, share = r["capped"], (total - (r["full"] or 0)) / r["w"]
    return placed.withColumn("target", F.least((F.col("source_size") * cap).cast("double"), F.col("weight") * F.lit(float(share))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """One row per input row: ``id_col``, text_hash (xxhash64), size,
    source_size, target, copies (times the mix takes it), taken (words)."""
    sized = materialize(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"),
        F.col(source_col).isNull().alias("no_src"), F.xxhash64(whole_text(text_col)).alias("text_hash"),
        F.regexp_count(whole_text(text_col), F.lit(WORDS)).cast("long").alias("size")), "sizes")
    lengths = materialize(sized.groupBy("src", "no_src", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sources = lengths.groupBy("src", "no_src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    with_target = targets(sources, weights, cap).select("src", "no_src", "source_size", "target")
    # A group here has one row per distinct length of a source, not per document.
    plan = materialize(lengths.join(with_target, ["src", "no_src"]).groupBy("src", "no_src").applyInPandas(
        _plan, "src string, no_src boolean, size long, n long, source_size long, target double, repeats long, extra long"), "plan")
    h = F.xxhash64(F.lit(seed), F.col("id").cast("string"), "text_hash")
    rows = (sized.withColumn("h", h).join(plan, ["src", "no_src", "size"])
            .withColumn("bucket", F.pmod(F.xxhash64("h"), F.ceil(F.col("n") / BLOCK))))
    # A length with very many documents is ranked in hash buckets: whole
    # buckets are taken until the one in which the count is reached.
    key = ["src", "no_src", "size", "bucket"]
    before = Window.partitionBy("src", "no_src", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    large = (rows.where(F.col("n") > BLOCK).groupBy(*key).agg(F.count(F.lit(1)).alias("c"))
             .withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c"))
    placed = rows.join(large, key, "left").withColumn("rest", F.col("extra") - F.coalesce("before", F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("h", F.col("id").asc_nulls_last()))
    copies = F.col("repeats") + F.when(rank <= F.col("rest"), 1).otherwise(0)
    return (placed.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0))
            .select(F.col("id").alias(id_col), "text_hash", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    plan = mix(docs, id_col, text_col, **kw).select(F.col(id_col).alias("m_id"), F.col("text_hash").alias("m_hash"), "copies").alias("m")
    # Rows that are not taken count among those that share.
    plan = plan.groupBy("m_id", "m_hash").agg(F.sum("copies").alias("m_copies"), F.count(F.lit(1)).alias("m_rows")).where(F.col("m_copies") > 0)
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("d_id"),
                    F.xxhash64(whole_text(text_col)).alias("d_hash"))
    joined = d.join(plan, d["d_id"].eqNullSafe(plan["m_id"]) & (d["d_hash"] == plan["m_hash"])).withColumns({
        "times": F.floor(F.col("m_copies") / F.col("m_rows")).cast("int"), "rest": F.col("m_copies") % F.col("m_rows")})
    # Rows that repeat identifier and text share their copies evenly; the first ``rest`` of them have one more.
    uneven = joined.where(F.col("rest") > 0).select("row", "d_id", "d_hash", "times", "rest", F.monotonically_increasing_id().alias("nr"))
    placed = place_in_order(materialize(uneven, "repeated-rows"), F.col("d_id"), F.col("d_hash"), F.col("nr"))
    first = placed.groupBy("d_id", "d_hash").agg(F.min("place").alias("first")).select(F.col("d_id").alias("f_id"), F.col("d_hash").alias("f_hash"), "first")
    shared = placed.join(first, placed["d_id"].eqNullSafe(first["f_id"]) & (placed["d_hash"] == first["f_hash"])).select(
        "row", F.when(F.col("place") - F.col("first") < F.col("rest"), F.col("times") + 1).otherwise(F.col("times")).alias("times"))
    taken = joined.where(F.col("rest") == 0).select("row", "times").unionByName(shared).where(F.col("times") > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
