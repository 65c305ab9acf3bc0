"""Divergence between the sources of each language, by a K-squared quadtree
over the group-term count matrix (K = 2).

A group is a (lang, source); its row of the matrix holds its counts of the
language's kept terms, those in at least ``LEAST_DOCS`` of its documents. A
group gives a kept term the weight

    p = 1 + floor(10^9 (count + 2) / (N + 2 V))

and two weights differ by f = floor((p - q)^2 / (p + q)). Rows go to tiles of
``TILE`` groups and columns to stripes of about ``STRIPE`` terms, the top level
of the tree. A task holds one stripe of two tiles, builds the occupancy of all
lower quadrants, and walks both rows' quadrants jointly for all pairs of groups
at once: a quadrant pair that is zero on both sides is left where it is met,
any other is split in four, down to leaves whose cells are compared. What no
leaf of a pair covers is zero on both sides and has one weight per group, so it
is priced as (V - covered) * f of the two zero weights.

Defined results: null text, lang and source are ''. A language without kept
terms has the value 0 for every pair and no terms. Repeated rows and
identifiers are documents of their own. Empty tables give empty tables; other
columns are ignored. All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.arrow import slices
from ledgermatch.session import materialize

LEAST_DOCS = 10
TOP_TERMS = 10
UNIT = 1000000000
TILE, STRIPE = 256, 1024          # groups and terms of a top quadrant
LEAF_ROWS, LEAF_COLS = 8, 32      # cells of a leaf
FLUSH = 200000                    # distinct terms that a counting task holds
PIECE = 1 << 20                   # bytes of a text that are counted at a time
# Bytes that belong to terms; A-Z count as a-z, all others separate.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

CELL = "lang string, source string, term string, n long, docs long"


def _terms(raw: bytes):
    """The terms of a text, a list per piece of at most about ``PIECE`` bytes."""
    at = 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        part = raw[at:end].translate(LETTERS)
        if end < len(raw):
            cut = part.rfind(b" ") + 1
            if not cut:   # one term fills the piece: go on to its end
                part = raw[at:].translate(LETTERS)
                cut = part.find(b" ") + 1 or len(part)
            part, end = part[:cut], at + cut
        yield part.split()
        at = end


def _counts():
    """mapInArrow: (lang, source, term, n, docs), combined over a task's rows."""
    def rows(found):
        for (lang, source), (n, docs) in found.items():
            terms = list(n)
            for lo in range(0, len(terms), 50000):
                part = terms[lo: lo + 50000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                     pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()), pa.array([docs[t] for t in part], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])

    def run(batches):
        found, held = {}, 0
        for b in slices(batches):
            for lang, source, raw in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "raw"))):
                n, docs = found.setdefault((lang, source), (Counter(), Counter()))
                held -= len(n)
                own = set()
                for words in _terms(raw):
                    n.update(words)
                    own.update(words)
                docs.update(own)
                held += len(n)
            if held > FLUSH:
                yield from rows(found)
                found, held = {}, 0
        yield from rows(found)
    return run


def _levels(leaf: np.ndarray) -> list[np.ndarray]:
    """Occupancy of the quadrants from the root to the leaves."""
    out = [leaf]
    while out[0].shape[0] > 1:
        a = out[0]
        out.insert(0, a[::2, ::2] | a[1::2, ::2] | a[::2, 1::2] | a[1::2, 1::2])
    return out


class Matrix:
    """A tile's part of a stripe: weights by leaf block, and the quadtree's occupancy."""

    def __init__(self, zero: np.ndarray, height: int, row: np.ndarray, col: np.ndarray, p: np.ndarray):
        side = 1 << height
        full = np.ones((side * LEAF_ROWS, side * LEAF_COLS), np.int64)
        full[:len(zero)] = zero[:, None]
        full[row, col] = p
        seen = np.zeros(full.shape, bool)
        seen[row, col] = True
        block = (side, LEAF_ROWS, side, LEAF_COLS)
        self.leaf = full.reshape(block).transpose(0, 2, 1, 3)
        self.levels = _levels(seen.reshape(block).any((1, 3)))
        real = np.zeros(side * LEAF_ROWS, bool)
        real[:len(zero)] = True
        rows = real.reshape(side, LEAF_ROWS).any(1)
        self.rows = [rows]
        while len(self.rows[0]) > 1:
            self.rows.insert(0, self.rows[0][::2] | self.rows[0][1::2])


def joint_sums(a: Matrix, b: Matrix, height: int, cols: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(value, covered) by (row of a, row of b): the sums of f over the leaves
    that are not zero on both sides, and how many terms these have."""
    side = 1 << height
    nodes = np.zeros((3, 1), np.int64)      # rows of a, rows of b, columns
    for level in range(height + 1):
        if level:
            step = np.array([[i, j, k] for i in (0, 1) for j in (0, 1) for k in (0, 1)]).T
            nodes = (2 * nodes[:, :, None] + step[:, None, :]).reshape(3, -1)
            if same:
                nodes = nodes[:, nodes[0] <= nodes[1]]
        ra, rb, c = nodes
        alive = (a.levels[level][ra, c] | b.levels[level][rb, c]) & a.rows[level][ra] & b.rows[level][rb]
        nodes = nodes[:, alive]
    real = np.clip(cols - np.arange(side) * LEAF_COLS, 0, LEAF_COLS)
    inside = np.arange(LEAF_COLS) < real[:, None]
    value = np.zeros((side, side, LEAF_ROWS, LEAF_ROWS), np.int64)
    covered = np.zeros((side, side), np.int64)
    for lo in range(0, nodes.shape[1], 64):
        ra, rb, c = nodes[:, lo: lo + 64]
        x, y = a.leaf[ra, c][:, :, None, :], b.leaf[rb, c][:, None, :, :]
        f = (x - y) ** 2 // (x + y)
        np.add.at(value, (ra, rb), (f * inside[c][:, None, None, :]).sum(3))
        np.add.at(covered, (ra, rb), real[c])
    rows = side * LEAF_ROWS
    return value.transpose(0, 2, 1, 3).reshape(rows, rows), covered.repeat(LEAF_ROWS, 0).repeat(LEAF_ROWS, 1)


PAIR = "lang string, a int, b int, value long, covered long"


def _joint():
    """applyInArrow over one stripe of two tiles."""
    def run(t):
        if not pc.any(pc.equal(t.column("kind"), 1)).as_py():
            return pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64()), ("covered", pa.int64())]).empty_table()
        lang, ta, tb = (t.column(c)[0].as_py() for c in ("lang", "ta", "tb"))
        kind, g, p = (t.column(c).to_numpy() for c in ("kind", "g", "p"))
        cell = kind == 1
        term = pc.dictionary_encode(t.column("term").combine_chunks()).indices.to_numpy(zero_copy_only=False)[cell].astype(np.int64)
        total = t.column("total").to_numpy(zero_copy_only=False)[cell]
        # Frequent terms first, so that the rare ones leave whole quadrants empty.
        by_term = np.zeros(int(term.max()) + 1, np.int64)
        by_term[term] = total
        place = np.empty(len(by_term), np.int64)
        place[np.argsort(-by_term, kind="stable")] = np.arange(len(by_term))
        col, cols = place[term], len(by_term)
        tiles = {}
        for k in {ta, tb}:
            own = (kind == 0) & (g // TILE == k)
            zero = np.zeros(own.sum(), np.int64)
            zero[g[own] - k * TILE] = p[own]
            tiles[k] = zero
        blocks = max(-(-len(z) // LEAF_ROWS) for z in tiles.values()), -(-cols // LEAF_COLS)
        height = int(max(blocks) - 1).bit_length()
        made = {}
        for k, zero in tiles.items():
            own = g[cell] // TILE == k
            made[k] = Matrix(zero, height, g[cell][own] - k * TILE, col[own], p[cell][own])
        value, covered = joint_sums(made[ta], made[tb], height, cols, ta == tb)
        a, b = np.indices((len(tiles[ta]), len(tiles[tb])))
        value, covered = value[:a.shape[0], :a.shape[1]], covered[:a.shape[0], :a.shape[1]]
        keep = (covered > 0) & ((a < b) if ta == tb else True)
        return pa.table({"lang": pa.array([lang] * int(keep.sum()), pa.string()), "a": pa.array(a[keep] + ta * TILE, pa.int32()),
                         "b": pa.array(b[keep] + tb * TILE, pa.int32()), "value": pa.array(value[keep]), "covered": pa.array(covered[keep])})
    return run


def _weight(count, n, v):
    """p of a count among n with v kept terms."""
    return F.expr(f"1 + ({UNIT}BD * cast({count} + 2 as decimal(20,0))) div ({n} + 2 * {v})")


def _difference(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})))"


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other
    sources of each source's language, part ``term`` its ten terms that stand
    out most from the language."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    src = docs.select(name(lang_col).alias("lang"), name(source_col).alias("source"), name(text_col).cast("binary").alias("raw"))
    counted = src.mapInArrow(_counts(), CELL).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    cells = materialize(counted, "cells")
    kept = materialize(cells.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
                       .where(F.col("docs") >= LEAST_DOCS).select("lang", "term", "total"), "kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    cells = materialize(cells.drop("docs").join(kept, ["lang", "term"]), "kept-cells")
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = (src.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
              .withColumn("g", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int"))
              .select("lang", "source", "g", F.coalesce("group_n", F.lit(0)).alias("group_n"), F.coalesce("v", F.lit(0)).alias("v"),
                      F.coalesce("lang_n", F.lit(0)).alias("lang_n"))
              .withColumn("p0", F.when(F.col("v") > 0, _weight("0", "group_n", "v"))))
    groups = materialize(groups, "groups")
    weighed = (cells.join(groups.select("lang", "source", "g", "group_n", "v", "lang_n"), ["lang", "source"])
               .withColumn("p", _weight("n", "group_n", "v")))
    # The top quadrants: tiles of groups, stripes of terms.
    shape = groups.groupBy("lang").agg(F.max("v").alias("v"), (F.floor(F.max("g") / TILE) + 1).cast("int").alias("tiles"))
    shape = shape.where(F.col("v") > 0).select("lang", "tiles", F.ceil(F.col("v") / STRIPE).alias("stripes"))
    each = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    tile = F.floor(F.col("g") / TILE).cast("int")
    of_cells = (weighed.join(shape, "lang").select("lang", F.pmod(F.xxhash64("term"), "stripes").alias("stripe"), tile.alias("tile"), each,
                                                   F.lit(1).alias("kind"), "g", "p", "term", "total"))
    of_groups = (groups.join(shape, "lang").select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("stripes") - 1)).alias("stripe"),
                                                   tile.alias("tile"), "tiles", "g", "p0")
                 .select("lang", "stripe", "tile", each, F.lit(0).alias("kind"), "g", F.col("p0").alias("p"),
                         F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("total")))
    placed = (of_cells.unionByName(of_groups).withColumn("ta", F.least("tile", "other")).withColumn("tb", F.greatest("tile", "other"))
              .select("lang", "stripe", "ta", "tb", "kind", "g", "p", "term", "total"))
    walked = (placed.groupBy("lang", "stripe", "ta", "tb").applyInArrow(_joint(), PAIR)
              .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("covered").alias("covered")))
    one = groups.select("lang", "source", "g", "v", F.col("p0").alias("p"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("h"), F.col("p0").alias("q"))
    pairs = (one.join(other, "lang").where(F.col("g") != F.col("h"))
             .withColumn("a", F.least("g", "h")).withColumn("b", F.greatest("g", "h")).join(walked, ["lang", "a", "b"], "left")
             .withColumn("value", F.expr(f"coalesce(value, 0) + CASE WHEN v = 0 THEN 0 ELSE (v - coalesce(covered, 0)) * {_difference('p', 'q')} END")))
    terms = (weighed.withColumn("q", _weight("total", "lang_n", "v")).where(F.col("p") > F.col("q"))
             .withColumn("value", F.expr(_difference("p", "q"))))
    out = ("lang", "source", "part", "item", "value", "rank")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pairs.withColumns({"part": F.lit("pair"), "rank": place}).select(*out)
    terms = terms.withColumnRenamed("term", "item").withColumn("rank", place).where(F.col("rank") <= TOP_TERMS)
    return pairs.unionByName(terms.withColumn("part", F.lit("term")).select(*out))
