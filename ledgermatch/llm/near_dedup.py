"""Near-duplicate groups by an LSH forest over MinHash signatures.

A document's set is its distinct shingles of four words (64-bit hashes).
Documents with equal sets are one class. Each class has a signature of
``TREES * DEPTH`` minima. A tree of the forest orders the classes by its
``DEPTH`` minima in turn; a region is a run with a common prefix of the least
depth. Candidates are the nearest neighbours in this order (no others have a
longer common prefix), and each class with its region's centre, which lies in
the branch that is most crowded at the next depths. A region of up to
``REACH`` classes is compared completely in this way.

Candidates are confirmed on whole sets. First each class is compared with the
centre and the partner that it meets in most trees; links found make
components. Then all candidates that are still in different components are
compared. A pair inside a component needs no comparison: it cannot change the
result. Last, every larger region (and one that lies in two partitions) is
compared completely between the components that are left in it. Its classes go
to blocks with their sets; the largest component's classes meet only the blocks
of the others. A task holds two blocks, counts all intersections exactly, and
returns a link only where it joins two components that the task has not joined
yet: fewer links than classes, however many pairs are alike. The comparisons
there grow with the square of the classes outside the largest component, the
rows shipped with that square over the block size.

Least depth 4 in 24 trees: a pair at similarity 0.8 shares no region with a
probability of (1 - 0.8^4)^24 = 3e-6.

Defined results: null and empty texts and texts without words have empty sets,
no links and a component of their own. A text of fewer than four words has its
whole word sequence as its one shingle. Rows that repeat an identifier stay rows
of their own, whatever their texts: sets are matched by their own key, never by
an identifier alone. A null identifier never names a group while the group has
another; a group of null identifiers alone has a null name. ``near_dedup``
keeps one row of each group: the smallest identifier's (nulls last), of equal
ones the one with the smallest set key, of equal sets any one; rows without
words all stay. Empty tables give empty tables; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.components import components
from ledgermatch.llm.words import WordHasher, mix, numbers
from ledgermatch.session import materialize

SHINGLE = 4
PERCENT = 80
TREES, DEPTH, LEAST_DEPTH = 24, 6, 4
REACH = 8             # rows before it in its region that a row is compared with, per tree
BLOCK, BLOCK_SHINGLES = 512, 1 << 20    # classes of a larger region, and their shingles, in a block
COLUMNS = 4096        # shingles whose occurrences in two blocks are multiplied at a time
HOPEFUL = 0.6         # share of equal minima below which a pair is not compared (five deviations below 0.8)
U64 = np.uint64


def shingle_sets(hashes: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of words."""
    factor = numbers(width + 1, 5) | U64(1)
    n = len(hashes)
    rolled = np.zeros(max(0, n - width + 1), U64)
    for k in range(width):
        rolled += hashes[k: n - width + 1 + k] * factor[k] if len(rolled) else U64(0)
    rolled = mix(rolled)
    out = []
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        if hi - lo >= width:
            out.append(np.unique(rolled[lo: hi - width + 1]))
        elif hi > lo:   # fewer words: the whole sequence, marked by its length
            whole = np.append(hashes[lo:hi], U64(hi - lo)) * np.append(factor[: hi - lo], factor[width])
            out.append(mix(whole.sum(dtype=U64, keepdims=True)))
        else:
            out.append(np.zeros(0, U64))
    return out


def _signatures(width: int, trees: int, depth: int):
    """mapInArrow: per row the set's size, its 128-bit key and its minima."""
    def run(batches):
        hasher = WordHasher()
        factor, turn = numbers(trees * depth, 6) | U64(1), numbers(trees * depth, 7)
        for b in batches:
            for row, hashes, offsets in hasher.blocks(b.column("text")):
                sets = shingle_sets(hashes, offsets, width)
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                key = set_key(sets)
                minima = np.zeros((len(n), trees * depth), np.uint32)
                if len(full):
                    u = np.concatenate(sets)
                    first = np.concatenate([[0], np.cumsum(n[full])[:-1]])
                    for k in range(trees * depth):
                        minima[full, k] = np.minimum.reduceat((u ^ turn[k]) * factor[k], first) >> U64(32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(row, len(n)), pa.array(n, pa.int64()),
                     pa.array([k.tobytes() for k in key], pa.binary()), pa.array([m.tobytes() for m in minima], pa.binary())],
                    names=["id", "n", "key", "sig"])
    return run


def _prefixes(m: np.ndarray):
    """The hashes of the first 1, 2, ... minima of each tree, from (rows, trees, depth) minima."""
    h = np.broadcast_to(numbers(m.shape[1], 8), m.shape[:2]).copy()
    for d in range(m.shape[2]):
        h = mix(h * U64(0x9E3779B97F4A7C15) + m[:, :, d].astype(U64))
        yield h


def _trees(trees: int, depth: int, least: int):
    """mapInArrow: a row per tree: the hashes of the prefixes of the least
    depth, of one more, and of the full depth."""
    marks = (least, min(least + 1, depth), depth)

    def run(batches):
        for b in (x.slice(lo, 200) for x in batches for lo in range(0, len(x), 200)):
            m = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(len(b), trees, depth)
            found = []
            for d, h in enumerate(_prefixes(m)):
                if d + 1 in marks:
                    found += [h.ravel().view(np.int64)] * marks.count(d + 1)
            again = pa.array(np.repeat(np.arange(len(b)), trees))
            yield pa.RecordBatch.from_arrays([pa.array(f) for f in found] + [b.column(c).take(again) for c in ("key", "n")],
                                             names=["h1", "h2", "h3", "key", "n"])
    return run


TREE_ROW = "h1 long, h2 long, h3 long, key binary, n long"


def _could_link(a, b, percent: int):
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


FOUND = "kind int, a binary, b binary, h1 long, h2 long, h3 long, n long"


def _neighbours(percent: int, reach: int):
    """mapInArrow over a sorted partition. Kind 0: candidate pairs of a row and
    the ``reach`` rows before it in its region; with so many rows before it
    there, the row just before it alone (``_across`` has the others). Kind 1: the rows of regions
    with several rows (and the partition's first and last row, whose region
    may go on in another partition)."""
    def rows(kind, a, b, *numbers_of):
        m = len(a)
        longs = [pa.array(x, pa.int64()) for x in numbers_of] or [pa.nulls(m, pa.int64())] * 4
        return pa.RecordBatch.from_arrays([pa.array([kind] * m, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary()), *longs],
                                          names=["kind", "a", "b", "h1", "h2", "h3", "n"])

    def run(batches):
        key, nums, met = np.zeros(0, object), np.zeros((4, 0), np.int64), np.zeros(0, bool)   # the rows before
        last = None
        for t in batches:
            if not len(t):
                continue
            old = len(key)
            key = np.append(key, np.array(t.column("key").to_pylist(), dtype=object))
            nums = np.concatenate([nums, np.stack([t.column(c).to_numpy() for c in ("h1", "h2", "h3", "n")])], axis=1)
            h, n = nums[0], nums[3]
            for d in range(1, min(reach, len(key) - 1) + 1):
                at = np.arange(max(old, d), len(key))
                at = at[(h[at] == h[at - d]) & _could_link(n[at], n[at - d], percent)]
                at = at[~((at >= reach) & (h[at - reach] == h[at]) & (d > 1))]
                x, y = key[at], key[at - d]
                ok = x != y
                yield rows(0, np.minimum(x, y)[ok], np.maximum(x, y)[ok])
            # Rows with a neighbour in their region; the last one waits for the next batch.
            same = np.append(False, h[1:] == h[:-1])
            met = np.append(met, np.zeros(len(key) - old, bool)) | same | np.append(same[1:], False)
            met[0] |= last is None
            send = np.arange(max(old - 1, 0), len(key) - 1)
            send = send[met[send]]
            yield rows(1, key[send], key[send], *nums[:, send])
            last = (key[-1], nums[:, -1])
            key, nums, met = key[-reach - 1:], nums[:, -reach - 1:], met[-reach - 1:]
        if last is not None:
            yield rows(1, [last[0]], [last[0]], *last[1].reshape(4, 1))
    return run


def set_key(sets: list[np.ndarray]) -> np.ndarray:
    """The 128-bit key of each set, zero for the empty set."""
    n = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(n)
    key = np.zeros((len(n), 2), U64)
    if len(full):
        u = np.concatenate(sets)
        first = np.concatenate([[0], np.cumsum(n[full])[:-1]])
        key[full, 0] = np.add.reduceat(mix(u), first)
        key[full, 1] = np.add.reduceat(mix(u ^ U64(0xA5A5A5A5A5A5A5A5)), first) + n[full].astype(U64)
    return key


def _sets(width: int):
    """mapInArrow: (key, set) with the sorted shingle hashes as bytes."""
    def run(batches):
        hasher = WordHasher()
        for b in batches:
            for _, hashes, offsets in hasher.blocks(b.column("text")):
                sets = shingle_sets(hashes, offsets, width)
                yield pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in set_key(sets)], pa.binary()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "set"])
    return run


def _keyed(width: int, text: str):
    """mapInArrow: the rows with their set's key and size in place of ``text``."""
    def run(batches):
        hasher = WordHasher()
        for b in batches:
            rest = [i for i, f in enumerate(b.schema.names) if f != text]
            for row, hashes, offsets in hasher.blocks(b.column(text)):
                sets = shingle_sets(hashes, offsets, width)
                part = b.slice(row, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in rest] + [pa.array([k.tobytes() for k in set_key(sets)], pa.binary()), pa.array([len(s) for s in sets], pa.int64())],
                    names=[b.schema.names[i] for i in rest] + ["__key", "__n"])
    return run


def _confirm(percent: int):
    """mapInArrow: the pairs whose whole sets are similar enough."""
    def run(batches):
        for t in (x.slice(lo, 200) for x in batches for lo in range(0, len(x), 200)):
            ok = []
            for x, y in zip(t.column("set_a").to_pylist(), t.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([t.column("a").take(keep), t.column("b").take(keep)], names=["a", "b"])
    return run


def intersections(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``one`` shares with each of ``other``."""
    sides = []
    for sets in (one, other):
        sides.append((np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])))
    shared = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]), assume_unique=True)
    found = np.zeros((len(one), len(other)), np.int64)
    place = []
    for u, row in sides:
        at = np.minimum(np.searchsorted(shared, u), max(len(shared) - 1, 0))
        here = shared[at] == u if len(shared) else np.zeros(len(u), bool)
        by = np.argsort(at[here], kind="stable")
        place.append((at[here][by], row[here][by]))
    for lo in range(0, len(shared), COLUMNS):
        part = []
        for (at, row), n in zip(place, found.shape):
            i, j = np.searchsorted(at, (lo, lo + COLUMNS))
            m = np.zeros((n, min(COLUMNS, len(shared) - lo)), np.float32)
            m[row[i:j], at[i:j] - lo] = 1
            part.append(m)
        found += np.rint(part[0] @ part[1].T).astype(np.int64)
    return found


LINK = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _join_blocks(percent: int):
    """applyInArrow over two blocks of a region: links that join components."""
    def run(t):
        i, j = (t.column(c)[0].as_py() for c in ("i", "j"))
        key, block = t.column("key").to_pylist(), t.column("block").to_numpy()
        comp = np.unique(np.array(t.column("comp").to_pylist(), dtype=object), return_inverse=True)[1]
        sets = [np.frombuffer(x, U64) for x in t.column("set").to_pylist()]
        x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(x) or not len(y):
            return LINK.empty_table()
        both = intersections([sets[k] for k in x], [sets[k] for k in y])
        n = np.array([len(s) for s in sets])
        a, b = np.nonzero((100 * both >= percent * (n[x][:, None] + n[y][None, :] - both)) & (comp[x][:, None] != comp[y][None, :]))
        a, b = x[a], y[b]
        # One link per pair of components, then those of them that make a forest.
        low, high = np.minimum(comp[a], comp[b]), np.maximum(comp[a], comp[b])
        first = np.unique(low * (comp.max() + 1) + high, return_index=True)[1]
        up = list(range(int(comp.max()) + 1))

        def root(c):
            while up[c] != c:
                up[c] = up[up[c]]
                c = up[c]
            return c

        out = []
        for k in first.tolist():
            p, q = root(low[k]), root(high[k])
            if p != q:
                up[p] = q
                out.append((key[a[k]], key[b[k]]))
        return pa.table({"a": pa.array([o[0] for o in out], pa.binary()), "b": pa.array([o[1] for o in out], pa.binary())})
    return run


def _hopeful(least: float):
    """mapInArrow: the pairs whose signatures agree in at least this share."""
    def run(batches):
        for t in (x.slice(lo, 500) for x in batches for lo in range(0, len(x), 500)):
            a = np.frombuffer(b"".join(t.column("sig_a").to_pylist()), np.uint32).reshape(len(t), -1)
            b = np.frombuffer(b"".join(t.column("sig_b").to_pylist()), np.uint32).reshape(len(t), -1)
            keep = pa.array(np.flatnonzero((a == b).mean(axis=1) >= least) if len(t) else [], pa.int64())
            yield pa.RecordBatch.from_arrays([t.column("a").take(keep), t.column("b").take(keep)], names=["a", "b"])
    return run


def _with_both(pairs: DataFrame, table: DataFrame, col: str) -> DataFrame:
    a = table.select(F.col("key").alias("a"), F.col(col).alias(f"{col}_a"))
    b = table.select(F.col("key").alias("b"), F.col(col).alias(f"{col}_b"))
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", f"{col}_a", f"{col}_b")


def _told(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): per row id, n, key; per set that is not empty its key,
    the smallest identifier (rep) and the key that names its component (comp)."""
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(src.mapInArrow(_signatures(width, TREES, DEPTH), "id long, n long, key binary, sig binary"), "signed")
    # One class per distinct set, named by its key; copies are combined before the shuffle.
    classes = materialize(signed.where(F.col("n") > 0).groupBy("key").agg(
        F.min("id").alias("rep"), F.max("n").alias("n"), F.max("sig").alias("sig")), "classes")

    orders = (classes.mapInArrow(_trees(TREES, DEPTH, LEAST_DEPTH), TREE_ROW)
              .repartitionByRange(n_parts, "h1", "h2", "h3", "key").sortWithinPartitions("h1", "h2", "h3", "key"))
    found = materialize(orders.mapInArrow(_neighbours(percent, REACH), FOUND).withColumn("pid", F.spark_partition_id()), "found")
    # A region's centre: in its most crowded branch of the next depth, the most
    # crowded branch below, the smallest class.
    members = found.where(F.col("kind") == 1).select(F.col("a").alias("key"), "h1", "h2", "h3", "n", "pid")
    leaf = members.groupBy("h1", "h2", "h3").agg(F.count(F.lit(1)).alias("c3"), F.min(F.struct("key", "n")).alias("k"))
    branch = leaf.groupBy("h1", "h2").agg(F.sum("c3").alias("c2"), F.max(F.struct("c3", "k")).alias("k"))
    centre = (branch.groupBy("h1").agg(F.sum("c2").alias("c"), F.max(F.struct("c2", "k")).alias("k")).where(F.col("c") > 1)
              .select("h1", F.col("k.k.k.key").alias("centre"), F.col("k.k.k.n").alias("cn")))
    stars = (members.join(centre, "h1").where((F.col("key") != F.col("centre"))
                                              & (100 * F.least("n", "cn") >= percent * F.greatest("n", "cn")))
             .select(F.lit(1).alias("kind"), F.least("key", "centre").alias("a"), F.greatest("key", "centre").alias("b")))
    candidates = materialize(found.where(F.col("kind") == 0).select("kind", "a", "b").unionByName(stars)
                             .groupBy("a", "b").agg(F.sum("kind").alias("star"), F.count(F.lit(1)).alias("met")), "candidates")
    # Each class with the centre it meets most and the partner it meets most.
    sided = candidates.select("a", "b", "star", "met", F.explode(F.array("a", "b")).alias("x"))
    best = sided.groupBy("x").agg(F.max(F.struct("star", "met", "a", "b")).alias("p"), F.max(F.struct("met", "a", "b")).alias("q"))
    first_pairs = materialize(best.select(F.explode(F.array(F.struct("p.a", "p.b"), F.struct("q.a", "q.b"))).alias("p"))
                              .select("p.*").distinct(), "first-pairs")

    # Larger regions, and those in two partitions: their neighbours are not all pairs.
    large = (members.groupBy("h1").agg(F.count(F.lit(1)).alias("c"), F.min("pid").alias("p"), F.max("pid").alias("q"))
             .where((F.col("c") > REACH) | (F.col("p") != F.col("q")) & (F.col("c") > 1)).select("h1"))
    crowds = materialize(members.select("h1", "key", "n").join(large, "h1"), "crowds")
    involved = materialize(candidates.select(F.explode(F.array("a", "b")).alias("key")).unionByName(crowds.select("key")).distinct()
                           .join(classes, "key").select("key", "rep", "n", "sig"), "involved")
    # Whole sets of the involved classes only: the texts of their smallest
    # identifiers (and those without one) are read again, and a set counts for
    # the class whose key it has.
    owners = involved.select(F.col("rep").alias("id")).where(F.col("id").isNotNull()).distinct()
    nameless = involved.where(F.col("rep").isNull()).select("key")
    own = src.join(owners, "id", "left_semi").mapInArrow(_sets(width), "key binary, set binary")
    others = src.where(F.col("id").isNull()).mapInArrow(_sets(width), "key binary, set binary").join(nameless, "key", "left_semi")
    sets = materialize(own.join(involved.select("key"), "key", "left_semi").unionByName(others).dropDuplicates(["key"]), "sets")

    def confirmed(pairs):
        return _with_both(pairs, sets, "set").mapInArrow(_confirm(percent), "a binary, b binary")

    links = materialize(confirmed(first_pairs), "links")
    comp = components(links)
    # Candidates that would still join two components are compared as well.
    here = involved.select("key").join(comp.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    cross = (candidates.select("a", "b").join(here.select(F.col("key").alias("a"), F.col("comp").alias("ca")), "a")
             .join(here.select(F.col("key").alias("b"), F.col("comp").alias("cb")), "b").where(F.col("ca") != F.col("cb"))
             .select("a", "b").join(first_pairs, ["a", "b"], "left_anti"))
    second = materialize(_with_both(cross, involved, "sig").mapInArrow(_hopeful(HOPEFUL), "a binary, b binary"), "second-pairs")
    links = materialize(links.unionByName(confirmed(second)), "links")
    # The components that are left in a larger region, block by block.
    comp = components(links).withColumnRenamed("node", "key")
    told = materialize(crowds.join(comp, "key", "left").withColumn("comp", F.coalesce("comp", "key")), "told")
    per_comp = told.groupBy("h1", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    blocks_of = lambda c, s: F.ceil(F.greatest(c / BLOCK, s / BLOCK_SHINGLES)).cast("int")
    regions = (per_comp.groupBy("h1").agg(F.count(F.lit(1)).alias("comps"), F.sum("c").alias("c"), F.sum("s").alias("s"),
                                          F.max(F.struct("c", "s", "comp")).alias("top")).where(F.col("comps") > 1)
               .select("h1", F.col("top.comp").alias("top"), blocks_of(F.col("c") - F.col("top.c"), F.col("s") - F.col("top.s")).alias("few"),
                       blocks_of(F.col("top.c"), F.col("top.s")).alias("many")))
    within = lambda n: F.pmod(F.xxhash64("key"), n).cast("int")
    inside = F.col("comp") == F.col("top")
    # Blocks 0 to few - 1 are of the smaller components, the rest of the largest one; two blocks of the largest need not meet.
    placed = (told.join(regions, "h1").withColumn("block", F.when(inside, F.col("few") + within(F.col("many"))).otherwise(within(F.col("few"))))
              .withColumn("with", F.explode(F.sequence(F.lit(0), F.when(inside, F.col("few")).otherwise(F.col("few") + F.col("many")) - 1)))
              .select("h1", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "key", "comp"))
    across = placed.join(sets, "key").groupBy("h1", "i", "j").applyInArrow(_join_blocks(percent), "a binary, b binary")
    groups = components(materialize(links.unionByName(across), "all-links")).withColumnRenamed("node", "key")
    named = classes.select("key", "rep").join(groups, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    return signed.select("id", "n", "key"), named


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                percent: int = PERCENT) -> DataFrame:
    """Per row: ``id_col``, n_shingles, component_id, kept."""
    rows, classes = _told(docs, id_col, text_col, width, percent)
    smallest = classes.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of_class = classes.join(smallest, "comp").select("key", "component_id")
    # Hot classes are a skewed join, which adaptive execution splits.
    out = rows.join(of_class, "key", "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group."""
    rows, classes = _told(docs, id_col, text_col, width, percent)
    first = classes.groupBy("comp").agg(F.min(F.struct(F.col("rep").isNull().alias("nameless"), "rep", "key")).alias("w")).select("w.key", "w.rep")
    winners = first.withColumnRenamed("rep", "__id").unionByName(
        rows.where(F.col("n") == 0).select("key", F.col("id").alias("__id")).distinct()).withColumnRenamed("key", "__k")
    again = rows.groupBy("id").agg((F.count(F.lit(1)) > 1).alias("__again")).withColumnRenamed("id", "__i")
    winners = materialize(winners.join(again, F.col("__id").eqNullSafe(F.col("__i"))).select("__id", "__k", "__again"), "winners")
    # A row whose identifier occurs once is found by it, any other by its set as well.
    once = winners.where(~F.col("__again")).select("__id")
    plain = docs.join(once, docs[id_col].eqNullSafe(once["__id"]), "left_semi")
    ids = winners.where("__again").select("__id").distinct()
    repeated = docs.join(ids, docs[id_col].eqNullSafe(ids["__id"]), "left_semi").withColumn("__text", F.col(text_col).cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", __key binary, __n long"
    keyed = repeated.mapInArrow(_keyed(width, "__text"), schema)
    chosen = winners.where("__again").select("__id", "__k").distinct()
    keyed = keyed.join(chosen, keyed[id_col].eqNullSafe(chosen["__id"]) & (keyed["__key"] == chosen["__k"]), "left_semi")
    one = keyed.where(F.col("__n") > 0).dropDuplicates([id_col, "__key"]).unionByName(keyed.where(F.col("__n") == 0))
    return plain.unionByName(one.drop("__key", "__n"))
