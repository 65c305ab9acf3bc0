"""Repeated-substring removal by prefix doubling over pruned positions.

Every byte covered by a ``LENGTH``-byte string that also starts in a document
with a smaller identifier is removed. Ranks are 64-bit fingerprints; equal
strings have equal ranks. Positions are ranked at growing lengths, and those
whose rank is unique drop out before the next one:

1. Length ``GRAM``. Of the grams in a window of ``LENGTH`` bytes the one with
   the smallest rank stands for the window, so equal windows have equal
   representatives. Neighbouring windows mostly share theirs: such a run of
   windows is one row. Tasks send each distinct rank once, Spark brings equal
   ranks together, and runs whose rank is found in one document only are done.
2. The whole run (``LENGTH`` bytes and more): Spark groups the pairs (gram
   rank, run rank). In a group all windows of later documents are repeats.
3. ``LENGTH``. Runs that agree in the gram but not as a whole are sorted by
   gram rank, and their windows' own ranks are compared within it.

A gram rank with more than ``CROWD`` different runs is not worked on in one
task: its windows are exploded and grouped by (gram rank, window rank).

Defined results: null and empty texts have 0 bytes. Matches never cross
documents; texts shorter than ``LENGTH`` lose nothing. Rows that repeat an
identifier are documents of their own and do not remove from each other. A
null identifier is smaller than any other. Of equal texts only the smallest
identifier's is searched; the others are covered as a whole. Empty tables give
empty tables; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.text import whole_text
from ledgermatch.llm.words import mix, numbers, utf8
from ledgermatch.session import materialize, release

LENGTH, GRAM = 50, 20
BLOCK_BYTES = 1 << 20         # bytes ranked at a time
TASK_BYTES = 24 << 20         # bytes of text whose ranks are sent together
BUCKET_BYTES = 16 << 20       # bytes of text per bucket of ranks
CROWD = 100_000
U64 = np.uint64


class Ranker:
    """Fingerprints of all substrings of a length; made once per task."""

    def __init__(self, block: int = BLOCK_BYTES, length: int = LENGTH, gram: int = GRAM):
        self.block, self.length, self.gram = block, length, gram
        base = 0x2545F4914F6CDD1D
        self.table = numbers(256, 11)
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._grow(block + 4 * length)

    def _grow(self, n: int) -> None:
        self.power, self.back = (np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(n, b, U64)]))
                                 for b in (self.base, self.inverse))

    def sums(self, raw: np.ndarray) -> np.ndarray:
        if len(raw) >= len(self.power):
            self._grow(2 * len(raw))
        out = np.zeros(len(raw) + 1, U64)
        np.cumsum(self.table[raw] * self.power[:len(raw)], out=out[1:])
        return out

    def ranks(self, total: np.ndarray, length: int) -> np.ndarray:
        """Rank of each substring of ``length`` bytes."""
        n = len(total) - length
        return mix((total[length:] - total[:n]) * self.back[:n] + U64(length))

    def ranks_at(self, total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((total[end] - total[start]) * self.back[start] + (end - start).astype(U64))

    def smallest(self, h: np.ndarray, width: int) -> np.ndarray:
        """Minimum of each ``width`` neighbours, by doubling."""
        done = 1
        while done * 2 <= width:
            h = np.minimum(h[:-done], h[done:])
            done *= 2
        return np.minimum(h[: len(h) - (width - done)], h[width - done:]) if width > done else h

    def runs(self, raw: np.ndarray, begins: np.ndarray, whole: bool):
        """Runs of windows with one representative in the texts of ``raw`` that
        start at ``begins``: (text number, first window from the text's start,
        windows, gram rank, run rank or None). A text longer than a block is
        cut into parts that overlap by a window less one byte, so each window
        is in one part; equal runs stay equal, since a run is what it covers.
        """
        ends = np.append(begins[1:], len(raw))
        out, lo = [], 0
        while lo < len(begins):
            hi = max(lo + 1, int(np.searchsorted(ends, begins[lo] + self.block, "right")))
            if hi == lo + 1 and ends[lo] - begins[lo] > self.block:
                for s in range(int(begins[lo]), int(ends[lo]) - self.length + 1, self.block):
                    part = raw[s: min(s + self.block + self.length - 1, int(ends[lo]))]
                    t, first, n, m, r = self._block(part, np.zeros(1, np.int64), whole)
                    out.append((t + lo, first + (s - begins[lo]), n, m, r))
            else:
                t, first, n, m, r = self._block(raw[begins[lo]: ends[hi - 1]], begins[lo:hi] - begins[lo], whole)
                out.append((t + lo, first, n, m, r))
            lo = hi
        join = lambda k: np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64)
        return join(0), join(1), join(2), join(3).astype(U64), join(4).astype(U64) if whole else None

    def _block(self, raw, begins, whole):
        if len(raw) < self.length:
            none = np.zeros(0, np.int64)
            return none, none, none, none.astype(U64), none.astype(U64) if whole else None
        total = self.sums(raw)
        m = self.smallest(self.ranks(total, self.gram), self.length - self.gram + 1)
        at = np.arange(len(m))
        text = np.searchsorted(begins, at, "right") - 1
        ends = np.append(begins[1:], len(raw))
        inside = at + self.length <= ends[text]
        new = np.ones(len(m), bool)
        new[1:] = (m[1:] != m[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
        start = np.flatnonzero(new & inside)
        stop = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True)) + 1
        run = self.ranks_at(total, start, stop + (self.length - 1)) if whole else None
        return text[start], start - begins[text[start]], stop - start, m[start], run


NOTE = "bucket int, m binary, id binary, ready binary"


def _notes(buckets: int, length: int, gram: int):
    """mapInArrow: per bucket the distinct gram ranks of this part of the
    input with one document each; ``ready`` marks ranks found in several
    documents here, whose rows (rank, document) are all sent."""
    def run(batches):
        ranker = Ranker(length=length, gram=gram)
        m_all, id_all, size = [], [], 0

        def out():
            m, ids = np.concatenate(m_all), np.concatenate(id_all)
            if not len(m):
                return
            order = np.lexsort((ids, m))
            m, ids = m[order], ids[order]
            keep = np.append(True, (m[1:] != m[:-1]) | (ids[1:] != ids[:-1]))
            m, ids = m[keep], ids[keep]
            alone = np.append(True, m[1:] != m[:-1]) & np.append(m[1:] != m[:-1], True)
            bucket = (m % U64(buckets)).astype(np.int64)
            order = np.lexsort((ids, bucket))
            m, ids, ready, bucket = m[order], ids[order], ~alone[order], bucket[order]
            edge = np.searchsorted(bucket, np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(edge)):
                s = slice(edge[k], edge[k + 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), *(pa.array([x[s].tobytes()], pa.binary()) for x in (m, ids, ready))],
                    names=["bucket", "m", "id", "ready"])

        for b in batches:
            raw, offsets = utf8(b.column("text"))
            ids = b.column("id").to_numpy()
            for lo in range(0, len(b), 256):
                hi = min(lo + 256, len(b))
                part = raw[offsets[lo]: offsets[hi]]
                text, _, _, m, _ = ranker.runs(part, offsets[lo:hi] - offsets[lo], False)
                m_all.append(m)
                id_all.append(ids[lo:hi][text])
                size += len(part)
                if size >= TASK_BYTES:
                    yield from out()
                    m_all, id_all, size = [], [], 0
        if m_all:
            yield from out()
    return run


def _repeated(table: pa.Table) -> pa.Table:
    """One bucket: (id, m) for gram ranks found in more than one document."""
    col = lambda c, t: np.frombuffer(b"".join(table.column(c).to_pylist()), t)
    m, ids, ready = col("m", U64), col("id", np.int64), col("ready", bool)
    order = np.lexsort((ids, m))
    m, ids, ready = m[order], ids[order], ready[order]
    first = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
    group = np.cumsum(np.append(True, m[1:] != m[:-1])) - 1
    last = np.append(first[1:], len(m)) - 1
    many = (ids[first] != ids[last])[group] | ready
    return pa.table({"id": ids[many], "m": m[many].view(np.int64)})


RUN = "m long, s long, id long, h long, first long, n int, bytes binary"


def _flagged_runs(length: int, gram: int):
    """mapInArrow: the runs whose gram rank is on the document's list, with
    their bytes where this batch has the run for the first time."""
    def run(batches):
        ranker = Ranker(length=length, gram=gram)
        for b in (x.slice(lo, 256) for x in batches for lo in range(0, len(x), 256)):
            raw, offsets = utf8(b.column("text"))
            if not len(b):
                continue
            text, first, n, m, s = ranker.runs(raw, offsets[:-1], True)
            keep = np.zeros(len(m), bool)
            edge = np.searchsorted(text, np.arange(len(b) + 1))
            for i, marks in enumerate(b.column("marks")):
                own = slice(edge[i], edge[i + 1])
                keep[own] = np.isin(m[own].view(np.int64), marks.values.to_numpy())
            at = np.flatnonzero(keep)
            fresh = np.zeros(len(at), bool)
            fresh[np.unique(np.stack([m[at], s[at]]), axis=1, return_index=True)[1]] = True
            begin = offsets[:-1][text[at]] + first[at]
            size = n[at] + length - 1
            strings = [raw[p: p + k].tobytes() if f else None for p, k, f in zip(begin, size, fresh)]
            ids, hs = (b.column(c).to_numpy()[text[at]] for c in ("id", "h"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(m[at].view(np.int64)), pa.array(s[at].view(np.int64)), pa.array(ids), pa.array(hs), pa.array(first[at]),
                 pa.array(n[at].astype(np.int32)), pa.array(strings, pa.binary())], names=["m", "s", "id", "h", "first", "n", "bytes"])
    return run


def _window_ranks(ranker: Ranker, strings: list[bytes]):
    """(string number, window number, rank) of all windows of the strings."""
    raw = np.frombuffer(b"".join(strings), np.uint8)
    size = np.array([len(x) for x in strings])
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    n = size - ranker.length + 1
    row = np.repeat(np.arange(len(strings)), n)
    j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = begin[row] + j
    return row, j, ranker.ranks_at(ranker.sums(raw), start, start + ranker.length)


def _intervals(row: np.ndarray, j: np.ndarray):
    """Runs of neighbouring windows: (row, first window, last window)."""
    if not len(row):
        return row, j, j
    new = np.append(True, (row[1:] != row[:-1]) | (j[1:] != j[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], j[first], j[last]


def _compared(length: int, gram: int):
    """mapInArrow over classes sorted by gram rank: (m, s, lo, hi), windows of
    a class that also start in a class of a smaller document."""
    def run(batches):
        ranker = Ranker(length=length, gram=gram)
        rest = None

        def work(t):
            row, j, w = _window_ranks(ranker, t.column("bytes").to_pylist())
            m, ids = t.column("m").to_numpy()[row], t.column("id").to_numpy()[row]
            order = np.lexsort((ids, w, m))
            new = np.append(True, (m[order][1:] != m[order][:-1]) | (w[order][1:] != w[order][:-1]))
            least = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            hit = np.sort(order[ids[order] > least])       # by row, then window
            r, lo, hi = _intervals(row[hit], j[hit])
            return pa.RecordBatch.from_arrays([pa.array(t.column("m").to_numpy()[r]), pa.array(t.column("s").to_numpy()[r]),
                                               pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], names=["m", "s", "lo", "hi"])

        for b in batches:
            if not len(b):
                continue
            t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            m = t.column("m").to_numpy()
            cut = int(np.searchsorted(m, m[-1], "left"))   # the last rank may go on
            if cut:
                yield work(t.slice(0, cut).combine_chunks())
            rest = t.slice(cut)
        if rest is not None and len(rest):
            yield work(rest.combine_chunks())
    return run


def _exploded(length: int, gram: int):
    """mapInArrow: classes as one row per window (m, w, id, s, j)."""
    def run(batches):
        ranker = Ranker(length=length, gram=gram)
        for b in (x.slice(lo, 1000) for x in batches for lo in range(0, len(x), 1000)):
            if len(b):
                row, j, w = _window_ranks(ranker, b.column("bytes").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.column("m").to_numpy()[row]), pa.array(w.view(np.int64)), pa.array(b.column("id").to_numpy()[row]),
                     pa.array(b.column("s").to_numpy()[row]), pa.array(j, pa.int64())], names=["m", "w", "id", "s", "j"])
    return run


def _removed(length: int):
    """mapInArrow: (id, no_id, n_bytes, n_removed, n_spans, kept)."""
    def run(batches):
        for b in (x.slice(lo, 256) for x in batches for lo in range(0, len(x), 256)):
            raw, offsets = utf8(b.column("text"))
            out = []
            for i, (copied, lo, hi) in enumerate(zip(*(b.column(c).to_pylist() for c in ("copied", "lo", "hi")))):
                text = raw[offsets[i]: offsets[i + 1]]
                size = len(text)
                if copied and size >= length:
                    out.append((size, size, 1, b""))
                    continue
                change = np.zeros(size + 1, np.int32)
                if lo:
                    np.add.at(change, np.array(lo), 1)
                    np.add.at(change, np.array(hi) + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                spans = int(np.count_nonzero(gone & ~np.append(False, gone[:-1]))) if size else 0
                out.append((size, int(gone.sum()), spans, text[~gone].tobytes()))
            n, removed, spans, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("no_id"), *(pa.array(x, pa.int64()) for x in (n, removed, spans)),
                                              pa.array(kept, pa.binary())], names=["id", "no_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   crowd: int = CROWD) -> DataFrame:
    """Per row: ``id_col``, n_bytes, n_removed, n_spans, kept binary (the
    remaining bytes, concatenated)."""
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("id"),
                      F.col(id_col).isNull().alias("no_id"), whole_text(text_col).alias("text"))
    src = src.withColumn("h", F.xxhash64("text"))
    # Later copies of a whole text: settled without looking at their positions.
    keys = materialize(src.select("id", "h", F.xxhash64("text", F.lit(1)).alias("h2"), F.octet_length("text").alias("size")), "keys")
    total = keys.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    first = (keys.groupBy("h", "h2", "size").agg(F.min("id").alias("least"), F.max("id").alias("most"))
             .where((F.col("least") < F.col("most")) & (F.col("size") >= length)))
    copies = materialize(keys.join(first, ["h", "h2", "size"]).where(F.col("id") > F.col("least")).select("id", "h").distinct(), "copies")

    todo = src.join(copies, ["id", "h"], "left_anti")
    buckets = max(1, -(-total // BUCKET_BYTES))
    notes = todo.select("id", "text").mapInArrow(_notes(buckets, length, gram), NOTE)
    marks = materialize(notes.groupBy("bucket").applyInArrow(_repeated, "id long, m long"), "marks")
    # A document's list is no longer than its own text.
    lists = marks.groupBy("id").agg(F.collect_set("m").alias("marks"))
    flagged = todo.join(lists, "id").select("id", "h", "text", "marks")
    runs = materialize(flagged.mapInArrow(_flagged_runs(length, gram), RUN), "runs")
    release(marks)

    classes = materialize(runs.groupBy("m", "s").agg(F.min("id").alias("id"), F.max("id").alias("most")), "classes")
    crowds = classes.groupBy("m").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1)
    strings = runs.where(F.col("bytes").isNotNull()).groupBy("m", "s").agg(F.max("bytes").alias("bytes"))
    several = classes.drop("most").join(crowds, "m").join(strings, ["m", "s"])
    near = (several.where(F.col("c") <= crowd).drop("c").repartition(n_parts, "m").sortWithinPartitions("m")
            .mapInArrow(_compared(length, gram), "m long, s long, lo long, hi long"))
    windows = several.where(F.col("c") > crowd).drop("c").mapInArrow(_exploded(length, gram), "m long, w long, id long, s long, j long")
    least = windows.groupBy("m", "w").agg(F.min("id").alias("least"))
    far = (windows.join(least, ["m", "w"]).where(F.col("id") > F.col("least"))
           .select("m", "s", F.col("j").alias("lo"), F.col("j").alias("hi")))
    partial = materialize(near.unionByName(far).groupBy("m", "s").agg(F.collect_list(F.struct("lo", "hi")).alias("windows")), "partial")
    verdict = (classes.join(partial, ["m", "s"], "left").where((F.col("id") < F.col("most")) | F.col("windows").isNotNull())
               .select("m", "s", F.col("id").alias("least"), "windows"))
    found = (runs.select("m", "s", "id", "h", "first", "n").join(verdict, ["m", "s"])
             .withColumn("windows", F.when(F.col("id") > F.col("least"),
                                           F.array(F.struct(F.lit(0).cast("long").alias("lo"), (F.col("n") - 1).cast("long").alias("hi"))))
                         .otherwise(F.col("windows")))
             .select("id", "h", "first", F.explode("windows").alias("w"))
             .select("id", "h", (F.col("first") + F.col("w.lo")).alias("lo"), (F.col("first") + F.col("w.hi")).alias("hi")))
    by_doc = found.groupBy("id", "h").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi")).withColumn("copied", F.lit(False))
    none = F.lit(None).cast("array<bigint>")
    fate = materialize(by_doc.unionByName(copies.select("id", "h", none.alias("lo"), none.alias("hi"), F.lit(True).alias("copied"))), "fate")
    for table in (keys, copies, runs, classes, partial):
        release(table)
    out = (src.join(fate, ["id", "h"], "left").select("id", "no_id", "text", "copied", "lo", "hi")
           .mapInArrow(_removed(length), "id long, no_id boolean, n_bytes long, n_removed long, n_spans long, kept binary"))
    return out.select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    return remove_repeats(docs, id_col, text_col, **kw).select(
        id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
