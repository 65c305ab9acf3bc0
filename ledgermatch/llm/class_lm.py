"""LM scoring with a Brown class-based bigram model.

Words (lower-cased A-Z, split at white space, one end token per text) are
counted over all training documents. The ``VOCAB`` most frequent words get
classes by exchange clustering. It starts from sequential exchange among the
``CORE`` most frequent words and a first class for each other one by its core
neighbours. Then sweeps move all vocabulary words on all bigrams of the corpus,
those with rare words and text ends included: a pass over the encoded texts
gives every word's counts of the classes before and after it, and each word
goes to the class with the largest exchange gain. A sweep moves every other
word, so that two words do not follow each other; the classes with the highest
likelihood met are kept. The number of classes grows with the logarithm of the
distinct words.

The words beyond the vocabulary are clustered where they are, in a table with a
row per word: its counts of the classes before it. They start in classes of
their spelling and are exchanged in turns, every other word a turn, against the
class pair counts of the turn before. Words seen once stay with the unseen ones
in the spelling classes. A class bigram has two maps of words to classes here:
the word that follows counts by its class, the word before by its class if it
is in the vocabulary and by its spelling if not.

The score is the sum over a text's tokens of log10 of class transition times
word emission; a word's emission is its count (plus 0.1 beyond the vocabulary)
over the sum of its class.

Bounded: the vocabulary, its bigram matrix and the class matrices, which the
driver holds and tasks receive. Not bounded, and never gathered: the words
beyond the vocabulary with their counts, contexts and classes, which meet the
texts' words in a join.

Defined results: null and empty texts are the end token alone. A null
identifier is neither held out nor learned from. Each input row gives one
output row, so repeated rows give equal rows. Without a training token N and V
are 0 and the scores follow from the formulas. Empty tables give empty tables;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.words import WordHasher, mix
from ledgermatch.session import materialize, release

VOCAB = 50000        # words with a clustered class
CORE = 1000          # words of the sequential exchange that the sweeps start from
BATCH_SWEEPS = 4     # sweeps over all vocabulary words, each over every other one
HELD = 2_000_000     # context counts that a task holds before it sends them on
CLASSES = 2.0        # clustered classes for each doubling of the distinct words
RARE_TURNS = 2       # exchange turns of the words beyond the vocabulary, each over every other one
SHAPES = 8           # spelling classes (the hashes' low three bits)
ROWS = 1000          # encoded rows worked on together
SWEEPS = 6
ADD_WORD, ADD_CLASS = 0.1, 0.5
END = 1              # the end token's hash


def _count_words(batches):
    """mapInArrow: (word hash, count) of this task's training texts."""
    hasher, parts, size, ends = WordHasher(spelled=True), [], 0, 0
    names = ["h", "n"]

    def out(parts):
        # Sums of a task's blocks; merged whenever they have grown large.
        h = np.concatenate([p[0] for p in parts])
        order = np.argsort(h, kind="stable")
        h, n = h[order], np.concatenate([p[1] for p in parts])[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        return h[first], np.add.reduceat(n, first)

    for b in batches:
        ends += len(b)
        for _, hashes, _ in hasher.blocks(b.column("text")):
            if len(hashes):
                h, n = np.unique(hashes, return_counts=True)
                parts.append((h, n.astype(np.int64)))
                size += len(h)
            if size > 2_000_000:
                parts = [out(parts)]
                size = len(parts[0][0])
                if size > 1_000_000:
                    yield _rows(parts[0], names)
                    parts, size = [], 0
    if ends:
        parts.append((np.array([END], np.uint64), np.array([ends], np.int64)))
        yield _rows(out(parts), names)


def _rows(arrays, names):
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64) if a.dtype == np.uint64 else a) for a in arrays], names=names)


@dataclass
class Vocabulary:
    """Sorted hashes of the frequent words with their counts (by hash order)
    and their places by frequency (0: most frequent)."""
    hashes: np.ndarray
    counts: np.ndarray
    place: np.ndarray

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``hashes``, whether the word is there)."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        i = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return i, self.hashes[i] == h


def _encode(vocab: Vocabulary):
    """mapInArrow: each text as frequency places (uint16; len(vocab): rare)
    and the hashes of its rare words in order."""
    rare_place = len(vocab.hashes)

    def run(batches):
        hasher = WordHasher(spelled=True)
        for b in batches:
            places, rare = [], []
            for _, hashes, offsets in hasher.blocks(b.column("text")):
                i, known = vocab.look_up(hashes)
                p = np.where(known, vocab.place[i] if rare_place else 0, rare_place).astype("<u2")
                for lo, hi in zip(offsets[:-1], offsets[1:]):
                    places.append(p[lo:hi].tobytes())
                    rare.append(hashes[lo:hi][~known[lo:hi]].tobytes())
            keep = [i for i, f in enumerate(b.schema.names) if f != "text"]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + [pa.array(places, pa.binary()), pa.array(rare, pa.binary())],
                                             names=[b.schema.names[i] for i in keep] + ["places", "rare"])
    return run


def _streams(batches, dtype="<u2"):
    """Per ``ROWS`` rows: (rows, all their places in one array, row offsets)."""
    for b in (x.slice(lo, ROWS) for x in batches for lo in range(0, len(x), ROWS)):
        col = b.column("places")
        _, off, data = col.buffers()
        off = np.frombuffer(off, np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None else np.zeros(0, np.uint8)
        yield b, raw.view(dtype), (off - off[0]) // 2


def _summed(keys: list[np.ndarray]):
    k, n = np.unique(np.concatenate(keys), return_counts=True)
    return k.astype(np.int64), n.astype(np.int64)


def _core_bigrams(core: int):
    """mapInArrow: counts of neighbouring pairs of core words."""
    def run(batches):
        for _, p, off in _streams(batches):
            if len(p) < 2:
                continue
            inner = np.ones(len(p) - 1, bool)
            inner[off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(p))] - 1] = False
            both = inner & (p[:-1] < core) & (p[1:] < core)
            yield _rows(_summed([p[:-1][both].astype(np.int64) * core + p[1:][both]]), ["k", "n"])
    return run


def _contexts(core: int, classes: np.ndarray, n_classes: int, rare: int):
    """mapInArrow: for vocabulary words beyond the core, counts of the class
    of the core word before (0..) and after (n_classes..)."""
    def run(batches):
        for _, p, off in _streams(batches):
            if len(p) < 2:
                continue
            inner = np.ones(len(p) - 1, bool)
            inner[off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(p))] - 1] = False
            a, b = p[:-1].astype(np.int64), p[1:].astype(np.int64)
            before = inner & (a < core) & (b >= core) & (b < rare)
            after = inner & (b < core) & (a >= core) & (a < rare)
            width = 2 * n_classes
            yield _rows(_summed([b[before] * width + classes[a[before]], a[after] * width + n_classes + classes[b[after]]]), ["k", "n"])
    return run


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def exchange(n: np.ndarray, n_classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of the words of the bigram count matrix ``n`` by exchange: each
    word in turn goes to the class that raises the class bigram likelihood
    most, until a sweep moves none."""
    words = len(n)
    cls = np.arange(words) % n_classes
    one = np.zeros((words, n_classes))
    one[np.arange(words), cls] = 1
    right, left = n @ one, n.T @ one          # word's counts by class after / before
    pair = one.T @ right
    uni_r, uni_l = n.sum(1), n.sum(0)
    tot_r, tot_l = one.T @ uni_r, one.T @ uni_l
    diag = np.arange(n_classes)
    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            c, own = cls[w], n[w, w]
            r, lf = right[w].copy(), left[w].copy()
            r[c] -= own
            lf[c] -= own                       # contexts without the word itself
            pair[c, :] -= r
            pair[:, c] -= lf
            pair[c, c] -= own
            tot_r[c] -= uni_r[w]
            tot_l[c] -= uni_l[w]
            row = _xlogx(pair + r) - _xlogx(pair)
            col = _xlogx(pair + lf[:, None]) - _xlogx(pair)
            corner = pair[diag, diag]
            gain = (row.sum(1) - row[diag, diag] + col.sum(0) - col[diag, diag]
                    + _xlogx(corner + r + lf + own) - _xlogx(corner)
                    - _xlogx(tot_r + uni_r[w]) + _xlogx(tot_r) - _xlogx(tot_l + uni_l[w]) + _xlogx(tot_l))
            best = int(gain.argmax())
            if gain[best] <= gain[c] + 1e-9:
                best = int(c)
            pair[best, :] += r
            pair[:, best] += lf
            pair[best, best] += own
            tot_r[best] += uni_r[w]
            tot_l[best] += uni_l[w]
            if best != c:
                moved += 1
                cls[w] = best
                right[:, c] -= n[:, w]
                right[:, best] += n[:, w]
                left[:, c] -= n[w, :]
                left[:, best] += n[w, :]
        if not moved:
            break
    return cls


def place_by_context(contexts: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Class of each row of ``contexts`` (counts of classes before, then
    after): the one that gives these contexts the highest likelihood."""
    k = len(pair)
    smooth = pair + ADD_CLASS
    after = np.log(smooth / smooth.sum(1, keepdims=True))            # [class, next]
    before = np.log(smooth / smooth.sum(0, keepdims=True)).T         # [class, previous]
    return (contexts[:, k:] @ after.T + contexts[:, :k] @ before.T).argmax(1)


def _aligned_words(p, c, ends, size, n_classes):
    """The words of a class stream: vocabulary places, size + spelling for rare words, the last number for text ends."""
    inside = np.ones(len(c), bool)
    inside[ends] = False
    w = size + c - n_classes
    w[inside] = np.where(p == size, w[inside], p)
    return w


def _word_contexts(classes, n_classes: int, size: int):
    """mapInArrow: for every word (rare words by spelling) the counts of the
    classes before it (0..) and after it (total..), and of itself after itself
    (2 total), combined over a task's rows."""
    total = n_classes + SHAPES + 1
    width = 2 * total + 1

    def merged(parts):
        k, n = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(k, kind="stable")
        k, n = k[order], n[order]
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        return k[first], np.add.reduceat(n, first)

    def run(batches):
        parts, held = [], 0
        for b, p, off in _streams(batches):
            if not len(b):
                continue
            c, ends, _ = _class_stream(classes, n_classes, b, p, off, size)
            w = _aligned_words(p, c, ends, size, n_classes)
            c_before, w_before = np.append(total - 1, c[:-1]), np.append(size + SHAPES, w[:-1])
            same = w == w_before
            parts.append(_summed([w * width + c_before, w_before * width + total + c, w[same] * width + 2 * total]))
            held += len(parts[-1][0])
            if held > HELD:
                parts = [merged(parts)]
                held = len(parts[0][0])
                if held > HELD // 2:
                    yield _rows(parts[0], ["k", "n"])
                    parts, held = [], 0
        if parts:
            yield _rows(merged(parts), ["k", "n"])
    return run


def _context_rows(batches, width: int):
    """Per batch of (w, cells): the words and their dense context counts."""
    for b in (x.slice(lo, 2000) for x in batches for lo in range(0, len(x), 2000)):
        cells = b.column("cells")
        x = np.zeros((len(b), width))
        flat = cells.flatten()
        row = np.repeat(np.arange(len(b)), np.diff(cells.offsets.to_numpy()))
        x[row, flat.field("c").to_numpy()] = flat.field("n").to_numpy()
        yield b.column("w").to_numpy(), x


def class_of(w: np.ndarray, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Classes of words numbered as in ``_aligned_words``."""
    size = len(classes)
    return np.where(w < size, np.append(classes, 0)[np.minimum(w, size)], n_classes + w - size)


def _pair_counts(classes: np.ndarray, n_classes: int):
    """mapInArrow over the words' contexts: a task's share of the class pair counts."""
    total = n_classes + SHAPES + 1

    def run(batches):
        pair = np.zeros((total, total))
        for w, x in _context_rows(batches, 2 * total + 1):
            np.add.at(pair, class_of(w, classes, n_classes), x[:, total:2 * total])
        a, b = np.indices(pair.shape)
        yield _rows([a.ravel(), b.ravel(), pair.ravel()], ["a", "b", "n"])
    return run


def likelihood(pair: np.ndarray) -> float:
    """The class bigram log likelihood, up to what the classes cannot change."""
    return float(_xlogx(pair).sum() - _xlogx(pair.sum(1)).sum() - _xlogx(pair.sum(0)).sum())


def best_class(pair: np.ndarray, n_classes: int, c: int, before: np.ndarray, after: np.ndarray, own: float) -> int:
    """The class that raises the likelihood most for a word of class ``c``
    with these context counts, all other words left where they are."""
    r, lf = after.copy(), before.copy()
    r[c] -= own
    lf[c] -= own
    rest = pair.copy()
    rest[c, :] -= r
    rest[:, c] -= lf
    rest[c, c] -= own
    tot_r, tot_l, diag = pair.sum(1)[:n_classes], pair.sum(0)[:n_classes], np.arange(n_classes)
    tot_r[c] -= after.sum()
    tot_l[c] -= before.sum()
    row = _xlogx(rest[:n_classes] + r) - _xlogx(rest[:n_classes])
    col = _xlogx(rest[:, :n_classes] + lf[:, None]) - _xlogx(rest[:, :n_classes])
    corner = rest[diag, diag]
    gain = (row.sum(1) - row[diag, diag] + col.sum(0) - col[diag, diag] + _xlogx(corner + r[:n_classes] + lf[:n_classes] + own) - _xlogx(corner)
            - _xlogx(tot_r + after.sum()) + _xlogx(tot_r) - _xlogx(tot_l + before.sum()) + _xlogx(tot_l))
    best = int(gain.argmax())
    return best if gain[best] > gain[c] + 1e-9 else int(c)


def _moves(classes: np.ndarray, n_classes: int, pair: np.ndarray, turn: int):
    """mapInArrow over the words' contexts: (w, c) of the vocabulary words of this turn that change their class."""
    total, size = n_classes + SHAPES + 1, len(classes)

    def run(batches):
        for w, x in _context_rows(batches, 2 * total + 1):
            out = []
            for i in np.flatnonzero((w < size) & (w % 2 == turn)):
                c = int(classes[w[i]])
                best = best_class(pair, n_classes, c, x[i, :total], x[i, total:2 * total], x[i, 2 * total])
                if best != c:
                    out.append((w[i], best))
            moved = np.array(out, np.int64).reshape(-1, 2)
            yield _rows([moved[:, 0], moved[:, 1]], ["w", "c"])
    return run


def sweep_all(learned: DataFrame, classes: np.ndarray, n_classes: int, sweeps: int) -> np.ndarray:
    """Classes of all vocabulary words after batch exchange sweeps on all
    bigrams. The driver holds the classes and the class pair counts only."""
    size, width = len(classes), 2 * (n_classes + SHAPES + 1) + 1
    best, top = classes, -np.inf
    for s in range(sweeps + 1 if size and n_classes > 1 else 0):
        counts = (learned.select("places", "rare").mapInArrow(_word_contexts(classes, n_classes, size), "k long, n long")
                  .groupBy("k").agg(F.sum("n").alias("n")))
        cells = F.collect_list(F.struct((F.col("k") % width).cast("int").alias("c"), "n")).alias("cells")   # at most ``width`` a word
        contexts = materialize(counts.groupBy(F.expr(f"k div {width}").alias("w")).agg(cells), "contexts")
        shares = contexts.mapInArrow(_pair_counts(classes, n_classes), "a long, b long, n double").groupBy("a", "b").agg(F.sum("n").alias("n")).toPandas()
        pair = np.zeros((n_classes + SHAPES + 1,) * 2)
        pair[shares["a"], shares["b"]] = shares["n"]
        now = likelihood(pair)
        if now <= top:
            break
        best, top = classes, now
        if s < sweeps:
            moved = contexts.mapInArrow(_moves(classes, n_classes, pair, s % 2), "w long, c long").toPandas()     # at most one row a word
            classes = classes.copy()
            classes[moved["w"]] = moved["c"]
        release(contexts)
    return best


@dataclass
class Model:
    vocab: Vocabulary
    classes: np.ndarray        # by frequency place; rare words: n_classes + shape
    n_classes: int             # clustered classes
    log_next: np.ndarray       # log10 P(class | class before)
    log_word: np.ndarray       # by place: log10 emission of a vocabulary word
    log_enter: np.ndarray      # [class before, class]: log_next less log10 of the class' emission total
    train_tokens: int
    distinct: int
    end_count: int


def rare_shape(h: np.ndarray) -> np.ndarray:
    return (h % np.uint64(SHAPES)).astype(np.int64)


def _class_stream(model_classes, n_classes, b, p, off, rare_count):
    """Classes of all tokens of a batch, one end token after each row, and the
    positions of the end tokens."""
    rare_hash = np.concatenate([np.frombuffer(x, np.uint64) for x in b.column("rare").to_pylist()] or [np.zeros(0, np.uint64)])
    cls = np.empty(len(p), np.int64)
    is_rare = p == rare_count
    cls[~is_rare] = model_classes[p[~is_rare]]
    cls[is_rare] = n_classes + rare_shape(rare_hash)
    rows = len(off) - 1
    out = np.empty(len(p) + rows, np.int64)
    at = np.arange(len(p)) + np.repeat(np.arange(rows), np.diff(off))
    ends = off[1:] + np.arange(rows)
    out[at], out[ends] = cls, n_classes + SHAPES
    return out, ends, rare_hash


def _rare_tokens(classes, n_classes: int, b, p, off, size: int):
    """(hash, class before) of the rare words of a batch, in order, with the
    stream's classes and end positions."""
    c, ends, rare_hash = _class_stream(classes, n_classes, b, p, off, size)
    inside = np.ones(len(c), bool)
    inside[ends] = False
    before = np.append(n_classes + SHAPES, c[:-1])[inside]
    return rare_hash, before[p == size], c, ends


def _rare_contexts(classes, n_classes: int, size: int):
    """mapInArrow: counts of the classes before every rare word, combined over ``HELD`` tokens."""
    def summed(parts):
        h, g = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((g, h))
        h, g = h[order], g[order]
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])))
        return _rows([h[first], g[first].astype(np.int32), np.diff(np.append(first, len(h)))], ["h", "g", "n"])

    def run(batches):
        parts, held = [], 0
        for b, p, off in _streams(batches):
            if not len(b):
                continue
            h, g, _, _ = _rare_tokens(classes, n_classes, b, p, off, size)
            if len(h):
                parts.append((h, g))
                held += len(h)
            if held > HELD:
                yield summed(parts)
                parts, held = [], 0
        if parts:
            yield summed(parts)
    return run


def enter_class(pair: np.ndarray, n_classes: int, shape: np.ndarray, now: np.ndarray, n: np.ndarray,
                row: np.ndarray, g: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The class of each word after one exchange step against ``pair``: the
    one of the clustered classes and the word's spelling class that gives the
    highest likelihood with the word's counts taken out of its class ``now``
    and put there. Word ``row`` has count ``x`` after class ``g``, in the order
    of ``row``; every word has a cell."""
    if not len(n):
        return now
    own = np.minimum(now, n_classes)                 # the last column is the word's spelling class
    words, cells, first = np.arange(len(n)), np.arange(len(g)), np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    x = x.astype(float)
    was = np.concatenate([pair[:, :n_classes][g], pair[g, n_classes + shape[row]][:, None]], 1)
    was[cells, own[row]] -= x
    total = np.concatenate([np.broadcast_to(pair.sum(0)[:n_classes], (len(n), n_classes)), pair.sum(0)[n_classes + shape][:, None]], 1)
    total[words, own] -= n
    gain = np.add.reduceat(_xlogx(was + x[:, None]) - _xlogx(was), first, axis=0) - _xlogx(total + n[:, None]) + _xlogx(total)
    best = gain.argmax(1)
    best = np.where(gain[words, best] > gain[words, own] + 1e-9, best, own)
    return np.where(best == n_classes, n_classes + shape, best)


def _rare_classes(batches, n_classes: int, turns: list[np.ndarray]):
    """Per batch of rare words (h, n, cells): hashes, counts, classes after the
    ``turns`` (the class pair counts before each) and the cells as (row, g, x).
    Words seen once have no cells."""
    for b in (x.slice(lo, 2000) for x in batches for lo in range(0, len(x), 2000)):
        h, n = b.column("h").to_numpy().view(np.uint64), b.column("n").to_numpy()
        col = b.column("cells")
        flat, row = col.flatten(), np.repeat(np.arange(len(b)), np.diff(col.offsets.to_numpy()))
        g, x = flat.field("g").to_numpy(), flat.field("n").to_numpy()
        shape = rare_shape(h)
        cls = n_classes + shape
        for turn, pair in enumerate(turns):
            moves = (n > 1) & ((h >> np.uint64(3)) % np.uint64(2) == np.uint64(turn % 2))
            at, part = np.cumsum(moves) - 1, moves[row]
            cls[moves] = enter_class(pair, n_classes, shape[moves], cls[moves], n[moves], at[row[part]], g[part], x[part])
        yield h, n, cls, (row, g, x)


def _rare_state(n_classes: int, turns: list[np.ndarray]):
    """mapInArrow over the rare words: how their classes after the ``turns``
    change the class pair counts, then (rows ``total`` and ``total`` + 1) the
    count and the number of the words of each class."""
    total = n_classes + SHAPES + 1

    def run(batches):
        out = np.zeros((total + 2, total))
        for h, n, cls, (row, g, x) in _rare_classes(batches, n_classes, turns):
            np.add.at(out, (g, cls[row]), x)
            np.add.at(out, (g, n_classes + rare_shape(h)[row]), -x)
            out[total] += np.bincount(cls, weights=n, minlength=total)
            out[total + 1] += np.bincount(cls, minlength=total)
        a, b = np.indices(out.shape)
        yield _rows([a.ravel(), b.ravel(), out.ravel()], ["a", "b", "n"])
    return run


def _rare_table(n_classes: int, turns: list[np.ndarray]):
    """mapInArrow: (h, n, c) of the rare words."""
    def run(batches):
        for h, n, cls, _ in _rare_classes(batches, n_classes, turns):
            yield _rows([h, n, cls.astype(np.int32)], ["h", "n", "c"])
    return run


def enter_likelihood(pair: np.ndarray) -> float:
    """The class bigram log likelihood, up to what the classes of words beyond
    the vocabulary cannot change."""
    return float(_xlogx(pair).sum() - _xlogx(pair.sum(0)).sum())


def sweep_rare(learned: DataFrame, classes: np.ndarray, n_classes: int, grid: np.ndarray, n_turns: int):
    """(rare words with count and class, class pair counts, count by class,
    words by class) after exchange turns over all words beyond the vocabulary.
    A word's class follows from its own row and the few class matrices of the
    turns, so a turn writes nothing."""
    size, total = len(classes), len(grid)
    cells = F.collect_list(F.struct("g", "n"))       # at most ``total`` a word
    contexts = materialize(
        learned.select("places", "rare").mapInArrow(_rare_contexts(classes, n_classes, size), "h long, g int, n long")
        .repartition("h").groupBy("h", "g").agg(F.sum("n").alias("n"))
        .groupBy("h").agg(F.sum("n").alias("n"), cells.alias("cells"))
        .withColumn("cells", F.when(F.col("n") > 1, F.col("cells")).otherwise(F.slice("cells", 1, 0))), "rare-contexts")

    def state(turns):
        rows = contexts.mapInArrow(_rare_state(n_classes, turns), "a long, b long, n double").groupBy("a", "b").agg(F.sum("n").alias("n")).toPandas()
        out = np.zeros((total + 2, total))
        out[rows["a"], rows["b"]] = rows["n"]
        return grid + out[:total], out[total], out[total + 1]

    turns, best = [], state([])
    for _ in range(n_turns if n_classes > 1 else 0):
        after = state([*turns, best[0]])
        if enter_likelihood(after[0]) <= enter_likelihood(best[0]):
            break
        turns, best = [*turns, best[0]], after
    return contexts.mapInArrow(_rare_table(n_classes, turns), "h long, n long, c int"), *best


def _transitions(classes, n_classes, rare_count):
    """mapInArrow: counts of class pairs, the end class standing before a text."""
    total = n_classes + SHAPES + 1

    def run(batches):
        for b, p, off in _streams(batches):
            if not len(b):
                continue
            c, ends, _ = _class_stream(classes, n_classes, b, p, off, rare_count)
            prev = np.concatenate([[total - 1], c[:-1]])
            yield _rows(_summed([prev * total + c]), ["k", "n"])
    return run


def fit_and_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 10,
                   vocab_size: int = VOCAB, core: int = CORE, n_classes: int | None = None, sweeps: int = BATCH_SWEEPS,
                   rare_turns: int = RARE_TURNS) -> tuple[Model, DataFrame, DataFrame]:
    """(model, encoded rows, rare words with count n and class c). Encoded
    rows: id, held_out, row (a number of its own), places, rare. Without
    ``n_classes`` there are ``CLASSES`` for each doubling of the words."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus
    src = docs.select(F.col(id_col).alias("id"), rest.alias("rest"), F.col(text_col).cast("string").alias("text"))
    counts = materialize(src.where(F.col("rest") != 0).select("text").mapInArrow(_count_words, "h long, n long")
                         .groupBy("h").agg(F.sum("n").alias("n")), "word-counts")
    totals = counts.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.when(F.col("h") == END, F.col("n")))).first()
    train_tokens, distinct, end_count = (int(x or 0) for x in totals)
    top = (counts.where(F.col("h") != END).orderBy(F.desc("n"), "h").limit(vocab_size).toPandas())
    h, n = top["h"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(h)
    vocab = Vocabulary(h[order], n[order], order.astype(np.int64))
    size, core = len(h), min(core, len(h))
    k = max(1, min(round(CLASSES * np.log2(distinct + 1)) if n_classes is None else n_classes, core))
    encoded = materialize(
        src.select("id", F.coalesce(F.col("rest") == 0, F.lit(False)).alias("held_out"),
                   F.coalesce(F.col("rest") != 0, F.lit(False)).alias("learned"), "text")
        .mapInArrow(_encode(vocab), "id long, held_out boolean, learned boolean, places binary, rare binary")
        .withColumn("row", F.monotonically_increasing_id()), "encoded")
    learned = encoded.where("learned")

    pairs = learned.select("places").mapInArrow(_core_bigrams(core), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    bigrams = np.zeros((core, core))
    if core:
        bigrams[pairs["k"] // core, pairs["k"] % core] = pairs["n"]
    classes = np.zeros(size, np.int64)
    classes[:core] = exchange(bigrams, k)
    one = np.zeros((core, k))
    one[np.arange(core), classes[:core]] = 1
    pair = one.T @ bigrams @ one
    contexts = (learned.select("places").mapInArrow(_contexts(core, classes[:core], k, size), "k long, n long")
                .groupBy("k").agg(F.sum("n").alias("n")))

    def place(pdfs):
        # One row per word: its counts of neighbouring classes.
        for pdf in pdfs:
            x = np.zeros((len(pdf), 2 * k))
            for i, cells in enumerate(pdf["cells"]):
                for c in cells:
                    x[i, c["c"]] = c["n"]
            yield pdf[["w"]].assign(c=place_by_context(x, pair))

    words = (contexts.groupBy(F.expr(f"k div {2 * k}").alias("w"))
             .agg(F.collect_list(F.struct((F.col("k") % (2 * k)).cast("int").alias("c"), "n")).alias("cells"))
             .mapInPandas(place, "w long, c long").toPandas())     # at most one row per vocabulary word
    # A word that never stands beside a core word starts in the class of the largest total.
    classes[core:] = int(pair.sum(1).argmax()) if core else 0
    classes[words["w"]] = words["c"]
    classes = sweep_all(learned, classes, k, sweeps)

    total = k + SHAPES + 1
    grid = np.zeros((total, total))
    steps = (learned.select("places", "rare").mapInArrow(_transitions(classes, k, size), "k long, n long")
             .groupBy("k").agg(F.sum("n").alias("n")).toPandas())
    grid[steps["k"] // total, steps["k"] % total] = steps["n"]
    rare, grid, rare_count, rare_words = sweep_rare(learned, classes, k, grid, rare_turns)
    smooth = grid + ADD_CLASS
    log_next = np.log10(smooth / smooth.sum(1, keepdims=True))
    # Emission totals; an unseen word has a share in its spelling class.
    mass = rare_count + ADD_WORD * rare_words
    mass[:k] += np.bincount(classes, weights=n, minlength=k) if size else 0
    mass[k:k + SHAPES] += ADD_WORD
    log_word = np.log10(n / mass[classes]) if size else np.zeros(0)
    log_enter = log_next[:, :k + SHAPES] - np.log10(np.maximum(mass[:k + SHAPES], ADD_WORD))
    model = Model(vocab, classes, k, log_next, log_word, log_enter, train_tokens, distinct, end_count)
    return model, encoded, rare


def _scorer(model: Model):
    """mapInArrow: per row one head line with what the vocabulary settles, and
    a line per distinct rare word and class before it."""
    size, k = len(model.vocab.hashes), model.n_classes
    total = k + SHAPES + 1
    below = np.log10(model.train_tokens + 0.1 * (model.distinct + 1))
    counts = np.empty(size)
    counts[model.vocab.place] = model.vocab.counts
    base_word = np.append(np.log10(counts + 0.1) - below, -below)          # a rare word's numerator is added later
    word = np.append(model.log_word, 0.0)
    base_end = np.log10(model.end_count + 0.1) - below

    def run(batches):
        for b, p, off in _streams(batches):
            rows = len(b)
            if not rows:
                continue
            rare_hash, rare_before, c, ends = _rare_tokens(model.classes, k, b, p, off, size)
            enter = model.log_next[np.append(total - 1, c[:-1]), c]
            enter[(c >= k) & (c < k + SHAPES)] = 0.0       # into a rare word: its line
            step = np.concatenate([[0.0], np.cumsum(enter)])
            first = np.concatenate([[0], ends[:-1] + 1])
            sums = lambda x: (s := np.concatenate([[0.0], np.cumsum(x)]))[off[1:]] - s[off[:-1]]
            n_rare = sums((p == size).astype(float)).astype(np.int64)
            n = np.diff(off)
            row_id = b.column("row").to_numpy()
            # A head's key meets no count that matters; it only spreads the heads.
            spread = pa.array(mix(row_id.astype(np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), spread, b.column("id"), b.column("held_out"), pa.array(n + 1),
                 pa.array(n - n_rare + (model.end_count > 0)), pa.array(sums(base_word[p]) + base_end),
                 pa.array(step[ends + 1] - step[first] + sums(word[p])), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int64())], names=LINE.names)
            if len(rare_hash):
                owner = np.repeat(np.arange(rows), n_rare)
                at = np.lexsort((rare_before, rare_hash, owner))
                o, r, g = owner[at], rare_hash[at], rare_before[at]
                new = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (r[1:] != r[:-1]) | (g[1:] != g[:-1])))
                tf = np.diff(np.append(new, len(r)))
                m = len(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row_id[o[new]]), pa.array(r[new].view(np.int64)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()),
                     pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()),
                     pa.array(g[new].astype(np.int32)), pa.array(tf)], names=LINE.names)
    return run


LINE = pa.schema([("row", pa.int64()), ("h", pa.int64()), ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                  ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("g", pa.int32()), ("tf", pa.int64())])


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """Per row: ``id_col``, held_out, n_tokens, n_known, train_tokens,
    base_score, score, perplexity (of the model, per token)."""
    model, encoded, rare = fit_and_encode(docs, id_col, text_col, **sizes)
    lines = encoded.drop("learned").mapInArrow(
        _scorer(model), "row long, h long, id long, held_out boolean, n_tokens long, n_known long, base double, score double, g int, tf long")
    k = model.n_classes
    enter = docs.sparkSession.createDataFrame(      # a few thousand rows: the square of the number of classes
        [(g, c, float(x)) for (g, c), x in np.ndenumerate(model.log_enter)], "g int, c int, enter double")
    # The rare words meet their counts and classes: rare words are spread thin, so no key is hot.
    log_more = F.when(F.col("tf").isNotNull(), F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1)))
    met = (lines.join(rare, "h", "left").withColumn("c", F.coalesce("c", F.expr(f"cast({k} + pmod(h, {SHAPES}) as int)")))
           .join(F.broadcast(enter), ["g", "c"], "left"))
    full = met.groupBy("row").agg(
        F.max("id").alias("id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.coalesce(F.sum(F.when(F.col("n").isNotNull(), F.col("tf"))), F.lit(0))).alias("n_known"),
        F.sum("base").alias("base"), F.sum(F.coalesce("score", F.col("tf") * F.col("enter"))).alias("score"),
        F.coalesce(F.sum(log_more), F.lit(0.0)).alias("more"))
    return full.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), (F.col("base") + F.col("more")).alias("base_score"),
        (F.col("score") + F.col("more")).alias("score"),
        F.pow(F.lit(10.0), -(F.col("score") + F.col("more")) / F.col("n_tokens")).alias("perplexity"))
