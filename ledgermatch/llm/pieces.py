"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text gets the model's dummy prefix and its spaces become the space symbol.
It is cut between characters that no piece of the vocabulary has side by side:
no merge can cross such a place. The distinct parts of a slice of texts form
one flat array of symbols. In each round every part finds the least rank among
its adjacent pairs (a segmented minimum) and merges its occurrences from the
left; the array is compacted, and parts without a pair leave it. Characters
outside the vocabulary become the ids of their UTF-8 bytes.

One merge can open a pair that is at least as good as the one being merged.
The library would take that pair before the next occurrence, so a part's
occurrences after such a merge wait for the next round. Pairs of equal rank
are taken from the left.

Decoding concatenates the pieces' bytes, drops the dummy prefix, turns the
space symbol into a space and each byte outside valid UTF-8 into U+FFFD.

Defined results: a null text is the empty text, which has no ids; no ids (or
null ids) decode to the empty text. Rows are encoded one by one, so repeated
rows and identifiers give one row each. Empty tables give empty tables; other
columns are ignored. Supported models: BPE without a normalisation table, with
byte fallback, and with normal, byte, control and unknown pieces only; any
other model is an error. A text is one row of one task; the working memory is
that of a slice of texts or of one text.
"""

from __future__ import annotations

import codecs
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.arrow import slices

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6     # piece types of the model format
SLICE_BYTES = 2 << 20                           # texts whose distinct words are merged together
NONE = np.iinfo(np.int32).max                   # rank of a pair that is no piece


class PairTable:
    """Open-addressing table from whole-number keys to whole numbers."""

    def __init__(self, pairs: dict[int, int]):
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        left, value = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        at = self._slot(left)
        while len(left):   # of the keys that want one free slot the last written has it, the others go on
            free = self.keys[at] == -1
            self.keys[at[free]] = left[free]
            mine = self.keys[at] == left
            self.values[at[mine]] = value[mine]
            left, value, at = left[~mine], value[~mine], (at[~mine] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 for a key that is not in the table."""
        out = np.full(len(keys), -1, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            found = self.keys[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            go = ~hit & (found != -1)
            todo, at = todo[go], (at[go] + 1) & (len(self.keys) - 1)
        return out


class Vocabulary:
    """The pieces of a model, made on the driver and sent with the tasks."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as model_format

        model = model_format.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if (model.trainer_spec.model_type != model.trainer_spec.BPE or not model.trainer_spec.byte_fallback or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}
                or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or model.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("only BPE models with byte fallback and without normalisation are supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.size = len(model.pieces)
        ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        # Symbols: the piece ids, and size + code point for a character that is no piece.
        symbol = lambda s: ids.get(s, self.size + ord(s) if len(s) == 1 else None)
        single = sorted((ord(s), i) for s, i in ids.items() if len(s) == 1)
        self.points, self.point_ids = (np.array(x, np.int64) for x in zip(*single))
        scores = np.array([p.score for p in model.pieces])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)   # equal scores are equal ranks
        merges, beside = {}, {}
        for s, i in ids.items():
            for k in range(1, len(s)):
                beside[ord(s[k - 1]) << 21 | ord(s[k])] = 1
                a, b = symbol(s[:k]), symbol(s[k:])
                if a is not None and b is not None:
                    merges[a << 21 | b] = i
        self.merges, self.beside = PairTable(merges), PairTable(beside)
        self.byte = np.zeros(256, np.int64)
        self.raw = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte[int(p.piece[1:-1], 16)] = i
            self.raw.append(bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else b"" if p.type == CONTROL
                            else model.trainer_spec.unk_surface.encode() if p.type == UNKNOWN else p.piece.encode())
        self.text = [str(i) for i in range(self.size)]
        self.crosses = any(s[k] == SPACE != s[k - 1] for s in ids for k in range(1, len(s)))
        self.period = self._period(ids)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(self.points[at] == points, self.point_ids[at], self.size + points)

    def _period(self, ids: dict[str, int]) -> int:
        """Longest piece of space symbols, where all of these pieces have one
        rank, so that a run of them is filled from the left; else 0."""
        runs = [i for s, i in ids.items() if set(s) == {SPACE}]
        longest = max((len(s) for s, i in ids.items() if set(s) == {SPACE}), default=0)
        if longest < 2 or len({int(self.rank[i]) for i in runs if self.raw[i] != SPACE.encode()}) != 1:
            return 0
        def shape(m):
            return merged(self, [SPACE * m])[0].tolist()
        want = ids[SPACE * longest]
        ok = all(shape(m) == [want, *shape(m - longest)] for m in range(3 * longest, 4 * longest))
        return longest if ok else 0


def _pairs(v: Vocabulary, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank, merged symbol) of the pairs of symbols."""
    m = v.merges.get(a << 21 | b)
    return np.where(m >= 0, v.rank[m], NONE), m


def merged(v: Vocabulary, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): the ids of all parts, one after the other."""
    n = len(parts)
    points = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.int64)
    lengths = np.fromiter(map(len, parts), np.int64, n)
    part = np.repeat(np.arange(n), lengths)
    # Cuts: at the parts' ends and between characters that no piece has side by side.
    last = np.ones(len(points), bool)
    last[:-1] = (part[1:] != part[:-1]) | (v.beside.get(points[:-1] << 21 | points[1:]) < 0)
    sym, order = v.symbols(points), np.arange(len(points))
    rank, to = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int64)
    inner = np.flatnonzero(~last)
    rank[inner], to[inner] = _pairs(v, sym[inner], sym[inner + 1])
    done = []
    while len(sym):
        first = np.flatnonzero(np.append(True, last[:-1]))
        size = np.diff(np.append(first, len(sym)))
        least = np.minimum.reduceat(rank, first)
        over = np.repeat(least == NONE, size)
        if over.any():   # parts without a pair leave
            done.append((order[over], sym[over]))
            sym, order, rank, to, last = (x[~over] for x in (sym, order, rank, to, last))
            size, least = size[least != NONE], least[least != NONE]
            if not len(sym):
                break
        seg = np.repeat(np.arange(len(size)), size)
        hit = np.flatnonzero(rank == least[seg])
        # Of overlapping occurrences every other one, from the left.
        new_run = np.append(True, hit[1:] != hit[:-1] + 1)
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
        # Pairs that each merge opens, its left neighbour already merged.
        best = np.full(len(hit), NONE, np.int32)
        left = np.flatnonzero((hit > 0) & ~last[hit - 1])
        beside = sym[hit[left] - 1]
        after = np.flatnonzero((left > 0) & (hit[left - 1] == hit[left] - 2))
        beside[after] = to[hit[left[after] - 1]]
        best[left] = _pairs(v, beside, to[hit[left]])[0]
        right = np.flatnonzero(~last[hit + 1])
        best[right] = np.minimum(best[right], _pairs(v, to[hit[right]], sym[hit[right] + 2])[0])
        # Occurrences after a merge that opens a pair as good wait.
        bad = best <= least[seg[hit]]
        before = np.cumsum(bad) - bad
        begins = np.append(True, seg[hit][1:] != seg[hit][:-1])
        hit = hit[before == np.maximum.accumulate(np.where(begins, before, 0))]
        sym[hit] = to[hit]
        last[hit] = last[hit + 1]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        place = np.cumsum(keep) - 1
        sym, order, rank, to, last = (x[keep] for x in (sym, order, rank, to, last))
        at = place[hit]
        touched = np.zeros(len(sym), bool)
        touched[at] = touched[at[at > 0] - 1] = True
        changed = np.flatnonzero(touched)
        ends = last[changed]
        rank[changed[ends]] = NONE
        changed = changed[~ends]
        rank[changed], to[changed] = _pairs(v, sym[changed], sym[changed + 1])
    if not done:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    order, sym = (np.concatenate(x) for x in zip(*done))
    turn = np.argsort(order, kind="stable")
    part, sym = part[order[turn]], sym[turn]
    strange = np.flatnonzero(sym >= v.size)
    if len(strange):   # byte fallback
        spelled = [chr(s - v.size).encode() for s in sym[strange].tolist()]
        times = np.ones(len(sym), np.int64)
        times[strange] = [len(b) for b in spelled]
        part, sym = np.repeat(part, times), np.repeat(sym, times)
        sym[sym >= v.size] = v.byte[np.frombuffer(b"".join(spelled), np.uint8)]
    return sym, np.searchsorted(part, np.arange(n + 1))


def _words(v: Vocabulary, text: str) -> list[str]:
    """The parts of a text that are looked up as wholes: runs of space symbols
    with what follows; long runs are cut where they are filled up."""
    if not text:
        return []
    text = v.prefix + text.replace(" ", SPACE)
    if v.crosses:
        return [text]
    words = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text)
    if not v.period or f"{SPACE * 4 * v.period}" not in text:
        return words
    out = []
    for w in words:
        run = len(w) - len(w.lstrip(SPACE))
        full = max(0, run // v.period - 3)
        out += [SPACE * v.period] * full + [w[full * v.period:]]
    return out


def encode_texts(v: Vocabulary, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the texts. Each distinct word is merged once."""
    index: dict[str, int] = {}
    found = [[index.setdefault(w, len(index)) for w in _words(v, t)] for t in texts]
    ids, offsets = merged(v, list(index))
    word = np.fromiter((w for f in found for w in f), np.int64)
    size = np.diff(offsets)[word]
    ends = np.cumsum(size)
    flat = ids[np.repeat(offsets[word] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
    of_text = np.cumsum([0, *map(len, found)])
    return flat, np.append(0, ends)[of_text]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_tokens long, ids binary: little-endian unsigned 32-bit).

    ``model_path`` is read on the driver; its tables (some MB) go out with the tasks.
    """
    v = Vocabulary(model_path)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in slices(batches, SLICE_BYTES):
            flat, at = encode_texts(v, [t or "" for t in b.column("text").to_pylist()])
            flat = flat.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.diff(at), pa.int64()), pa.array([flat[x:y].tobytes() for x, y in zip(at[:-1], at[1:])], pa.binary())],
                names=["id", "n_tokens", "ids"])
    return src.mapInArrow(run, "id long, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


def decode_ids(v: Vocabulary, ids: list[int]) -> str:
    codecs.register_error("one_byte", _one_byte)
    text = b"".join(map(v.raw.__getitem__, ids)).decode("utf-8", "one_byte")
    if v.prefix and text.startswith(SPACE):
        text = text[1:]
    return text.replace(SPACE, " ")


def decode(coded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``coded`` with string columns ``decoded`` (the text) and ``ids_text``
    (the ids in decimal, joined by commas)."""
    v = Vocabulary(model_path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields) + ", decoded string, ids_text string"

    def run(batches):
        for b in slices(batches, SLICE_BYTES):
            ids = [np.frombuffer(x or b"", "<u4").tolist() for x in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([decode_ids(v, x) for x in ids], pa.string()), pa.array([",".join(map(v.text.__getitem__, x)) for x in ids], pa.string())],
                names=[*b.schema.names, "decoded", "ids_text"])
    return coded.mapInArrow(run, schema)


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Round trip as digests: id, n_tokens, ids_sha256, decoded_sha256."""
    back = decode(encode(docs, model_path, id_col, text_col), model_path)
    return back.select(id_col, "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
