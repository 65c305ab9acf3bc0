"""Secret scan: stated patterns plus a token-efficiency test.

Three kinds of spans come from fixed patterns (assigned credentials, access
keys, long hex runs). The fourth, ``random``, comes from tokenising: prose
needs few tokens for its characters, a random string needs many. A run of key
characters whose characters-per-token ratio under a public byte-level
vocabulary is low is reported, unless it is a known digest (hex of a digest's
length), an identifier (UUID, plain number, dotted or snake-case words, path)
or lies in a span of a fixed pattern. In a run that is readable on the whole
(a path, host, name or key with a random string in it) the parts between / . -
_ and = are scored by what they fall short of the ratio, and the stretches of
parts with the highest sums are reported, if they are long enough and neither
known digests nor identifiers.

Defined results: null and empty texts have no spans. Texts are scanned whole;
offsets are code points, end exclusive. Each input row gives one output row,
so repeated rows give equal rows; empty tables give empty tables; other
columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.arrow import slices
from ledgermatch.llm.bpe import _encoding

# The patterns and least lengths of the base kinds, in order.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)

CANDIDATE_CHARS = 20      # shortest run of key characters that is tested
CHARS_PER_TOKEN = 2.0     # runs at or below this ratio are random


def _stretches(scores: list[float]) -> list[tuple[int, int]]:
    """The maximal stretches of positive sum (Ruzzo and Tompa), as (first, end)."""
    total, found = 0.0, []          # (sum before, sum after, first, end)
    for k, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        now = (before, total, k, k + 1)
        while found:
            at = len(found) - 1
            while at >= 0 and found[at][0] >= now[0]:
                at -= 1
            if at < 0 or found[at][1] >= now[1]:
                break
            now = (found[at][0], now[1], found[at][2], now[3])
            del found[at:]
        found.append(now)
    return [x[2:] for x in found]


def _scanner(ranks_path: str, pattern: str, ratio: float, least: int):
    def run(batches):
        enc = _encoding(ranks_path, pattern)
        assign, access = re.compile(ASSIGN, re.I | re.A), re.compile(ACCESS)
        # A maximal run is the match whatever its length, so the least length can be asked for at once.
        hexes = re.compile(HEX[:-1] + "{%d,}" % LEAST_HEX)
        candidate = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % least)
        known = re.compile(r"[0-9a-f]+|[0-9A-F]+")
        identifier = re.compile(
            r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"          # UUID
            r"|[0-9+./=_-]+"                                               # number, date, version, rule
            # dotted, snake-case or path words (atomic: no backtracking into a word)
            r"|/?(?>[A-Z]{2,15}|[A-Za-z][a-z]{0,14})[0-9]{0,4}(?>[._/=+-]++(?>[A-Z]{2,15}|[A-Za-z][a-z]{0,14})[0-9]{0,4})++[._/=+-]*"
        )

        part = re.compile(r"[A-Za-z0-9+]+")
        uuid = re.compile(r"(?<![A-Za-z0-9+])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9+])")

        def inside(s):
            """(first, end) of the random stretches of parts of a run."""
            named = [m.span() for m in uuid.finditer(s)]
            parts, scores, k = [m.span() for m in part.finditer(s)], [], 0
            for lo, hi in parts:
                while k < len(named) and named[k][1] <= lo:
                    k += 1
                skip = hi - lo in DIGEST_LENGTHS and known.fullmatch(s, lo, hi) or k < len(named) and named[k][0] <= lo
                scores.append(-float(len(s)) * ratio if skip else ratio * len(enc.encode_ordinary(s[lo:hi])) - (hi - lo))
            for first, end in _stretches(scores):
                lo, hi = parts[first][0], parts[end - 1][1]
                if hi - lo >= least and not identifier.fullmatch(s, lo, hi):
                    yield lo, hi

        def spans(text):
            found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
            found += [(m.start(), 1, m.end()) for m in access.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
            found += [(m.start(), 2, m.end()) for m in hexes.finditer(text)]
            base = sorted(found)
            added, reach, k = [], 0, 0      # reach: furthest end of the base spans that start before the run's end
            for m in candidate.finditer(text):
                s = m.group()
                lo, hi = m.span()
                if known.fullmatch(s) and len(s) in DIGEST_LENGTHS or identifier.fullmatch(s):
                    continue
                while k < len(base) and base[k][0] < hi:
                    reach, k = max(reach, base[k][2]), k + 1
                if reach > lo:
                    continue
                if len(s) <= ratio * len(enc.encode_ordinary(s)):
                    added.append((lo, 3, hi))
                else:
                    added += [(lo + x, 3, lo + y) for x, y in inside(s)]
            return base, sorted(base + added)

        names = ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base", "spans"]
        for b in slices(batches):
            rows = [spans(t or "") for t in b.column("text").to_pylist()]
            text = [",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in x) for r in rows for x in r]
            counts = [pa.array([sum(k == n for _, k, _ in r[1]) for r in rows], pa.int64()) for n in range(4)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *counts, pa.array(text[::2], pa.string()),
                                              pa.array(text[1::2], pa.string())], names=names)
    return run


def scan(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
         ratio: float = CHARS_PER_TOKEN, least: int = CANDIDATE_CHARS) -> DataFrame:
    """Per row: ``id_col``, n_assign, n_access, n_hex, n_random, base (the fixed
    patterns' spans as kind:start:end, comma-joined) and spans (all)."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (src.mapInArrow(_scanner(ranks_path, pattern, ratio, least),
                           "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base string, spans string")
            .withColumnRenamed("doc_id", id_col))


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    found = scan(docs, ranks_path, pattern, id_col, text_col)
    return found.select(id_col, "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_random")
