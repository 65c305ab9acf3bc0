"""Words of Arrow text columns as 64-bit hashes, computed with numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D, A-Z
lower-cased. Its hash is a polynomial over random 64-bit byte values, mixed
once more. Two different words among ten million collide with a probability
below one in 100,000. Texts are read block by block, so the working memory
does not depend on the length of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=U64) + U64(seed << 32)) * U64(0x9E3779B97F4A7C15))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


class WordHasher:
    """Made once per task; holds the powers for one block."""

    def __init__(self, block: int = BLOCK_BYTES, spelled: bool = False):
        """``spelled``: the low three bits of a hash tell the word's spelling."""
        self.block, self.spelled = block, spelled
        table = numbers(256, 1)
        table[65:91] = table[97:123]
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        table[self.space] = 0
        base = 0x5851F42D4C957F2D
        inverse = pow(base, -1, 1 << 64)
        self.table, self.base, self.inverse = table, base, inverse
        self.power = self._powers(base, block + 1)
        self.back = self._powers(inverse, block + 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, U64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def _grown(self, n: int) -> None:
        if n >= len(self.power):   # a single word longer than a block
            self.power, self.back = self._powers(self.base, n + 1), self._powers(self.inverse, n + 1)

    def words(self, raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, first bytes) of the words of ``raw``; no word crosses ``begins``."""
        n = len(raw)
        if not n:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        self._grown(n)
        inside = ~self.space[raw]
        cut = np.zeros(n + 1, bool)
        cut[begins] = True
        cut[n] = True
        after_space = np.ones(n + 1, bool)
        after_space[1:] = ~inside
        start = np.flatnonzero(inside & (after_space[:-1] | cut[:-1]))
        before_space = np.ones(n, bool)
        before_space[:-1] = ~inside[1:]
        end = np.flatnonzero(inside & (before_space | cut[1:]))
        total = np.zeros(n + 1, U64)
        np.cumsum(self.table[raw] * self.power[:n], out=total[1:])
        hashes = mix((total[end + 1] - total[start]) * self.back[start] + U64(0x632BE59BD9B4E019))
        if self.spelled and len(start):
            hashes = (hashes & ~U64(7)) | self._spelling(raw, start, end)
        return hashes, start

    def _spelling(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """0-3: words with a letter beyond ASCII, by the largest of its later
        bytes; 4-7: others, by whether they end in a letter and are long."""
        later = np.maximum.reduceat(np.where((raw >= 128) & (raw < 192), raw, 0), start)
        last = raw[end] | 32
        plain = 4 + 2 * ((last >= 97) & (last <= 122)) + (end - start >= 8)
        return np.where(later > 0, (later >> 2) & 3, plain).astype(U64)

    def _cuts(self, raw: np.ndarray) -> list[int]:
        """Ends of the parts of one long text, after a space where there is one within a block."""
        cuts, at = [], 0
        while len(raw) - at > self.block:
            hit = np.flatnonzero(self.space[raw[at: at + self.block]])
            if not len(hit):   # a word longer than a block: go on to its end
                size = self.block
                while not len(hit) and at + size < len(raw):
                    size *= 2
                    hit = np.flatnonzero(self.space[raw[at + size // 2: at + size]]) + size // 2
                if not len(hit):
                    break
                hit = hit[:1]
            at += int(hit[-1]) + 1
            cuts.append(at)
        return [*cuts, len(raw)]

    def blocks(self, column: pa.Array):
        """Yields (first row, word hashes, word offsets of the rows) for runs
        of rows that together are at most a block, or for one longer row."""
        raw, offsets = utf8(column)
        row, n = 0, len(offsets) - 1
        while row < n:
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + self.block, "right")) - 1)
            part = raw[offsets[row]: offsets[stop]]
            if stop == row + 1 and len(part) > self.block:
                lo, found = 0, []
                for hi in self._cuts(part):
                    found.append(self.words(part[lo:hi], np.zeros(1, np.int64))[0])
                    lo = hi
                hashes = np.concatenate(found)
                yield row, hashes, np.array([0, len(hashes)])
            else:
                begins = offsets[row: stop + 1] - offsets[row]
                hashes, start = self.words(part, begins[:-1][begins[:-1] < len(part)])
                yield row, hashes, np.searchsorted(start, begins)
            row = stop
