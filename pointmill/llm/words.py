"""Vectorised word splitting and hashing over Arrow string batches.

A word is a maximal run of UTF-8 bytes that a table marks as word bytes, which
equals the character classes of the callers because each separator is ASCII.
Hashes are 64-bit polynomials of the bytes. Work goes in blocks of about 64 KB,
cut between words, so a very long text needs no more memory than its own words.
Null texts have no words.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 16
_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK + (1 << 16))
            self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class WordRule:
    """Which bytes belong to words, and what each counts as (A-Z may be lower-cased)."""

    is_word: np.ndarray
    shown: bytes
    value: np.ndarray

    @staticmethod
    def of(separators: set[int], lower: bool) -> "WordRule":
        shown = bytes(b + 32 if lower and 65 <= b <= 90 else b for b in range(256))
        is_word = np.array([b not in separators for b in range(256)])
        seeds = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        return WordRule(is_word, shown, seeds[np.frombuffer(shown, np.uint8)])


SPACES = {0x20, *range(0x09, 0x0E)}
#: Lower-cased words of letters, digits and everything beyond ASCII.
ALNUM = WordRule.of({b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90)}, True)
#: Words between white space, lower-cased or as they are.
SPACED_LOWER, SPACED = WordRule.of(SPACES, True), WordRule.of(SPACES, False)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n+1 offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


@dataclass
class Words:
    """All words of a batch: row r has words first[r]:first[r+1]."""

    raw: np.ndarray
    rule: WordRule
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count())

    def bytes_of(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.end[i]].tobytes().translate(self.rule.shown)

    def text(self, i: int) -> str:
        return self.bytes_of(i).decode("utf-8", "replace")

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of k words from each word on, whether they lie in one row)."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        h = self.hash[:n].copy()
        for j in range(1, k):
            h *= _STEP
            h += self.hash[j : j + n]
        last = np.repeat(self.first[1:], self.count())[:n]
        return mix(h + np.uint64(k)), np.arange(n) + k <= last


def split(column: pa.Array, rule: WordRule) -> Words:
    raw, offsets = utf8(column)
    starts, ends, hashes = [], [], []
    at, total = 0, len(raw)
    bounds = np.zeros(total + 1, bool)
    bounds[offsets] = True
    while at < total:
        stop = min(at + BLOCK, total)
        while stop < total:  # cut between words
            gaps = np.flatnonzero(~rule.is_word[raw[at:stop]][::-1])
            edge = np.flatnonzero(bounds[at + 1 : stop + 1][::-1])
            cuts = [stop - at - int(g[0]) for g in (gaps, edge) if len(g)]
            if cuts:
                stop = at + max(cuts)
                break
            stop = min(stop + BLOCK, total)
        b = raw[at:stop]
        inside = rule.is_word[b]
        new = bounds[at:stop]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | new[1:]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:] | new[1:]
        s, e = np.flatnonzero(begins), np.flatnonzero(finish) + 1
        up, down = _POWERS.get(len(b))
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(rule.value[b] * up, out=sums[1:])
        hashes.append(mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)))
        starts.append(s + at)
        ends.append(e + at)
        at = stop
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(
        raw,
        rule,
        start,
        np.concatenate(ends) if ends else np.zeros(0, np.int64),
        np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
        np.searchsorted(start, offsets),
    )


def release() -> None:
    """Give freed memory back to the system where its C library can; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def parts(batches, column: str = "text", size: int = 1 << 22):
    """The batches in slices of about so many text bytes, so that what is derived from one slice stays small."""
    for b in batches:
        _, offsets = utf8(b[column])
        lo = 0
        while lo < b.num_rows:
            hi = min(max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size))), b.num_rows)
            yield b.slice(lo, hi - lo)
            lo = hi
            release()
