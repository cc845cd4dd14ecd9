"""Vectorised text kernels over Arrow string buffers (numpy only, no per-word Python).

A *piece* is a slice of an Arrow batch of at most about half a megabyte of text (one
longer document is a piece of its own), so a worker's temporaries stay bounded
whatever the batch size.  A word's hash adds up its 8-byte lanes, each put through an
avalanche mix with its place and the seed; a run of words is hashed as a tree of halves
with a multiply and shift at every joint.  Neither is linear in what it hashes, so
structured texts (Thue-Morse sequences and the like) don't collide, and hashes of two
seeds are independent.  Wherever equality of texts is decided by hash alone, two are used.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

PIECE_BYTES = 512 << 10
_U = np.uint64
_MAX = _U(0xFFFFFFFFFFFFFFFF)
_STEP = _U(0x9E3779B97F4A7C15)
#: Low bytes of a lane that belong to a word of that many bytes.
_LANE = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche finaliser (xor-shift-multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def class_table(member) -> np.ndarray:
    """256 booleans: whether a byte belongs to a word."""
    return np.fromiter((member(b) for b in range(256)), bool, 256)


NOT_SPACE = class_table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
ALNUM = class_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.fromiter((b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)), np.uint8, 256)


def as_strings(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    return column


def pieces(column, limit: int = PIECE_BYTES):
    """(first row, end row, bytes as uint8, offsets) of consecutive slices; null is empty text."""
    column = as_strings(column)
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, n + 1 + column.offset)[column.offset :].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Words:
    """Word boundaries of a piece: byte spans, word number range of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray = NOT_SPACE, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.rows = len(offsets) - 1
        inside = table[self.data]
        n = len(inside)
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        edges = offsets[:-1][offsets[:-1] < n]
        before[edges] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        ends = offsets[1:][offsets[1:] > 0] - 1
        after[ends] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        #: first word of each row, and one past the last of all
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.n = len(self.start)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.count)

    def last_of(self) -> np.ndarray:
        """For each word, one past the last word of its row."""
        return np.repeat(self.first[1:], self.count)

    def hashes(self, seed: int = 1) -> np.ndarray:
        size = self.end - self.start
        lanes = (size + 7) >> 3
        first = np.cumsum(lanes) - lanes
        of = np.repeat(np.arange(self.n), lanes)
        k = np.arange(len(of)) - first[of]
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        lane = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))[self.start[of] + 8 * k]
        lane &= _LANE[np.minimum(size[of] - 8 * k, 8)]
        lane = mix(lane + (k + 1).astype(_U) * _STEP + mix(np.full(1, seed, _U)))
        total = np.add.reduceat(lane, first) if self.n else np.zeros(0, _U)
        return mix(total + size.astype(_U) * _U(0xA0761D6478BD642F))


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two runs, one after the other."""
    x = (a ^ (a >> _U(32))) * _U(0x9FB21C651E98DF25) + b
    return (x ^ (x >> _U(29))) * _U(0xD6E8FEB86659FD93)


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    """x[i + by], zero beyond the end."""
    out = np.zeros_like(x)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


class Windows:
    """Hashes of runs of consecutive words, by doubling; the lengths asked for last are kept."""

    def __init__(self, word_hashes: np.ndarray):
        self.words = word_hashes
        self.have: dict[int, np.ndarray] = {}

    def every(self, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each place on (of no use where they don't fit)."""
        if length not in self.have:
            span, size, out, done = self.words, 1, None, 0
            while True:  # lowest binary digits first
                if length & size:
                    out = span if out is None else _join(out, _ahead(span, done))
                    done += size
                if done == length:
                    break
                span, size = _join(span, _ahead(span, size)), 2 * size
            if len(self.have) > 3:
                self.have.pop(next(iter(self.have)))
            self.have[length] = mix(out + _U(length))
        return self.have[length]

    def at(self, first: np.ndarray, length) -> np.ndarray:
        """Hash of the words [first, first + length); length is one number or one of few for each."""
        if np.ndim(length) == 0:
            return self.every(int(length))[first] if int(length) else np.zeros(len(first), _U)
        out = np.zeros(len(first), _U)
        for n in np.unique(length):
            if n:
                own = length == n
                out[own] = self.every(int(n))[first[own]]
        return out


def row_hashes(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of all words of each row, which ``first`` bounds."""
    count = np.diff(first)
    place = np.arange(len(words)) - np.repeat(first[:-1], count)
    return mix(row_sums(mix(words + (place + 1).astype(_U) * _STEP), first) + count.astype(_U) * _U(0xA0761D6478BD642F))


def slide(values: np.ndarray, width: int, op) -> np.ndarray:
    """out[i] = op over values[i : i + width], shorter at the end; by doubling spans."""
    out, span = values, 1
    while span < width:
        step = min(span, width - span)
        nxt = out.copy()
        if step < len(out):
            nxt[:-step] = op(out[:-step], out[step:])
        out, span = nxt, span + step
    return out


def winnow(grams: np.ndarray, starts_ok: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the minimum of some run of ``width`` grams which starts where ``starts_ok``.

    Equal minima in one run are all taken, so the choice depends on content alone.
    """
    least = np.where(starts_ok, slide(grams, width, np.minimum), _U(0))
    most = slide(least[::-1], width, np.maximum)[::-1]
    return np.flatnonzero((most == grams) & (grams != _MAX) & (grams != 0))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values between consecutive entries of ``first`` (empty runs: zero)."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def unsigned(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def ship(name: str) -> None:
    """Send a module's functions to Python workers by value: workers need not be able to import it."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship(__name__)
