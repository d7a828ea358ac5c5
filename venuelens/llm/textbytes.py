"""Vectorised text primitives over Arrow string buffers.

An Arrow string column is one UTF-8 buffer plus row offsets, so words, lines, character classes
and hashes of thousands of documents can be computed with whole-buffer numpy operations, without
building Python strings. Rows are handled in blocks of a few megabytes (``blocks``), so the
temporary arrays stay bounded whatever the batch holds; a single longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

# Byte classes of the contracts' word patterns.
SPACE_WORD = np.ones(256, bool)  # [^\x20\x09-\x0D]+
SPACE_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM_WORD = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM_WORD[0x30:0x3A] = True
ALNUM_WORD[0x61:0x7B] = True
ALNUM_WORD[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
CODE_POINT = np.ones(256, bool)  # bytes that begin a code point
CODE_POINT[0x80:0xC0] = False

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_LETTERS = np.random.default_rng(1_000).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 12  # powers are products of one of 4,096 small ones and one of the large ones


def _power_table(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base % (1 << 64), np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_SMALL = {x: _power_table(x, 1 << _STEP) for x in (_BASE, pow(_BASE, -1, 1 << 64))}
_LARGE = {x: _power_table(pow(x, 1 << _STEP, 1 << 64), 1 << _STEP) for x in _SMALL}


def _large(base: int, n: int) -> np.ndarray:
    if len(_LARGE[base]) < n:
        _LARGE[base] = _power_table(pow(base, 1 << _STEP, 1 << 64), n)
    return _LARGE[base]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes of text each, at least one row each."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def each_block(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of each block of a column."""
    data, offs = text_buffer(column)
    for a, b in blocks(offs):
        part = data[offs[a] : offs[b]]
        yield a, b, (LOWER[part] if lower else part), offs[a : b + 1] - offs[a]


def each_window(column: pa.Array, table: np.ndarray, lower: bool = False, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Like ``each_block``, but a text longer than ``size`` comes as several windows of about that
    length, cut where no run of ``table`` bytes goes on; only one longer word stays whole."""
    data, offs = text_buffer(column)
    for a, b in blocks(offs, size):
        end, begin = int(offs[b]), int(offs[a])
        while True:
            stop = end if b - a > 1 else min(begin + size, end)
            while stop < end:
                ahead = data[stop : min(stop + size, end)]
                gap = np.flatnonzero(~table[LOWER[ahead] if lower else ahead])
                if len(gap):
                    stop += int(gap[0])
                    break
                stop = min(stop + size, end)
            part = data[begin:stop]
            where = offs[a : b + 1] - begin if b - a > 1 else np.array([0, stop - begin])
            yield a, b, (LOWER[part] if lower else part), where
            if stop >= end:
                break
            begin = stop


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the maximal runs of ``table`` bytes inside each row,
    and the index of each row's first word (one more entry than rows)."""
    if len(data) == 0:
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(offsets), np.int64)
    inside = table[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    before[heads] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    after[tails] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def rows_of(first: np.ndarray) -> np.ndarray:
    """Row number of each item, given the index of each row's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class SpanHasher:
    """64-bit hashes of byte spans of one buffer, from one running polynomial sum over it."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        rows = (n + (1 << _STEP) - 1) >> _STEP
        up = np.multiply.outer(_large(_BASE, rows)[:rows], _SMALL[_BASE]).ravel()[:n]
        up *= _LETTERS[data]
        self.run = np.zeros(n + 1, np.uint64)
        np.cumsum(up, out=self.run[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = pow(_BASE, -1, 1 << 64)
        down = _large(back, (len(self.run) >> _STEP) + 1)[starts >> _STEP] * _SMALL[back][starts & ((1 << _STEP) - 1)]
        return mix((self.run[ends] - self.run[starts]) * down + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    return SpanHasher(data)(starts, ends) if len(starts) else np.zeros(0, np.uint64)


def gram_hashes(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first) of the k-grams of consecutive items inside each row."""
    counts = np.maximum(np.diff(first) - (k - 1), 0)
    begin = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], counts)
    h = np.zeros(len(at), np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + hashes[at + j])
    return h, begin


def repeated_in_row(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(twice, later): items whose hash occurs twice or more in their row, and items that equal
    an earlier one of their row."""
    n = len(hashes)
    twice, later = np.zeros(n, bool), np.zeros(n, bool)
    if n > 1:
        order = np.lexsort((hashes, rows))  # stable: equal items keep their order
        same = (hashes[order][1:] == hashes[order][:-1]) & (rows[order][1:] == rows[order][:-1])
        later[order[1:]] = same
        twice[order[1:]] = same
        twice[order[:-1]] |= same
    return twice, later


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` per row, given the index of each row's first item."""
    run = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=run[1:])
    return run[first[1:]] - run[first[:-1]]


def histograms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte counts of each row, shape (rows, 256)."""
    out = np.zeros((len(offsets) - 1, 256), np.int64)
    for i in range(len(out)):
        out[i] = np.bincount(data[offsets[i] : offsets[i + 1]], minlength=256)
    return out


def map_rows(make: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function out of one from a batch to a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield make(batch)

    return run
