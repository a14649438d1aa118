"""Vectorised byte-span helpers shared by the text operators.

Everything here works on whole Arrow batches: the UTF-8 bytes of many texts
lie in one numpy array, spans are pairs of start and end positions, and a span
is known by a 64-bit polynomial hash that needs no Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SPLIT, _BASE = U64(0xBF58476D1CE4E5B9), 0x9E3779B97F4A7C15
_VAL = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_POW = _INV = np.ones(1, U64)
GROUP = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * _SPLIT
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse; grown to the longest span seen."""
    global _POW, _INV
    if len(_POW) < n:
        n = max(n, GROUP + 1)
        _POW, _INV = (np.concatenate([np.ones(1, U64), np.cumprod(np.full(n - 1, b, U64), dtype=U64)]) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    return _POW[:n], _INV[:n]


def slabs(column: pa.Array | pa.ChunkedArray, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `limit` bytes: first row, end row, bytes, offsets. Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # of several chunks that do not fit one
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return
    offs = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and offs[-1] else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        j = min(j, len(column))
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def word_spans(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes outside `sep`, cut at text borders; `bounds[d]:bounds[d+1]` are the spans of text d."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = ~sep[data]
    first = np.zeros(n + 1, bool)
    first[offs] = True
    after, before = np.zeros(n, bool), np.zeros(n, bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ordered spans that depend on a span's bytes only. Spans are taken together as far as they lie within GROUP bytes, so that no table is as long as a long text."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + GROUP, "right")))
        a, b = starts[i:j] - lo, ends[i:j] - lo
        n = int(b[-1])
        power, inverse = _powers(n + 1)
        total = np.zeros(n + 1, U64)
        np.cumsum(_VAL[data[lo : lo + n]] * power[:n], out=total[1:])
        out[i:j] = mix((total[b] - total[a]) * inverse[a] + (b - a).astype(U64))
        i = j
    return out


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of k following words, the text of each and the word each begins at. A text with 1 to k-1 words has one shingle, of all of them; one without words has none."""
    n_words = np.diff(bounds)
    text = np.repeat(np.arange(len(n_words)), n_words)
    if len(words) >= k:
        h = words[: len(words) - k + 1].copy()
        for j in range(1, k):
            h = h * U64(_BASE) + words[j : len(words) - k + 1 + j]
        at = np.flatnonzero(text[: len(h)] == text[k - 1 :])
        h = mix(h[at] + U64(k))
    else:
        h, at = np.zeros(0, U64), np.zeros(0, np.int64)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        extra = words[bounds[short]]
        for j in range(1, k - 1):
            more = n_words[short] > j
            extra[more] = extra[more] * U64(_BASE) + words[bounds[short][more] + j]
        extra = extra + n_words[short].astype(U64)
        h, at = np.concatenate([h, mix(extra)]), np.concatenate([at, bounds[short]])
        order = np.argsort(at, kind="stable")
        h, at = h[order], at[order]
    return h, text[at] if len(at) else np.zeros(0, np.int64), at


def gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs pool[start:start+size], concatenated."""
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return pool[:0]
    return pool[np.repeat(start - (ends - size), size) + np.arange(ends[-1])]
