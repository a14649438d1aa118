"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted-shingle similarity.

Words are runs of letters, digits and underscores of the lower-cased text,
shingles are five words. An item of m shingles is looked for with windows of s
shingles, s being the largest size of a geometric ladder up to 0.8 m. The
fingerprints of all the item's windows of s shingles are indexed, and texts are
fingerprinted at every t-th shingle, t being m - s + 1 for the smallest item of
that size: a copied passage always holds a window equal to an indexed one.

64-bit fingerprints within `radius` differ by at most radius // 4 bits in one of
four 16-bit blocks; the index lists, for each block value, all fingerprints that
near, so none within the radius is missed. Candidates are verified by the exact
similarity of shingle multisets, sum of minima over sum of maxima, for windows
of the item's size around the match.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from lakeloom.llm import vec
from lakeloom.llm.common import held, map_arrow, only

WORDS = 5
RUN = 12288
SEPARATOR = np.ones(256, bool)
SEPARATOR[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = False
_LADDER = [1, 2, 3, 4, 5, 6, 7, 8]
while _LADDER[-1] < 1 << 24:
    _LADDER.append(max(_LADDER[-1] + 1, int(_LADDER[-1] * 1.2)))


def text_shingles(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: first row, end row, shingle hashes, the text of each, the word each begins at (within its text) and the shingle bounds of each text."""
    for i, j, data, offs in vec.slabs(pc.utf8_lower(column), limit):
        starts, ends, bounds = vec.word_spans(data, offs, SEPARATOR)
        h, text, at = vec.shingle_hashes(vec.span_hashes(data, starts, ends), bounds, WORDS)
        yield i, j, h, text, at - bounds[text], np.searchsorted(text, np.arange(j - i + 1))


class WindowSums:
    """Per bit, the number of shingles in a window that have it set: sums over windows of 1, 2, 4, ... shingles, of which every size is made."""

    def __init__(self, h: np.ndarray, longest: int):
        kind = np.uint8 if longest < 256 else np.uint32
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(kind, copy=False)
        self.levels = [bits]
        while 2 << (len(self.levels) - 1) <= min(longest, len(h)):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(last[:-half] + last[half:])

    def fingerprints(self, starts: np.ndarray, s: int) -> np.ndarray:
        """SimHash of the windows [start, start + s): a bit is set where more than half of the shingles, repeats counted, have it."""
        total, at = None, starts
        for level, sums in enumerate(self.levels):
            if s >> level & 1:
                part = sums[at]
                total = part if total is None else np.add(total, part, out=total)
                at = at + (1 << level)
        return np.packbits(total > s // 2, axis=1, bitorder="little").view("<u8").reshape(-1)


class HammingIndex:
    """Multi-index over 64-bit fingerprints: for each of four 16-bit blocks, every value's list of fingerprints with that block within radius // 4."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius, near = prints, radius, min(radius // 4, 16)
        masks = np.array([sum(1 << b for b in c) for n in range(near + 1) for c in combinations(range(16), n)], np.uint32)
        self.blocks = []
        for b in range(4):
            value = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint32)
            keys = (value[:, None] ^ masks).reshape(-1)
            order = np.argsort(keys, kind="stable")
            self.blocks.append((np.searchsorted(keys[order], np.arange(65537)), (order // len(masks)).astype(np.int32)))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, fingerprint) within the radius; each pair once."""
        found_q, found_p = [], []
        for b, (cuts, lists) in enumerate(self.blocks):
            value = ((queries >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            size = cuts[value + 1] - cuts[value]
            q = np.repeat(np.arange(len(queries)), size)
            p = vec.gather(lists, cuts[value], size)
            hit = np.bitwise_count(queries[q] ^ self.prints[p]) <= self.radius
            found_q.append(q[hit])
            found_p.append(p[hit])
        pairs = np.unique(np.concatenate(found_q) * len(self.prints) + np.concatenate(found_p))
        return pairs // len(self.prints), pairs % len(self.prints)


class BenchmarkIndex:
    """Fingerprints of a block of benchmark items, by window size. An item is given with its id, its text and which of how many equal parts of its windows are indexed here."""

    def __init__(self, items: list[tuple[int, str | None, int, int]], radius: int):
        self.ids = [i for i, *_ in items]
        self.sets: list[np.ndarray] = []
        for _, _, h, _, _, bounds in text_shingles(pa.array([x[1] for x in items], pa.string())):
            self.sets += [h[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        self.sizes = {}
        by_size: dict[int, list[int]] = {}
        for k, h in enumerate(self.sets):
            if len(h):
                by_size.setdefault(max(x for x in _LADDER if x <= max(1, 0.8 * len(h))), []).append(k)
        for s, members in by_size.items():
            offsets = [np.array_split(np.arange(len(self.sets[k]) - s + 1), items[k][3])[items[k][2]] for k in members]
            prints = [WindowSums(self.sets[k], s).fingerprints(at, s) for k, at in zip(members, offsets, strict=True)]
            item = np.repeat(members, [len(p) for p in prints])
            offset = np.concatenate(offsets)
            if not len(item):
                continue
            self.sizes[s] = (min(len(self.sets[k]) for k in members) - s + 1, item, offset, HammingIndex(np.concatenate(prints), radius))
        self.counts = [Counter(h.tolist()) for h in self.sets]
        self.ordered = [np.unique(h) for h in self.sets]

    def similarity(self, k: int, window: np.ndarray) -> float:
        """Sum of minima over sum of maxima of the two shingle multisets."""
        own = self.counts[k]
        both = sum(min(n, own[x]) for x, n in Counter(window.tolist()).items() if x in own)
        return both / (len(window) + len(self.sets[k]) - both)

    def matches(self, h: np.ndarray, text: np.ndarray, bounds: np.ndarray, least: float) -> dict[tuple[int, int], tuple[float, int, int]]:
        """For (text, item): the best similarity of at least `least`, and its window of shingles (the leftmost among equals)."""
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        longest = max(self.sizes, default=0)
        near: list[np.ndarray] = []
        for lo in range(0, len(h), RUN):  # runs of shingles whose sums stay in the cache
            sums = WindowSums(h[lo : lo + RUN + longest], longest)
            for s, (step, item, offset, index) in self.sizes.items():
                starts = np.arange(-(-lo // step) * step, min(lo + RUN, len(h) - s + 1), step)
                starts = starts[text[starts] == text[starts + s - 1]] if len(starts) else starts
                if len(starts):
                    q, p = index.search(sums.fingerprints(starts - lo, s))
                    near.append(np.stack([text[starts[q]], item[p], starts[q] - offset[p]]))
        for d, k, a in np.unique(np.concatenate(near, axis=1), axis=1).T.tolist() if near else ():
            m, lo, hi = len(self.sets[k]), int(bounds[d]), int(bounds[d + 1])
            reach = m // 4 + 1
            if (had := best.get((d, k), (0.0, 0, 0)))[0] == 1 and a >= had[1]:
                continue
            base, top = max(lo, a - reach), min(hi, a + m + reach)
            region = h[base:top]
            known = self.ordered[k][np.minimum(np.searchsorted(self.ordered[k], region), len(self.ordered[k]) - 1)] == region
            if known.sum() * (1 + least) < least * (m + min(m, len(region))):  # bounds the intersection
                continue
            for x in [a] if a >= lo and a + m <= hi and np.array_equal(h[a : a + m], self.sets[k]) else range(base, max(base, top - m) + 1):
                y = min(x + m, hi)
                sim, had = self.similarity(k, h[x:y]), best.get((d, k), (0.0, 0, 0))
                if sim >= least and (sim, -x) > (had[0], -had[1]):
                    best[d, k] = (sim, x, y)
        return best


def block_matches(docs: DataFrame, items: list[tuple[int, str | None, int, int]], radius: int, least: float) -> DataFrame:
    shared, key = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held(key, lambda: BenchmarkIndex(shared.value, radius))
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for i, _, h, text, at, bounds in text_shingles(batch.column(1)):
                for (d, k), (sim, x, y) in index.matches(h, text, bounds, least).items():
                    out.append((ids[i + d], index.ids[k], sim, int(at[x]), int(at[y - 1]) + WORDS))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()))], ["doc_id", "item_id", "similarity", "first_word", "end_word"])

    return map_arrow(docs, run, "doc_id bigint, item_id bigint, similarity double, first_word int, end_word int", holds=True)


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", radius: int = 15, least: float = 0.8, block_windows: int = 12_000) -> DataFrame:
    """One row for each document and benchmark item with a window of similarity of at least `least`: doc_id, item_id, similarity (of the best window), first_word and end_word (its words).

    The benchmark is searched in blocks of about `block_windows` windows (11 kB of index each), all blocks against all documents, so that no task or broadcast
    grows with it; an item of very many windows is in several blocks. Null and empty texts match nothing, and an empty table of either kind gives no rows.
    A text or item of fewer than five words has them all as its one shingle. Rows with equal ids count as one; items of equal ids and texts are one.
    """
    slim = only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = only(benchmark, item_id="item_id", text="text").select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").distinct()
    words = F.size(F.split("text", r"[^\p{L}\p{N}_]+"))
    share = F.greatest(F.lit(1), F.ceil(words * 0.36 / (block_windows / 4))).cast("int")  # a fifth to a third of an item's words begin a window
    parts = items.withColumn("parts", share).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    total = items.agg(F.sum(words * 0.36 + 1).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(total / block_windows))
    out = None
    for b in range(blocks):
        mine = parts.where(F.pmod(F.xxhash64("item_id", "text", "part"), F.lit(blocks)) == b)
        block: list[Row] = mine.orderBy("item_id", "text", "part").select("item_id", "text", "part", "parts").collect()
        found = block_matches(slim, [tuple(r) for r in block], radius, least)
        out = found if out is None else out.unionAll(found)
    best = F.max_by(F.struct("similarity", "first_word", "end_word"), F.struct("similarity", -F.col("first_word"))).alias("best")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows whose text holds no leak, judged by text: ids, null or repeated, decide nothing. Texts count as equal if their 64-bit hashes are."""
    key = F.xxhash64(F.col(f"`{text}`").cast("string"))
    hit = leaks(docs.select(key.alias("doc_id"), F.col(f"`{text}`").alias("text")), benchmark, **options).select(F.col("doc_id").alias("leaked")).distinct()
    return docs.join(hit, key == F.col("leaked"), "left_anti")
