"""Language-model scoring with a probabilistic suffix tree over words.

A text's symbols are its lower-cased words and one end. The root gives a word
(c + 0.5) / (N + 0.5 (V + 1)), unknown words being one symbol. Deeper states are
the contexts of up to `depth` preceding symbols, a text's start reading as an
end. A context is a candidate if it occurs `least` times in training, and a
following word is counted by name if the two together do. `least` does not
depend on the input, so the tree grows with the corpus.

A candidate is retained if what follows it differs from what follows its longest
proper suffix: its count times the Kullback-Leibler divergence must reach `gain`
nats for every word it names. Its suffixes are retained with it. Counts are
discounted and the mass left goes to the suffix's distribution; every symbol is
scored by the longest retained suffix of what precedes it.

The tree is never in one place. All contexts that end in the same word are one
branch, so every symbol goes, with what precedes it, to the bucket of the word
before it; a bucket's task grows its branches, scores its symbols and drops both.
A word that precedes too many symbols has several buckets, dealt by the word
before it; counts of its followers come summed, and symbols that depend on
another bucket's retaining it wait for that. Counts of frequent words are
broadcast (at most FREQUENT), those of all others are joined.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import vec
from lakeloom.llm.common import drop_shuffles, id_crc, map_arrow, only, release, written
from lakeloom.llm.near_dedup import filter_places, id_filter

DISCOUNT = 0.75
#: At most so many of the most frequent words are broadcast: where a word's count is kept changes no score.
FREQUENT, TALLIED = 1_000_000, 10_000
#: A task sums about so many pairs with words of several buckets before it passes them on.
PAIRS = 500_000
#: About so many symbols of a bucket are in one step of growing it.
GROUP = 250_000
#: Symbols of a chunk, whose texts are dealt together.
CHUNK = 2_000_000
#: Sums travel in units of 1 / UNIT, so that they are exact and do not depend on the order of adding.
UNIT = 1 << 28
U64 = np.uint64
END = vec.mix(np.array([10], U64))[0]


def find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of values in a sorted table; -1 where they are missing."""
    if not len(table):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


@dataclass
class Level:
    """Contexts of one length. Entry keys are context << 32 | word."""

    entries: np.ndarray  # sorted keys
    counts: np.ndarray  # of the entries
    totals: np.ndarray  # of the contexts
    suffix: np.ndarray  # of each context, the context one shorter (none at length 1)
    context_of: np.ndarray  # of each entry, the context one longer that it is, or -1
    kept: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    rest: np.ndarray = field(default_factory=lambda: np.zeros(0))  # log10 of the mass each context leaves to its suffix
    ratio: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of each entry, log10 of its probability over the root's


class SuffixTree:
    """The model of one stream in memory, which scores() is held against. words: sorted hashes of the words that can have entries; first: the length-1 context of each, or -1."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, first: np.ndarray, root: np.ndarray):
        self.words, self.counts, self.first, self.root, self.levels = words, counts, first, root, []

    def ids(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the symbols of texts, ends included, -1 for rare words; and which symbols begin a text."""
        begins = np.zeros(len(hashes), bool)
        begins[bounds[:-1]] = True
        return find(self.words, hashes), begins

    def walk(self, ids: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length, the context of every symbol (-1: no candidate) and its entry (-1: not named); after the last level, the contexts still to be counted."""
        end = find(self.words, np.array([END], U64))[0]
        before = np.concatenate([[end], ids[:-1]])
        before[begins] = end
        context = np.where(before >= 0, self.first[before] if len(self.first) else -1, -1)
        for level in self.levels:
            entry = np.where((context >= 0) & (ids >= 0), find(level.entries, (context << 32) | ids), -1)
            yield context, entry
            longer = np.where(entry >= 0, level.context_of[entry] if len(level.context_of) else -1, -1)
            context = np.concatenate([[-1], longer[:-1]]) if len(longer) else longer
            context[begins] = -1
        yield context, np.full(len(ids), -1, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray, totals: np.ndarray, least: float) -> None:
        """Adds the entries counted for the next length; those of at least `least` become contexts one longer."""
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        context_of = np.full(len(keys), -1, np.int64)
        longer = np.flatnonzero(counts >= least)
        context_of[longer] = np.arange(len(longer))
        suffix = np.full(len(totals), -1, np.int64)
        if self.levels:
            last = self.levels[-1]
            made = np.flatnonzero(last.context_of >= 0)  # the entry that each context is
            word = last.entries[made] & 0xFFFFFFFF
            if len(self.levels) == 1:
                suffix = self.first[word]
            else:
                shorter = self.levels[-2]
                suffix = shorter.context_of[find(shorter.entries, (last.suffix[last.entries[made] >> 32] << 32) | word)]
        self.levels.append(Level(keys, counts, totals, suffix, context_of))

    def totals(self) -> np.ndarray:
        """Counts of the contexts of the next length."""
        if not self.levels:
            return self.counts[self.first >= 0]
        last = self.levels[-1]
        return last.counts[last.context_of >= 0]

    def ratio_at(self, depth: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 of P(word | context of that length) over the root's."""
        out, todo = np.zeros(len(context)), np.arange(len(context))
        for d in range(depth, 0, -1):
            level = self.levels[d - 1]
            entry = find(level.entries, (context[todo] << 32) | word[todo])
            out[todo] += np.where(entry >= 0, level.ratio[entry] if len(level.ratio) else 0.0, level.rest[context[todo]])
            todo = todo[entry < 0]
            if not len(todo):
                break
            context = context.copy()
            context[todo] = level.suffix[context[todo]]
        return out

    def finish(self, gain: float) -> None:
        """Smooths from the shortest contexts on, then tests divergences and retains from the longest on."""
        tests = []
        for d, level in enumerate(self.levels, 1):
            context, word = level.entries >> 32, level.entries & 0xFFFFFFFF
            total = level.totals[context]
            shorter = self.ratio_at(d - 1, level.suffix[context], word) if d > 1 else np.zeros(len(word))
            root = self.root[word]
            lower = 10 ** (shorter + root)
            n = len(level.totals)
            named = np.bincount(context, level.counts - DISCOUNT, n) / level.totals
            left = np.maximum(1 - named, 1e-9)
            level.rest = np.log10(left)
            p = (level.counts - DISCOUNT) / total + left[context] * lower
            level.ratio = np.log10(p) - root
            other = np.maximum(1 - np.bincount(context, lower, n), 1e-12)
            mass = np.maximum(1 - np.bincount(context, level.counts, n) / level.totals, 1e-12)
            divergence = np.bincount(context, level.counts * np.log(level.counts / total / lower), n) + level.totals * mass * np.log(mass / other)
            tests.append(divergence >= gain * np.bincount(context, minlength=n))
        kept = np.zeros(0, bool)
        for level, test in zip(reversed(self.levels), reversed(tests), strict=True):
            level.kept = test.copy()
            if len(kept):
                level.kept[longer_suffix[kept]] = True
            kept, longer_suffix = level.kept, level.suffix

    def log_ratios(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For every symbol, log10 of its probability by the longest retained suffix over the root's."""
        ids, begins = self.ids(hashes, bounds)
        steps = list(self.walk(ids, begins))[: len(self.levels)]
        out, todo = np.zeros(len(ids)), np.ones(len(ids), bool)
        for level, (context, entry) in zip(reversed(self.levels), reversed(steps), strict=True):
            at = np.flatnonzero(todo & (context >= 0))
            at = at[level.kept[context[at]]]
            named = entry[at] >= 0
            out[at] += np.where(named, level.ratio[entry[at]] if len(level.ratio) else 0.0, level.rest[context[at]])
            todo[at[named]] = False
        return out


def symbols(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: rows, the hashes of their words with an end after each text, and the bounds of each."""
    for i, j, data, offs in vec.slabs(column):
        data = vec.LOWER[data]
        starts, ends, bounds = vec.word_spans(data, offs)
        yield i, j, np.insert(vec.span_hashes(data, starts, ends), bounds[1:], END), bounds + np.arange(j - i + 1)


def frequent_from(tally: dict[int, int], distinct: int, tokens: int) -> int:
    """The least count, 2 at least, that at most FREQUENT words reach. tally: how many words have each count below TALLIED."""
    left = distinct
    for n in range(1, TALLIED + 1):
        if n >= 2 and left <= FREQUENT:
            return n
        left -= tally.get(n, 0)
    return max(2, -(-tokens // FREQUENT))  # no more words than that can occur so often


def counted(docs: DataFrame, fold: int) -> DataFrame:
    """key and n of the words of the training texts. Summed in each task before the exchange."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        k, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(k, kind="stable")
        k, c = k[order], c[order]
        first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
        return k[first], np.add.reduceat(c, first) if len(k) else c

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, fresh = [], 0
        for batch in batches:
            train = np.array([id_crc(x) % 5 != fold for x in batch.column(0).to_pylist()], bool)
            for i, j, hashes, bounds in symbols(batch.column(1)):
                parts.append(np.unique(hashes[np.repeat(train[i:j], np.diff(bounds))].view(np.int64), return_counts=True))
                fresh += len(parts[-1][0])
                if fresh > 2 * len(parts[0][0]) + 2_000_000:
                    parts = [merged(parts)]
                    fresh = len(parts[0][0])
        if parts:
            k, c = merged(parts)
            for a in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(k[a : a + 100_000]), pa.array(c[a : a + 100_000].astype(np.int64))], ["key", "n"])

    return map_arrow(docs, run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class Deal:
    """Which bucket each symbol goes to, and the counts that every task holds."""

    words: np.ndarray  # sorted hashes of the frequent words
    counts: np.ndarray
    below: float  # log10 of the root's denominator
    buckets: int
    heavy: np.ndarray  # sorted hashes of the words with several buckets
    salts: np.ndarray  # how many each has
    told: np.ndarray | None = None  # a Bloom filter of the words that are not frequent and yet occur `least` times
    rank: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))  # of each frequent word, the place by falling counts

    def __post_init__(self) -> None:
        order = np.argsort(-self.counts, kind="stable")
        self.rank = np.empty(len(order), np.uint32)
        self.rank[order] = np.arange(len(order), dtype=np.uint32)

    @cached_property
    def by_rank(self) -> np.ndarray:
        return self.words[np.argsort(self.rank)]

    @cached_property
    def rank_counts(self) -> np.ndarray:
        return self.counts[np.argsort(self.rank)]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Places among the frequent words; -1 for others."""
        own, words = pd.factorize(hashes)
        return find(self.words, words)[own]

    def nameless(self, hashes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which of the words are too rare to be contexts or to be named; place: those among the frequent words. The filter may take some of them for others, which changes no score."""
        out = place < 0
        if self.told is not None:
            rare = np.flatnonzero(out)
            at = filter_places(hashes[rare], 64 * len(self.told))
            out[rare] = ~((self.told[at >> 6] >> (at & 63).astype(U64)) & U64(1)).astype(bool).all(axis=1)
        return out

    def salted(self, last: np.ndarray, salt: np.ndarray) -> np.ndarray:
        return (vec.mix(last + salt.astype(U64) * U64(0x9E3779B97F4A7C15)) % U64(self.buckets)).astype(np.int32)

    def at(self, word: np.ndarray, last: np.ndarray, second: np.ndarray, have: np.ndarray) -> np.ndarray:
        """Buckets of symbols after `last`, before which comes `second` if at least two symbols precede."""
        place, salt = find(self.heavy, last), np.zeros(len(last), U64)
        many = np.flatnonzero(place >= 0)
        salt[many] = vec.mix(np.where(have[many] > 1, second[many], word[many])) % self.salts[place[many]].astype(U64)
        return self.salted(last, salt)


def preceding(hashes: np.ndarray, bounds: np.ndarray, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The symbols 1 to depth places before every symbol, and how many of them there are; the end before a text counts."""
    position = np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))
    longer = np.concatenate([np.full(depth, END, U64), hashes])
    return [longer[depth - d : len(longer) - d] for d in range(1, depth + 1)], np.minimum(position + 1, depth).astype(np.uint8)


def text_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each text's symbols: texts of one key have one score, whatever order rows are read in."""
    position = np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))
    return vec.mix(np.add.reduceat(vec.mix(hashes + vec.mix(position.astype(U64) + U64(1))), bounds[:-1])).view(np.int64)


def summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of pairs (place among the heavy words, hash of the word after it), in their order: each pair once."""
    place, word, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((word, place))
    place, word, n = place[order], word[order], n[order]
    first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (word[1:] != word[:-1])))
    return place[first], word[first], np.add.reduceat(n, first)


def branches(word: np.ndarray, before: list[np.ndarray], have: np.ndarray, weights: np.ndarray, root: np.ndarray, totals: np.ndarray, given: int, least: int, gain: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every symbol, log10 of its probability over the root's; the part of it that counts only if another bucket retains its shortest context; and the words that this bucket retains.

    Symbols are codes, weights 1 in training and 0 else. root: log10 of each code's probability there. totals: counts of the codes with several
    buckets, else -1; of these the last `given` symbols tell the counts of followers, as weights.
    """
    n, levels, last, entry_below = len(word), [], None, None
    real = np.ones(n, bool)
    real[n - given :] = False
    spread = totals[before[0]] >= 0
    for d, symbol in enumerate(before, 1):
        at = np.arange(n) if last is None else np.flatnonzero((last >= 0) & (have >= d) & real)
        weight = np.where(spread & real, 0, weights) if d == 1 else weights
        key = symbol[at].astype(np.int64) if last is None else (last[at].astype(np.int64) << 32) | symbol[at]
        keys, first, back = np.unique(key, return_index=True, return_inverse=True)
        del key
        total = np.bincount(back, weight[at], len(keys))
        if d == 1:
            total = np.where(totals[keys] >= 0, totals[keys], total)
        candidate = total >= least
        number = np.where(candidate, np.cumsum(candidate) - 1, -1).astype(np.int32)
        context = np.full(n, -1, np.int32)
        context[at] = number[back]
        total, rep = total[candidate], at[first[candidate]]
        del back
        at = np.flatnonzero(context >= 0)
        keys, first, back = np.unique((context[at].astype(np.int64) << 32) | word[at], return_index=True, return_inverse=True)
        count = np.bincount(back, weight[at], len(keys))
        named = count >= least
        entry = np.full(n, -1, np.int32)
        entry[at] = np.where(named, np.cumsum(named) - 1, -1).astype(np.int32)[back]
        del back
        count, of, it, example = count[named], keys[named] >> 32, keys[named] & 0xFFFFFFFF, at[first[named]]
        lower = 10 ** root[it] if d == 1 else levels[-1]["p"][entry_below[example]]
        m = len(total)
        left = np.maximum(1 - np.bincount(of, count - DISCOUNT, m) / total, 1e-9)
        p = (count - DISCOUNT) / total[of] + left[of] * lower
        other = np.maximum(1 - np.bincount(of, lower, m), 1e-12)
        mass = np.maximum(1 - np.bincount(of, count, m) / total, 1e-12)
        divergence = np.bincount(of, count * np.log(count / total[of] / lower), m) + total * mass * np.log(mass / other)
        kept = divergence >= gain * np.bincount(of, minlength=m)
        levels.append({"context": context, "entry": entry, "p": p, "ratio": np.log10(p) - root[it], "rest": np.log10(left), "kept": kept, "rep": rep})
        last, entry_below = context, entry
    for shorter, longer in zip(levels[-2::-1], levels[:0:-1], strict=True):
        shorter["kept"][shorter["context"][longer["rep"][longer["kept"]]]] = True
    out, waits, todo = np.zeros(n), np.zeros(n), real.copy()
    for d in range(len(levels), 0, -1):
        level = levels[d - 1]
        at = np.flatnonzero(todo & (level["context"] >= 0))
        context, entry = level["context"][at], level["entry"][at]
        value = level["rest"][context] if len(at) else np.zeros(0)
        value[entry >= 0] = level["ratio"][entry[entry >= 0]]
        sure = level["kept"][context]
        out[at[sure]] += value[sure]
        if d == 1:
            waits[at] = np.where(~sure & spread[at], value, 0.0)
        todo[at[sure & (entry >= 0)]] = False
    first = levels[0]
    return out, waits, before[0][first["rep"][first["kept"]]]


def packed(part: tuple) -> tuple[bytes, int]:
    raw = pickle.dumps(part, 5)
    return pa.compress(raw, codec="zstd", asbytes=True), len(raw)


def unpacked(blob: bytes, size: int) -> tuple:
    return pickle.loads(pa.decompress(blob, decompressed_size=size, codec="zstd"))


def small(x: np.ndarray, n: int) -> np.ndarray:
    return x.astype(np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.uint32)


def signed_planes(x: np.ndarray) -> bytes:
    """Byte planes of signed whole numbers, as many as the largest needs."""
    u = ((x << 1) ^ (x >> 63)).astype("<u8")
    return u.view(np.uint8).reshape(-1, 8).T[: max(1, -(-int(u.max(initial=0)).bit_length() // 8))].tobytes()


def from_signed_planes(raw: bytes, n: int) -> np.ndarray:
    u = np.zeros((8, n), np.uint8)
    u[: len(raw) // n] = np.frombuffer(raw, np.uint8).reshape(-1, n)
    u = np.ascontiguousarray(u.T).view("<u8").reshape(-1)
    return (u >> U64(1)).astype(np.int64) ^ -(u & U64(1)).astype(np.int64)


def planes(codes: np.ndarray) -> bytes:
    """The lowest bytes of all codes, then the next, up to the highest: frequent words have small codes, so that all but the first compress well."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def dealt(parts: list[tuple], deal: Deal, depth: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """A row for each bucket with symbols in `parts`: codes of every symbol and those before it, hashes of the rare words, how many precede, and of each text with symbols there its place in the chunk, its number of symbols and whether it is in training. A last row has the texts' keys and lengths, which pass through a bucket unread.

    A frequent word's code is its rank; all rare words have the next code, and their hashes are listed apart; nameless words have the code after that. No context holds
    a nameless word: symbols after one have the root's probability and stay, and those before it count for no context. Every row has a hash of the keys, by which rows
    of another order of texts would be found out.
    """
    hashes = np.concatenate([p[0] for p in parts])
    have = np.concatenate([p[1] for p in parts])
    keys, train = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts])
    length = np.concatenate([np.diff(p[2]) for p in parts])
    text = np.repeat(np.arange(len(keys), dtype=np.int32), length)
    mark = int(text_keys(keys.view(U64), np.array([0, len(keys)]))[0])
    own, words = pd.factorize(hashes)
    at_end = np.flatnonzero(words == END)  # every text has one
    own = np.concatenate([np.full(depth, at_end[0], own.dtype), own])
    n = len(hashes)
    last, second = own[depth - 1 : depth - 1 + n], own[max(0, depth - 2) : max(0, depth - 2) + n]
    bucket = deal.at(hashes, words[last], words[second], have)
    place = find(deal.words, words)
    nameless = deal.nameless(words, place)
    for d in range(2, depth + 1):
        have = np.where(nameless[own[depth - d : depth - d + n]], np.minimum(have, d - 1), have).astype(np.uint8)
    frequent = len(deal.words)
    codes = np.where(place >= 0, deal.rank[place] if frequent else 0, frequent + nameless).astype(np.uint32)[own]
    order = np.flatnonzero(~nameless[last])
    order = order[np.argsort(small(bucket[order], deal.buckets), kind="stable")]
    cuts = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else np.zeros(0, np.int64)
    rows = []
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
        at = order[a:b]
        grams = np.concatenate([at + depth - d for d in range(depth + 1)])
        code = codes[grams]
        rare, which = np.unique(own[grams[code == frequent]], return_inverse=True)
        texts, times = np.unique(text[at], return_counts=True)
        gaps = np.diff(texts, prepend=0)
        blob, size = packed((planes(code), words[rare], small(which, len(rare)), have[at], small(gaps, gaps.max() + 1), small(times, times.max() + 1), np.packbits(train[texts]), mark))
        rows.append((int(bucket[at[0]]), chunk, blob, None, size))
    blob, size = packed((keys, small(length, length.max() + 1), mark))
    rows.append((chunk % deal.buckets, chunk, None, blob, size))
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
    none = pa.nulls(len(rows), pa.int64())
    yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows, strict=True), kinds), none, none, none, none], ["bucket", "chunk", "blob", "texts", "size", "last", "word", "n", "c"])


def scores(docs: DataFrame, text: str = "text", fold: int = 1, depth: int = 3, least: int = 2, gain: float = 1.0, share: int = 2_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Texts whose crc32(doc_id as text) mod 5 is `fold` are held out of all counts; a null doc_id counts as the empty text. Null and empty texts are the end alone.
    Repeated rows count and are scored each; an empty table gives no rows. Without training texts both scores are 0. Words, and texts, count as equal if their 64-bit hashes are.
    `share` is about the number of symbols in a bucket; scores do not depend on it.
    """
    context = docs.sparkSession.sparkContext
    slim = only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    words = written(counted(slim, fold), "words")
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    drop_shuffles(docs.sparkSession)
    tokens, distinct = size["n"], size["v"]
    below = float(np.log10(tokens + 0.5 * (distinct + 1)))
    tally = dict(words.where(f"n < {TALLIED}").groupBy("n").count().collect())
    often = frequent_from(tally, distinct, tokens)
    got = words.where(F.col("n") >= often).toArrow()
    k, c = got.column("key").to_numpy().view(U64), got.column("n").to_numpy()
    order = np.argsort(k)
    k, c = k[order], c[order]
    many = c > share // 2
    between = words.where((F.col("n") < often) & (F.col("n") >= least))
    some = between.count()
    deal = Deal(k, c, below, max(1, math.ceil(1.25 * tokens / share)), k[many], -(-c[many] // max(1, share // 2)), id_filter(between.select("key"), some) if some else None)
    shared = context.broadcast(deal)

    def by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row = shared.value, TaskContext.get().partitionId() << 36
        root = np.log10(own.counts + 0.5) - own.below
        names = ["doc_id", "row", "text_key", "held_out", "n_tokens", "often", "log", "rare", "at", "last", "words", "times"]
        none = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        pairs, fresh = [], 0

        def followers() -> pa.RecordBatch:
            """A row for each heavy word, or for 50,000 of its followers."""
            place, word, n = summed(pairs)
            cuts = np.union1d(np.flatnonzero(np.append(True, place[1:] != place[:-1])), np.append(np.arange(0, len(n), 50_000), len(n)))
            lists = [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(x)) for x in (word.view(np.int64), n)]
            kinds = [pa.int64()] * 3 + [pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([*[pa.nulls(len(cuts) - 1, t) for t in kinds], pa.array(own.heavy[place[cuts[:-1]]].view(np.int64)), *lists], names)

        for batch in batches:
            held = np.array([id_crc(x) % 5 == fold for x in batch.column(0).to_pylist()], bool)
            for i, j, hashes, bounds in symbols(batch.column(1)):
                texts = j - i
                owner = np.repeat(np.arange(texts), np.diff(bounds))
                ids = own.ids(hashes)
                named = ids >= 0
                log = np.bincount(owner[named], root[ids[named]], texts)
                before, have = preceding(hashes, bounds, depth)
                rare = np.flatnonzero(~named)
                cuts = pa.array(np.searchsorted(owner[rare], np.arange(texts + 1)).astype(np.int32))
                at = np.where(own.nameless(hashes[rare], ids[rare]), -1, own.at(hashes[rare], before[0][rare], before[min(1, depth - 1)][rare], have[rare])).astype(np.int32)
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (hashes[rare].view(np.int64), at)]
                columns = [row + np.arange(texts), text_keys(hashes, bounds), held[i:j], np.diff(bounds), np.bincount(owner[named], minlength=texts), log]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, texts), *map(pa.array, columns), *lists, *[pa.nulls(texts, t) for t in none]], names)
                row += texts
                place = find(own.heavy, before[0])
                use = np.flatnonzero((place >= 0) & ~held[i:j][owner])
                if len(use):
                    pairs.append(summed([(place[use], hashes[use], np.ones(len(use), np.int64))]))
                    fresh += len(pairs[-1][0])
                if fresh > PAIRS:
                    yield followers()
                    pairs, fresh = [], 0
        if pairs:
            yield followers()

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, n, chunk = shared.value, [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            held = np.array([id_crc(x) % 5 == fold for x in batch.column(0).to_pylist()], bool)
            for i, j, hashes, bounds in symbols(batch.column(1)):
                position = np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))
                parts.append((hashes, np.minimum(position + 1, depth).astype(np.uint8), bounds, text_keys(hashes, bounds), ~held[i:j]))
                n += len(hashes)
                if n > CHUNK:
                    yield from dealt(parts, own, depth, chunk)
                    parts, n, chunk = [], 0, chunk + 1
        if parts:
            yield from dealt(parts, own, depth, chunk)

    def grown(blobs: list[tuple[int, bytes, int]], facts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        last, word, n, c = np.concatenate(facts, axis=1) if facts else np.zeros((4, 0), np.int64)
        if not blobs:
            return
        given = np.flatnonzero(n > 0)
        told = np.concatenate([last[given], word]).view(U64)
        frequent = len(own.words)
        place = find(own.words, told)
        columns, listed, have, places, train, of = [[] for _ in range(depth + 1)], [], [], [], [], []
        words_before = texts_before = 0
        while blobs:  # one after another, so that what is compressed and what is not are never held together
            chunk, x, size = blobs.pop()
            code, rare, which, some, gaps, times, bits, mark = unpacked(x, size)
            code = from_planes(code).view(np.int32)  # all codes are below 2**31
            at, nameless = np.flatnonzero(code == frequent), np.flatnonzero(code == frequent + 1)
            code[at] = frequent + words_before + which.astype(np.int32)
            own_word = np.minimum(np.arange(len(nameless)), np.searchsorted(nameless, len(some)))  # each is another word; those that precede count for nothing and share one
            code[nameless] = frequent + words_before + len(rare) + own_word.astype(np.int32)
            rare = np.append(rare, vec.mix(np.arange(words_before, words_before + own_word.max(initial=-1) + 1).astype(U64)))
            words_before += len(rare)
            for column, part in zip(columns, code.reshape(depth + 1, -1), strict=True):
                column.append(part)
            listed.append(rare)
            have.append(some)
            places.append((chunk, mark, gaps, texts_before))
            train.append(np.unpackbits(bits, count=len(gaps)).astype(bool))
            of.append(np.repeat(np.arange(texts_before, texts_before + len(gaps), dtype=np.int32), times))
            texts_before += len(gaps)
        rare, back = np.unique(np.concatenate([*listed, told[place < 0]]), return_inverse=True)
        tail = np.where(place >= 0, own.rank[place] if frequent else 0, 0).astype(np.int32)
        tail[place < 0] = frequent + back[words_before:]
        code_of = np.concatenate([np.arange(frequent), frequent + back[:words_before]]).astype(np.int32)
        grams = [np.concatenate(x) for x in columns]
        del columns, code, part, column
        met = np.zeros(len(code_of), bool)
        for g in grams:
            met[g] = True
        used = np.zeros(frequent + len(rare), bool)
        used[code_of[met]] = True
        used[tail] = True
        codes = np.flatnonzero(used)
        dense = (np.cumsum(used) - 1).astype(np.int32)
        tail, to = dense[tail], dense[code_of]
        more = np.zeros((depth + 1, len(given)), np.int32)
        more[1], more[0] = tail[: len(given)], tail[len(given) :][given]
        for d in range(depth + 1):
            grams[d] = np.concatenate([to[grams[d]], more[d]])
        known = np.concatenate([own.by_rank, rare])[codes]
        have = np.concatenate([*have, np.ones(len(given), np.uint8)])
        train, of = np.concatenate(train), np.concatenate(of)
        weights = np.concatenate([train[of].astype(np.int64), n[given]])
        count = np.zeros(len(codes), np.int64)
        often = codes < frequent
        count[often] = own.rank_counts[codes[often]]
        apart = place[len(given) :] < 0
        count[tail[len(given) :][apart]] = c[apart]
        spread = often & (find(own.heavy, known) >= 0)
        del code_of, met, used, dense, to, back
        root, totals = np.log10(count + 0.5) - own.below, np.where(spread, count, -1)
        out, waits, kept = np.zeros(len(of)), np.zeros(len(of)), []
        groups = -(-len(have) // GROUP)
        for g in range(groups):  # branches of different words know nothing of one another
            at = np.flatnonzero(grams[1] % groups == g)
            real = int(np.searchsorted(at, len(of)))
            value, wait, some = branches(grams[0][at], [x[at] for x in grams[1:]], have[at], weights[at], root, totals, len(at) - real, least, gain)
            out[at[:real]], waits[at[:real]] = value[:real], wait[:real]
            kept.append(some)
        kept = np.concatenate(kept)
        late = np.flatnonzero(waits)
        before, of_late, waits = grams[1][late], of[late], np.rint(waits[late] * UNIT)
        del grams, have, weights
        sums = np.bincount(of, np.rint(out * UNIT), texts_before).astype(np.int64)  # whole numbers below 2**53
        del out, of
        names = ["part", "texts", "keys", "size", "waits"]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        made = [(chunk, None, *packed((gaps, signed_planes(sums[a : a + len(gaps)]), mark)), None) for chunk, mark, gaps, a in places]
        yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made, strict=True), kinds)], names)
        starts = np.array([x[3] for x in places])
        for code in np.unique(before):
            at = np.flatnonzero(before == code)
            there, back = np.unique(of_late[at], return_inverse=True)
            sums, made = np.bincount(back, waits[at]).astype(np.int64), []
            of_place = np.searchsorted(starts, there, "right") - 1
            cuts = np.flatnonzero(np.append(True, np.diff(of_place) != 0))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(there)], strict=True):
                chunk, mark, gaps, first = places[of_place[a]]
                gaps = np.diff(np.cumsum(gaps, dtype=np.int64)[there[a:b] - first], prepend=0)
                made.append((chunk, None, *packed((small(gaps, gaps.max() + 1), signed_planes(sums[a:b]), mark)), int(known[code].view(np.int64))))
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made, strict=True), kinds)], names)
        retained = known[kept[spread[kept]]].view(np.int64)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(len(retained), t) for t in kinds[:-1]], pa.array(retained)], names)

    def means(listed: tuple[np.ndarray, np.ndarray, int] | None, lists: list[tuple]) -> pa.RecordBatch:
        """Of the texts of one chunk, by their symbols. Equal texts have equal means."""
        if listed is None or any(mark != listed[2] for *_, mark in lists):
            raise RuntimeError("the rows of a task came in another order when it ran again: write the documents to a table first")
        keys, length, _ = listed
        sums = np.zeros(len(keys), np.int64)
        for gaps, values, _ in lists:
            sums[np.cumsum(gaps, dtype=np.int64)] += from_signed_planes(values, len(gaps))
        keys, first = np.unique(keys, return_index=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums[first] / UNIT / length[first])], ["text_key", "mean"])

    def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, listed, lists = None, None, []
        for batch in batches:
            for part, texts, places, size in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if part != now and now is not None:
                    yield means(listed, lists)
                    listed, lists = None, []
                now = part
                if texts is None:
                    lists.append(unpacked(places, size))
                else:
                    listed = unpacked(texts, size)
        if now is not None:
            yield means(listed, lists)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs, facts = None, [], []
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if bucket[a] != now:
                    yield from grown(blobs, facts)
                    release()
                    now, blobs, facts = bucket[a], [], []
                part = batch.slice(a, b - a)
                blobs += [(c.as_py(), x.as_py(), y.as_py()) for c, x, y in zip(part.column(1), part.column(2), part.column(4), strict=True) if x.is_valid]
                listed = part.filter(part.column(3).is_valid())
                yield pa.RecordBatch.from_arrays([listed.column(1), listed.column(3), pa.nulls(len(listed), pa.binary()), listed.column(4), pa.nulls(len(listed), pa.int64())], ["part", "texts", "keys", "size", "waits"])
                rows = part.filter(part.column(6).is_valid())
                facts.append(np.array([rows.column(x).fill_null(0).to_numpy(zero_copy_only=False) for x in range(5, 9)], np.int64))
        yield from grown(blobs, facts)

    spark = docs.sparkSession
    scored = written(map_arrow(slim, by_text, "doc_id bigint, row bigint, text_key bigint, held_out boolean, n_tokens bigint, often bigint, log double, rare array<bigint>, at array<int>, last bigint, words array<bigint>, times array<bigint>"), "scored")
    pairs, scored = scored.where("last is not null").select("last", F.explode(F.arrays_zip("words", "times")).alias("x")), scored.where("last is null").drop("last", "words", "times")
    places = [(int(h.view(np.int64)), int(b)) for h, m in zip(deal.heavy, deal.salts, strict=True) for b in np.unique(deal.salted(np.full(m, h, U64), np.arange(m)))]
    homes = spark.createDataFrame(places, "last bigint, bucket int")
    counts = words.select(F.col("key").alias("word"), F.col("n").alias("c"))
    given = pairs.groupBy("last", F.col("x.words").alias("word")).agg(F.sum("x.times").alias("n")).where(F.col("n") >= least).join(counts, "word").join(F.broadcast(homes), "last").select("bucket", "last", "word", "n", "c")
    asked = scored.where("not held_out").select(F.explode(F.arrays_zip("rare", "at")).alias("x")).select(F.col("x.at").alias("bucket"), F.col("x.rare").alias("word")).where("bucket >= 0").distinct()
    told = asked.join(counts.where((F.col("c") < often) & (F.col("c") >= least)), "word").select("bucket", F.lit(None).cast("long").alias("last"), "word", F.lit(0).cast("long").alias("n"), "c")
    facts = (given.unionByName(told) if some else given).select("bucket", F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("binary").alias("blob"), F.lit(None).cast("binary").alias("texts"), F.lit(None).cast("long").alias("size"), "last", "word", "n", "c")
    sent = map_arrow(slim, by_bucket, "bucket int, chunk bigint, blob binary, texts binary, size bigint, last bigint, word bigint, n bigint, c bigint").unionByName(facts)
    parts = written(map_arrow(sent.repartition(deal.buckets, "bucket").sortWithinPartitions("bucket"), grow, "part bigint, texts binary, keys binary, size bigint, waits bigint"), "parts")
    drop_shuffles(spark)  # of the symbols, which is most of the disk
    kept = parts.where("part is null").select("waits").distinct()
    sure = parts.where("part is not null and waits is null")
    late = parts.where("part is not null and waits is not null").join(kept, "waits", "left_semi").select(*parts.columns)
    deeper = map_arrow(sure.unionByName(late).drop("waits").repartition(deal.buckets, "part").sortWithinPartitions("part"), by_part, "text_key bigint, mean double").groupBy("text_key").agg(F.min("mean").alias("mean"))  # a text in several chunks has one mean
    met = scored.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count("*").alias("times"))
    known = F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)
    rest = met.join(words.where(F.col("n") < often), "key", "left").groupBy("row").agg(F.sum(known).alias("rare_known"), F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 0.5) - F.lit(below))).alias("rare_log"))
    base = F.col("log") + F.coalesce("rare_log", F.lit(0.0))
    more = F.col("mean") * F.col("n_tokens")
    return scored.drop("rare", "at").join(rest, "row", "left").join(deeper, "text_key", "left").select("doc_id", "held_out", "n_tokens", (F.col("often") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.coalesce(more, F.lit(0.0))).alias("score"))
