"""Encoding texts by stretches that a pre-tokenizer can never join, with a bounded memo for each worker.

Stretches are known by their bytes, so that none is ever taken for another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from lakeloom.llm import vec

#: First bytes that begin a character which is surely not white space; bytes that may begin one (C2, E1, E2, E3) and controls are left out.
SOLID = np.zeros(256, bool)
SOLID[0x21:0x7F] = True
SOLID[0xC3:0xF8] = True
SOLID[[0xE1, 0xE2, 0xE3]] = False
ALNUM, PUNCT = np.zeros(256, bool), np.zeros(256, bool)
PUNCT[0x21:0x7F] = True
for _range in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    ALNUM[slice(*_range)], PUNCT[slice(*_range)] = True, False
RUN = 4096


def solid_cuts(data: np.ndarray) -> np.ndarray:
    """Positions of spaces that a solid character follows: the pattern of byte-level BPE always begins a word there, whatever stands before."""
    return np.flatnonzero((data[:-1] == 32) & SOLID[data[1:]]) if len(data) > 1 else np.zeros(0, np.int64)


def word_cuts(data: np.ndarray) -> np.ndarray:
    """solid_cuts, and the positions of ASCII signs that an ASCII letter or digit precedes: there a word ends and another begins, whatever else stands on either side. Words then are known with and without a comma."""
    if len(data) < 2:
        return np.zeros(0, np.int64)
    return np.sort(np.concatenate([solid_cuts(data), np.flatnonzero(ALNUM[data[:-1]] & PUNCT[data[1:]]) + 1]))


class Memo:
    """A bounded table from byte strings to runs of integers, looked up for whole arrays.

    Strings are found by hash and then compared byte for byte; one whose hash another holds goes to a side table. When all of it passes `limit`
    bytes it starts anew, so that its size never follows the input.
    """

    def __init__(self, limit: int, dtype=np.uint32):
        self.limit, self.dtype = limit, dtype
        self.clear()

    def clear(self) -> None:
        self.table = np.full(1 << 12, -1, np.int32)  # open addressing: places by hash
        self.hash = np.zeros(1 << 11, np.uint64)
        self.key, self.length, self.start, self.size = (np.zeros(1 << 11, np.int64) for _ in range(4))
        self.keys, self.pool = np.zeros(1 << 14, np.uint8), np.zeros(1 << 14, self.dtype)
        self.side: dict[bytes, int] = {}
        self.count = self.used = self.filled = 0

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Of each hash, the slot that holds it or the first free one."""
        mask = np.uint64(len(self.table) - 1)
        slot = (h & mask).astype(np.int64)
        todo = np.arange(len(h))
        while len(todo):
            place = self.table[slot[todo]]
            todo = todo[(place >= 0) & (self.hash[place] != h[todo])]
            slot[todo] = (slot[todo] + 1) & int(mask)
        return slot

    def find(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the strings data[offs[i]:offs[i+1]], -1 for those that are missing, and their hashes."""
        h = vec.span_hashes(data, offs[:-1], offs[1:])
        place = self.table[self.slots(h)].astype(np.int64)
        size = np.diff(offs)
        at = np.flatnonzero(place >= 0)
        at = at[self.length[place[at]] == size[at]]
        sure = np.full(len(h), -1, np.int64)
        if len(at):
            same = vec.gather(data, offs[:-1][at], size[at]) == vec.gather(self.keys, self.key[place[at]], size[at])
            wrong = np.concatenate([[0], np.cumsum(~same)])
            ends = np.concatenate([[0], np.cumsum(size[at])])
            at = at[wrong[ends[1:]] == wrong[ends[:-1]]]
            sure[at] = place[at]
        if self.side:
            for i in np.flatnonzero((sure < 0) & (place >= 0)).tolist():
                sure[i] = self.side.get(data[offs[i] : offs[i + 1]].tobytes(), -1)
        return sure, h

    def room(self, strings: int, bytes_: int) -> bool:
        """Whether so many more strings, of so many bytes in all, fit beside what is there; if not, all of it goes."""
        if not self.count or self.filled + 4 * self.used + bytes_ + 72 * (self.count + strings) <= self.limit:
            return True
        self.clear()
        return False

    def add(self, data: np.ndarray, offs: np.ndarray, h: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Adds distinct missing strings with their concatenated values; returns their places."""
        n, size = len(h), np.diff(offs)
        places = self.count + np.arange(n)

        def grown(x: np.ndarray, need: int) -> np.ndarray:
            return x if need <= len(x) else np.concatenate([x, np.zeros(max(need, len(x) * 3 // 2) - len(x), x.dtype)])

        self.hash, self.key, self.length, self.start, self.size = (grown(x, self.count + n) for x in (self.hash, self.key, self.length, self.start, self.size))
        self.keys, self.pool = grown(self.keys, self.filled + int(offs[-1] - offs[0])), grown(self.pool, self.used + len(values))
        self.hash[places], self.length[places], self.size[places] = h, size, sizes
        self.key[places], self.start[places] = self.filled + offs[:-1] - offs[0], self.used + np.cumsum(sizes) - sizes
        self.keys[self.filled : self.filled + int(offs[-1] - offs[0])] = data[offs[0] : offs[-1]]
        self.pool[self.used : self.used + len(values)] = values
        self.filled, self.used, self.count = self.filled + int(offs[-1] - offs[0]), self.used + len(values), self.count + n
        fresh = places
        if 2 * self.count > len(self.table):
            self.table = np.full(1 << (4 * self.count - 1).bit_length(), -1, np.int32)
            fresh = np.setdiff1d(np.arange(self.count), np.fromiter(self.side.values(), np.int64, len(self.side)))
        for i in self.place(fresh).tolist():
            self.side[self.keys[self.key[i] : self.key[i] + self.length[i]].tobytes()] = i
        return places

    def place(self, places: np.ndarray) -> np.ndarray:
        """Puts strings into the table; returns those whose hash another holds."""
        clash = [places[:0]]
        while len(places):
            slot = self.slots(self.hash[places])
            free = self.table[slot] < 0
            clash.append(places[~free])
            slot, places = slot[free], places[free]
            self.table[slot] = places
            lost = self.table[slot] != places  # another string took the slot meanwhile
            places = places[lost]
        return np.concatenate(clash)

    def values(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs at these places, concatenated, and their sizes."""
        size = self.size[places]
        return vec.gather(self.pool, self.start[places], size), size


def distinct(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct strings among data[borders[i]:borders[i+1]], compared by their bytes, as data and offsets; and which of them each is."""
    known = pa.BinaryArray.from_buffers(pa.binary(), len(borders) - 1, [None, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
    own = known.dictionary
    return np.frombuffer(own.buffers()[2], np.uint8), np.frombuffer(own.buffers()[1], np.int32, len(own) + 1).astype(np.int64), known.indices.to_numpy()


def sizes_of(parts: list[bytes], pieces: np.ndarray) -> np.ndarray:
    """How many pieces, of these lengths and one after another, each part has: pieces never cross the parts' borders."""
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    return np.diff(np.searchsorted(np.cumsum(pieces), ends, "right"), prepend=0)


class ChunkEncoder:
    """Ids of whole texts, from the ids of their stretches.

    `encode` gets runs of distinct stretches: those of a run are joinable, that is, together they are a text that is cut between them. It returns
    the values of all stretches, one after another, and how many each has.
    """

    def __init__(self, encode: Callable[[list[list[bytes]]], tuple[np.ndarray, np.ndarray]], cuts: Callable[[np.ndarray], np.ndarray] = solid_cuts, dtype=np.uint32, limit: int = 96 << 20):
        self.encode, self.cuts, self.memo = encode, cuts, Memo(limit, dtype)

    def learn(self, data: np.ndarray, offs: np.ndarray, lost: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Encodes and keeps the missing strings `lost`; returns their places."""
        first, long = data[offs[lost]], offs[lost + 1] - offs[lost] > 1
        joinable = long & (first == 32) & SOLID[data[np.minimum(offs[lost] + 1, len(data) - 1)]]
        kind = 2 * joinable
        if self.cuts is word_cuts:  # a sign is joinable to what ends with a letter or digit
            kind[~joinable & PUNCT[first] & ALNUM[data[offs[lost + 1] - 1]]] = 1
        order = np.argsort(kind, kind="stable")
        lost, (alone, signs, _) = lost[order], np.cumsum(np.bincount(kind, minlength=3)).tolist()
        raw = data.tobytes()
        keys = [raw[a:b] for a, b in zip(offs[lost].tolist(), offs[lost + 1].tolist(), strict=True)]
        runs = [keys[i : min(i + RUN, hi)] for lo, hi in ((alone, signs), (signs, len(keys))) for i in range(lo, hi, RUN)]
        flat, sizes = self.encode([[k] for k in keys[:alone]] + runs)
        size = offs[lost + 1] - offs[lost]
        places = np.empty(len(lost), np.int64)
        places[order] = self.memo.add(vec.gather(data, offs[lost], size), np.concatenate([[0], np.cumsum(size)]), h[lost], flat.astype(self.memo.dtype, copy=False), sizes)
        return places

    def places(self, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
        """Where the memo holds the values of each of the strings data[borders[i]:borders[i+1]], which it learns if need be."""
        own, offs, back = distinct(data, borders)
        at, h = self.memo.find(own, offs)
        lost = np.flatnonzero(at < 0)
        if len(lost):
            if not self.memo.room(len(lost), int((offs[lost + 1] - offs[lost]).sum())):
                lost = np.arange(len(at))
            at[lost] = self.learn(own, offs, lost, h)
        return at[back]

    def column(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For runs of texts: first row, end row, all their ids, and the bounds of each text's."""
        for i, j, data, offs in vec.slabs(column, 1 << 21):
            n = len(data)
            if not n:
                yield i, j, np.zeros(0, self.memo.dtype), np.zeros(j - i + 1, np.int64)
                continue
            begin = np.zeros(n + 1, bool)
            begin[self.cuts(data)] = True
            begin[offs] = True
            starts = np.flatnonzero(begin[:n])
            ids, size = self.memo.values(self.places(data, np.append(starts, n)))
            yield i, j, ids, np.concatenate([[0], np.cumsum(size)])[np.searchsorted(starts, offs)]
