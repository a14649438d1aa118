"""Byte-level BPE in DuckDB: encoding by recursive queries, decoding by ordered aggregation.

A text is cut by the tokenizer's pattern. Each task keeps a bounded memo from
stretch of text to ids, compared by bytes; what is not in it goes to an
in-process DuckDB as one row for each word: its tokens, at first its bytes, and
the ranks of their pairs. The recursive query contracts every word's leftmost
pair of least rank, joins the two pairs that this makes with the merge table and
goes on with the words that have a pair left, until none has. The ids are
those of the tiktoken library with the same ranks and pattern. Words over
LONG bytes have a row for each byte; a round contracts all pairs of the word's least rank, from the left,
where no pair that this makes can rank lower. Words over HUGE bytes, whose rounds
would be too many, are contracted by the same rule over a heap of pairs.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.chunks import ChunkEncoder, sizes_of
from lakeloom.llm.common import held, map_arrow, only, release

LONG, HUGE = 1024, 4096
PART = 200_000  # bytes of words that one query encodes
AT_ONCE = 150_000  # ids that one query decodes
NONE = 2147483647  # the rank of a pair that is no token
#: A row is a word: its tokens with -1 at both ends, the rank of the pair that begins at each of them but the last, and the least of these. A round contracts the leftmost pair of that
#: rank and looks up the two pairs that this makes; words whose least rank is NONE are done.
ENCODE = f"""
with recursive state(word, toks, ranks, best) as (
    select word, toks, ranks, list_min(ranks) from start
    union all
    select word, toks, ranks, list_min(ranks)
    from (
        select
            s.word,
            list_concat(list_slice(toks, 1, p - 1), [best], list_slice(toks, p + 2, len(toks))) as toks,
            list_concat(list_slice(ranks, 1, p - 2), [coalesce(l.id, {NONE}), coalesce(r.id, {NONE})], list_slice(ranks, p + 2, len(ranks))) as ranks
        from (
            select *, toks[p - 1] as before, toks[p + 2] as after
            from (select *, list_position(ranks, best) as p from state where best < {NONE})
        ) s
        left join merges l on l.a = s.before and l.b = s.best
        left join merges r on r.a = s.best and r.b = s.after
    )
)
select word, toks from state where best = {NONE} order by word
"""
#: A row is a token, in the order of places, with the rank of the pair that it begins and the least rank of its word, which is null once the word is done. A round contracts every second
#: row of each run of rows that begin a pair of the word's least rank; of ranks that are not `sure`, the leftmost alone.
ENCODE_LONG = """
with recursive state(place, word, tok, id, best) as (
    select place, word, tok, id, min(id) over (partition by word)
    from (
        select s.place, s.word, s.tok, m.id
        from (select place, word, tok, case when lead(word) over w = word then lead(tok) over w end as follower from start window w as (order by place)) s
        left join merges m on m.a = s.tok and m.b = s.follower
    )
    union all
    select place, word, tok, id, min(id) over (partition by word)
    from (
        select s.place, s.word, s.tok, m.id
        from (
            select place, word, tok, case when lead(word) over w = word then lead(tok) over w end as follower
            from (
                select place, word, if(starts, best, tok)::integer as tok, lag(starts) over (order by place) as gone
                from (
                    select s.place, s.word, s.tok, s.best, coalesce(s.id = s.best and (s.row - s.apart) % 2 = 1 and (u.id is not null or s.place = s.leftmost), false) as starts
                    from (
                        select *, coalesce(max(if(id = best, null, row)) over (partition by word order by place), 0) as apart, min(if(id = best, place, null)) over (partition by word) as leftmost
                        from (select *, row_number() over (partition by word order by place) as row from state where best is not null)
                    ) s
                    left join sure u on u.id = s.best
                )
            )
            where not coalesce(gone, false)
            window w as (order by place)
        ) s
        left join merges m on m.a = s.tok and m.b = s.follower
    )
)
select word, tok from state where best is null order by place
"""
#: Decoding: each text's ids, in their order, become its tokens' bytes, every byte as the character of that number, and these are aggregated in that order.
DECODE = "select text, list_aggregate(list_select(bytes, ids), 'string_agg', '') as bytes from ids, vocabulary"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_rows(ranks: dict[bytes, int]) -> tuple[list[int], list[int], list[int]]:
    """Every pair of tokens whose bytes together are a token, and that token's id."""
    rows = [(ranks[t[:i]], ranks[t[i:]], n) for t, n in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    return tuple(map(list, zip(*rows, strict=True))) if rows else ([], [], [])


def by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The leftmost pair of least rank, again and again, over a linked list: for very long words."""
    end, n = list(range(1, len(word) + 1)), len(word)
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop or not alive[j]:
            continue
        alive[j], end[i] = False, stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (b := before[i]) >= 0 and (r := ranks.get(word[b:stop])) is not None:
            heapq.heappush(heap, (r, b, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Contractor:
    """An in-process DuckDB with the merge table; bounded memory, one thread."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb

        self.ranks = ranks
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "128MB", "temp_directory": ""})
        a, b, n = merge_rows(ranks)
        merges = pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "id": pa.array(n, pa.int32())})
        self.con.register("given", merges)
        self.con.execute("create table merges as select * from given")
        self.con.execute("create table sure as select distinct id from given where id not in (select a from given where a >= id union select b from given where b >= id)")
        self.con.unregister("given")
        self.unknown = max(ranks.values()) + 1  # stands for ids outside the vocabulary, which have no bytes
        bytes_of = [""] * (self.unknown + 1)
        for t, n in ranks.items():
            bytes_of[n] = t.decode("latin-1")
        self.con.register("given", pa.table({"bytes": pa.array([bytes_of], pa.list_(pa.string()))}))
        self.con.execute("create table vocabulary as select * from given")
        self.con.unregister("given")
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.of_pair = np.array([ranks.get(bytes([i, j]), NONE) for i in range(256) for j in range(256)], np.int32)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each run ids[bounds[i]:bounds[i+1]], AT_ONCE ids at a time."""
        out = [[] for _ in bounds[1:]]
        for lo in range(0, len(ids), AT_ONCE):
            part = np.minimum(ids[lo : lo + AT_ONCE].astype(np.uint32), self.unknown).astype(np.int32)
            first, last = np.searchsorted(bounds, [lo, lo + len(part) - 1], "right") - 1
            ends = np.clip(bounds[first : last + 2] - lo, 0, len(part)).astype(np.int32)
            texts = np.arange(first, last + 1, dtype=np.int32)
            self.con.register("ids", pa.table({"text": texts, "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(part + np.int32(1)))}))
            for text, data in self.con.sql(DECODE).fetchall():
                out[text].append((data or "").encode("latin-1"))
            self.con.unregister("ids")
        return [b"".join(x) for x in out]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, one after another, and how many each has; a word that is a token itself has that id alone."""
        known = np.fromiter((self.ranks.get(w, -1) for w in words), np.int64, len(words))
        parts = [(np.flatnonzero(known >= 0), known[known >= 0].astype(np.int32), np.ones(int((known >= 0).sum()), np.int64))]
        rest = np.flatnonzero(known < 0)
        size = np.fromiter((len(words[i]) for i in rest.tolist()), np.int64, len(rest))
        for i in rest[size > HUGE].tolist():
            ids = np.array(by_heap(words[i], self.ranks), np.int32)
            parts.append((np.array([i]), ids, np.array([len(ids)])))
        for some, contract in ((size <= LONG, self.by_rows_of_words), ((size > LONG) & (size <= HUGE), self.by_rows_of_tokens)):
            own, until = rest[some], np.cumsum(size[some])
            lo = 0
            while lo < len(own):
                hi = max(lo + 1, int(np.searchsorted(until, (until[lo - 1] if lo else 0) + PART)))
                parts.append((own[lo:hi], *contract([words[i] for i in own[lo:hi].tolist()])))
                lo = hi
        sizes = np.zeros(len(words), np.int64)
        for own, _, n in parts:
            sizes[own] = n
        starts = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        for own, ids, n in parts:
            out[np.repeat(starts[own] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, sizes

    def contract(self, words: list[bytes], query: str = ENCODE) -> list[np.ndarray]:
        """The ids of each word by either query."""
        ids, sizes = (self.by_rows_of_words if query == ENCODE else self.by_rows_of_tokens)(words)
        return np.split(ids, np.cumsum(sizes)[:-1])

    def by_rows_of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ENCODE: ids, one word's after another's, and how many each has."""
        n, size = len(words), np.fromiter(map(len, words), np.int64, len(words))
        ends, flat = np.cumsum(size), np.frombuffer(b"".join(words), np.uint8)
        place, word = np.arange(len(flat)), np.repeat(np.arange(n), size)
        toks, ranks = np.full(len(flat) + 2 * n, -1, np.int32), np.full(len(flat) + n, NONE, np.int32)
        toks[place + 2 * word + 1] = self.of_byte[flat]
        pair = self.of_pair[flat[:-1].astype(np.int64) << 8 | flat[1:]]
        pair[ends[:-1] - 1] = NONE
        ranks[place[:-1] + word[:-1] + 1] = pair
        lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends + k * np.arange(1, n + 1)]).astype(np.int32)), pa.array(x)) for k, x in ((2, toks), (1, ranks))]
        self.con.register("start", pa.table({"word": np.arange(n, dtype=np.int32), "toks": lists[0], "ranks": lists[1]}))
        got = self.con.sql(ENCODE).to_arrow_table()
        self.con.unregister("start")
        got = got.column("toks")
        ids = np.concatenate([x.flatten().to_numpy() for x in got.chunks])
        return ids[ids >= 0], pa.compute.list_value_length(got).to_numpy().astype(np.int64) - 2

    def by_rows_of_tokens(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ENCODE_LONG: ids, one word's after another's, and how many each has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        self.con.register("start", pa.table({"place": np.arange(len(flat)), "word": np.repeat(np.arange(len(words), dtype=np.int32), size), "tok": self.of_byte[flat]}))
        got = self.con.sql(ENCODE_LONG).to_arrow_table()
        self.con.unregister("start")
        return got.column("tok").to_numpy(), np.bincount(got.column("word").to_numpy(), minlength=len(words))


class BpeCodec:
    """Encodes columns of texts through a memo and DuckDB, and decodes ids. The memos are small because an executor holds one codec for each of its workers, idle ones included."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, stretches: int = 16 << 20, words: int = 40 << 20):
        import regex

        self.split = regex.compile(pattern).findall
        self.contractor = Contractor(ranks)
        self.words = ChunkEncoder(self.contracted, limit=words)
        self.chunks = ChunkEncoder(self.encode_chunks, limit=stretches)

    def contracted(self, runs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        return self.contractor.encode([w for r in runs for w in r])

    def encode_chunks(self, runs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches of text, one after another, and how many each has: split by the pattern, unknown words contracted together."""
        data, lengths, counts = [], [], []
        for r in runs:
            raw = b"".join(r)
            own = np.fromiter(map(len, self.split(raw.decode())), np.int64)  # characters; the words are the whole text
            if not raw.isascii():
                own = np.diff(np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80), len(raw))[np.cumsum(own)], prepend=0)
            data.append(raw)
            lengths.append(own)
            counts.append(sizes_of(r, own))
        ends = np.cumsum(np.concatenate(lengths))
        ids, size = self.words.memo.values(self.words.places(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], ends])))
        total = np.concatenate([[0], np.cumsum(size)])[np.cumsum(np.concatenate(counts))]
        return ids, np.diff(total, prepend=0)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each run ids[bounds[i]:bounds[i+1]]."""
        return self.contractor.decode(ids, bounds)


def codec(ranks_path: str, pattern: str) -> BpeCodec:
    """One for each worker."""
    return held((ranks_path, pattern), lambda: BpeCodec(load_ranks(ranks_path), pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every whole text; null and empty texts have no ids. Rows stay as they are, repeated ones included; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            for i, j, ids, bounds in own.chunks.column(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))], ["doc_id", "ids"])
                release()

    return map_arrow(only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id bigint, ids array<int>", holds=True)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """doc_id, ids and bytes: the decoded binary; null and empty lists decode to empty bytes; repeated rows stay, an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            column = batch.column(1)
            step = 256  # texts at a time
            for i in range(0, len(column), step):
                part = column.slice(i, step)
                sizes = np.array([0 if n is None else n for n in pa.compute.list_value_length(part).to_pylist()], np.int64)
                flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                out = own.decode(flat, np.concatenate([[0], np.cumsum(sizes)]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, step), part, pa.array(out, pa.binary())], ["doc_id", "ids", "bytes"])

    return map_arrow(only(tokens, doc_id="doc_id", ids=ids), run, "doc_id bigint, ids array<int>, bytes binary", holds=True)


def digests(own: BpeCodec, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of round_trip_digests; between runs of texts, unused memory goes back to the machine."""
    for batch in batches:
        for i, j, ids, bounds in own.chunks.column(batch.column(1)):
            flat, ends = ids.astype("<u4").tobytes(), bounds.tolist()
            encoded = [hashlib.sha256(flat[4 * a : 4 * b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            decoded = [hashlib.sha256(x).hexdigest() for x in own.decode(ids, bounds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(bounds)), pa.array(encoded), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            del ids, flat, encoded, decoded
            release()


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Encodes, decodes the ids, and returns doc_id, n_tokens, ids_sha256 (of little-endian 32-bit ids) and decoded_sha256; in one Python worker for each task. Null and empty texts have no ids and empty decoded bytes; repeated rows stay, an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from digests(codec(ranks_path, pattern), batches)

    slim = only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(slim, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", holds=True)
