"""Operators on texts against brute force, libraries and edge cases."""

import base64
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import bpe, chunks, decontaminate, lm_score, near_dedup, shards, token_counts, token_store, toxicity, vec
from lakeloom.llm.components import components
from tests_llm_helpers import brute_components, brute_leaks, words

SF = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_50k.tiktoken")
#: null id, null, empty, white space only, ties, repeated rows, long words and texts, characters of all sizes
ODD = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "a"), (5, "a b"), (6, "a b"), (6, "a b"), (None, "a b c d"), (None, None), (7, "x" * 3000), (8, "é日本😀 " * 50), (9, "A  b\n \nC\r\n  d's we'll 12 3!! \x00 \x1f 　 \xa0z"), (10, "the cat sat " * 5000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with extra columns that operators use themselves."""
    df = spark.createDataFrame(ODD, "doc_id bigint, text string")
    return df.select("doc_id", "text", *[F.lit(1).alias(c) for c in ("node", "label", "shingles", "key", "h", "range", "row", "n", "bucket", "score")])


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


# spans -----------------------------------------------------------------------


def test_words_and_shingles():
    texts = [t for _, t in ODD] + ["B a", "b A"]
    for _, _, data, offs in vec.slabs(pa.array(texts, pa.string())):
        starts, ends, bounds = vec.word_spans(vec.LOWER[data], offs)
        raw = vec.LOWER[data].tobytes()
        got = [[raw[a:b] for a, b in zip(starts[x:y], ends[x:y], strict=True)] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [words(t) for t in texts]
        h = vec.span_hashes(vec.LOWER[data], starts, ends)
        by = {}
        for k, w in zip(h.tolist(), [w for ws in got for w in ws], strict=True):
            assert by.setdefault(w, k) == k
        assert len(set(by.values())) == len(by)
        s, text, _ = vec.shingle_hashes(h, bounds, 3)
        for d, ws in enumerate(got):
            want = {tuple(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))} if ws else set()
            assert len(set(s[text == d].tolist())) == len(want)


# near-duplicates -------------------------------------------------------------


def near_group(n, seed):
    """Texts around one base: some are like it, some only like one another."""
    r = random.Random(seed)
    base = [f"w{r.randrange(400)}" for _ in range(120)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(r.choice([1, 2, 3, 4, 6])):
            t[r.randrange(len(t))] = f"v{r.randrange(50)}"
        out.append(" ".join(t))
    return out


def test_near_duplicates_are_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(near_group(90, 1) + near_group(15, 2) + near_group(2, 3))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_of_odd_rows(odd, none):
    got = near_dedup.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == brute_components(ODD)[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    assert near_dedup.near_duplicates(none).count() == 0


def test_near_duplicates_through_repeated_ids(spark):
    """Texts that share a doc_id link whatever is like any of them."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in ("ash", "birch", "cedar"))
    for rows in ([(5, a), (5, b), (3, a + " more"), (4, b + " more")], [(5, a), (5, b), (3, a), (4, b + " more")], [(9, a), (9, b), (9, c), (8, c), (7, a + " more"), (6, "oak"), (6, ""), (6, None), (5, "oak")]):
        want = brute_components(rows)
        got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got if r.n_shingles} == {(i, c) for i, (_, c) in want.items()}
        assert all(r.component_id == r.doc_id for r in got if not r.n_shingles)


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    """Where the filter is too small for the ids, more sets move, and the result is the same."""
    monkeypatch.setattr(near_dedup, "FILTER_BITS", 64)
    rows = list(enumerate(near_group(60, 5)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_components(rows)


def test_signature_estimates_similarity():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 2**63, 900, np.uint64), r.integers(0, 2**63, 100, np.uint64)
    sets = [a, np.concatenate([a[100:], b])]  # 800 of 1000
    hits = np.mean([np.equal(*near_dedup.band_hashes(vec.mix(np.concatenate(sets) + np.uint64(k)), np.array([0, 900, 1800]), 20, 1)).mean() for k in range(30)])
    assert abs(hits - 0.8) < 0.05


def test_components(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 50 + i) for i in range(20)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(7, 7)]
    got = {x.node: x.label for x in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    label = {x: x for p in links for x in p}
    for _ in range(200):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# decontamination -------------------------------------------------------------


def test_leaks_are_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    r = random.Random(4)
    for k in range(60):  # copies with an edit
        w = r.choice(items)[1].split()
        w[r.randrange(len(w))] = "other"
        rows.append((5000 + k, " ".join([*["filler"] * r.randrange(9), *w, *["end"] * 5])))
    got = {(x.doc_id, x.item_id) for x in decontaminate.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    want = brute_leaks(rows, items)
    assert len(want) > 20 and got <= want and len(got) >= 0.97 * len(want)
    exact = {(d, i) for d, t in rows for i, u in items if u.lower() in t.lower()}
    assert exact <= got
    blocks = {(x.doc_id, x.item_id) for x in decontaminate.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), bench, block_windows=200).collect()}
    assert blocks == got


def test_long_items_in_parts(spark):
    """Items of 600 to 3000 words, whose windows are dealt to several blocks, are found as in one; copies with edits too."""
    r = random.Random(9)
    item = lambda n: [f"w{r.randrange(3000)}" for _ in range(n)]
    items = [(k, " ".join(item(n))) for k, n in enumerate((600, 900, 3000, 30))]
    rows = []
    for k, t in items:
        w = t.split()
        for e in (0, 3):
            c = list(w)
            for _ in range(e if len(w) > 100 else 0):
                c[r.randrange(len(c))] = "other"
            rows.append((10 * k + e, " ".join([*item(20), *c, *item(20)])))
    rows += [(100 + k, " ".join(item(800))) for k in range(3)]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = {(d, d // 10) for d, _ in rows if d < 100}
    for size in (12_000, 300):
        assert {(x.doc_id, x.item_id) for x in decontaminate.leaks(docs, bench, block_windows=size).collect()} == want


def test_index_of_ten_thousand_items():
    """A block's index is bounded by its windows, and finds each item."""
    r = random.Random(10)
    items = [(k, " ".join(f"w{r.randrange(50_000)}" for _ in range(10)), 0, 1) for k in range(10_000)]
    index = decontaminate.BenchmarkIndex(items, 15)
    windows = sum(len(x[3].prints) for x in index.sizes.values())
    size = sum(a.nbytes for x in index.sizes.values() for pair in x[3].blocks for a in pair)
    assert windows <= 30_000 and size <= 12_000 * windows + 3_000_000 * len(index.sizes)
    asked = [items[k][1] for k in range(0, 10_000, 997)]
    for _, _, h, text, _, bounds in decontaminate.text_shingles(pa.array(asked)):
        assert {(d, index.ids[k]) for d, k in index.matches(h, text, bounds, 0.8)} == {(d, k) for d, k in enumerate(range(0, 10_000, 997))}


def test_leaks_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "a b c d"), (2, None), (3, ""), (4, "the cat sat the cat sat the cat")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(odd, items).collect()}
    assert got == {(None, 1), (10, 4)}
    assert {r.doc_id for r in decontaminate.decontaminated(odd, items).collect()} == {i for i, _ in ODD} - {10}
    assert decontaminate.decontaminated(odd, items).columns == odd.columns
    assert decontaminate.leaks(none, items).count() == 0 and decontaminate.leaks(odd, items.limit(0)).count() == 0


def test_hamming_index_misses_nothing():
    r = np.random.default_rng(2)
    prints = r.integers(0, 2**63, 50, np.uint64)
    queries = np.concatenate([prints ^ np.uint64(sum(1 << int(b) for b in r.choice(64, k, replace=False))) for k in range(20)])
    q, p = decontaminate.HammingIndex(prints, 15).search(queries)
    want = np.bitwise_count(queries[:, None] ^ prints[None, :]) <= 15
    assert set(zip(q.tolist(), p.tolist(), strict=True)) == set(map(tuple, np.argwhere(want).tolist()))


# tokenizers ------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_round_trip(library, docs, odd, none):
    for df in (docs, odd):
        text = Counter((r.doc_id, *digests(library, r.text)) for r in df.select("doc_id", "text").collect())
        assert Counter(map(tuple, bpe.round_trip_digests(df, RANKS, P.PATTERN).collect())) == text
    assert bpe.round_trip_digests(none, RANKS, P.PATTERN).count() == 0


def test_bpe_codec_is_small_and_gives_memory_back_between_runs_of_texts(monkeypatch):
    freed = []
    monkeypatch.setattr(bpe, "release", lambda: freed.append(1))
    ranks = bpe.load_ranks(RANKS)
    own, tiny = bpe.BpeCodec(ranks, P.PATTERN), bpe.BpeCodec(ranks, P.PATTERN, 1 << 12, 1 << 12)
    assert own.words.memo.limit + own.chunks.memo.limit <= 56 << 20
    texts = [f"elm {i} ash{i % 7} " * 60_000 for i in range(6)] + [None, "", "yew"]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    parts = list(bpe.digests(own, iter([batch])))
    assert len(freed) == len(parts) > 1
    rows = pa.Table.from_batches(parts).to_pylist()
    assert rows == pa.Table.from_batches(bpe.digests(tiny, iter([batch]))).to_pylist()
    assert [r["decoded_sha256"] for r in rows] == [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]


def test_bpe_columns(library, odd):
    tokens = bpe.encode(odd, RANKS, P.PATTERN)
    got = bpe.decode(tokens, RANKS, P.PATTERN).collect()
    assert Counter((r.doc_id, bytes(r.bytes)) for r in got) == Counter((i, (t or "").encode()) for i, t in ODD)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((i, tuple(library.encode_ordinary(t or ""))) for i, t in ODD)


def thue_morse(n):
    """Two strings that every polynomial hash modulo a power of two takes for one."""
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return [s, s.translate(str.maketrans("ab", "ba"))]


def test_strings_of_equal_hashes_are_told_apart(spark, library):
    from tokenizers import Tokenizer

    texts = [p + t for n in (1024, 2048, 4096) for p in ("", "x ") for t in thue_morse(n)]
    data = np.frombuffer("".join(thue_morse(2048)).encode(), np.uint8)
    assert len(set(vec.span_hashes(data, np.array([0, 2048]), np.array([2048, 4096])).tolist())) == 1
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    assert {tuple(r) for r in bpe.round_trip_digests(df, RANKS, P.PATTERN).collect()} == {(k, *digests(library, t)) for k, t in enumerate(texts)}
    path = P.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    assert {r.doc_id: r.tokens for r in token_store.token_ids(df, path).collect()} == {k: other.encode(t, add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}
    counter = token_counts.UnigramCounter(*token_counts.vocabulary(P.path("piece_bpe_32k.model")))
    want = {k: sum(counter.best("▁" + w)[1] for w in t.split(" ")) for k, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, P.path("piece_bpe_32k.model")).collect()} == want


def test_memo_is_a_dictionary():
    """Against a dict, with hashes that collide, growth, and starting anew."""
    r = random.Random(1)
    pool = [("k%d" % r.randrange(4000)).encode() for _ in range(6000)] + [t.encode() for t in thue_morse(1024)] * 2 + [b"", b"k"]
    seen = []

    def encode(runs):
        keys = [k for run in runs for k in run]
        seen.extend(keys)
        return np.array([x for k in keys for x in (len(k), sum(k))], np.uint32), np.full(len(keys), 2)

    for limit in (1 << 20, 40_000):
        own = chunks.ChunkEncoder(encode, limit=limit)
        for _ in range(30):
            keys = [r.choice(pool) for _ in range(300)]
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            got, size = own.memo.values(own.places(np.frombuffer(b"".join(keys), np.uint8), ends))
            assert (size == 2).all() and got.tolist() == [x for k in keys for x in (len(k), sum(k))]
        assert limit < 1 << 20 or len(seen) == len(set(seen))
        seen.clear()


def test_contraction_ways_agree():
    ranks = bpe.load_ranks(RANKS)
    c = bpe.Contractor(ranks)
    r0 = random.Random(7)
    for w in [b"a" * 1500, ("ab" * 700 + "aba" * 90).encode(), *("".join(r0.choice("etaoin") for _ in range(n)).encode() for n in (3, 1100)), b"\xff\xfe\x00" * 9]:
        assert c.contract([w, b"xyz", w], bpe.ENCODE_LONG)[2].tolist() == bpe.by_heap(w, ranks)
    r = random.Random(6)
    items = ["".join(r.choice("abcdefthion é") for _ in range(r.randint(2, 40))).encode() for _ in range(300)] + [b"a" * 500, b"\xff\xfe\x00"]
    assert [x.tolist() for x in c.contract(items)] == [bpe.by_heap(w, ranks) for w in items]


def test_contraction_of_words_costs_little_beside_a_heap():
    """Rounds used to sort and join a row for each byte of every word: over a hundred times the heap's work on these."""
    ranks = bpe.load_ranks(RANKS)
    c = bpe.Contractor(ranks)
    r = random.Random(8)
    words = ["".join(r.choice("etaoinshrd") for _ in range(1000)).encode() for _ in range(40)]
    times = [time.process_time()]
    got = c.contract(words)
    times.append(time.process_time())
    want = [bpe.by_heap(w, ranks) for w in words]
    times.append(time.process_time())
    assert [x.tolist() for x in got] == want
    assert times[1] - times[0] < 40 * (times[2] - times[1])


def test_contractor_puts_ways_together_and_decodes_over_cuts(monkeypatch):
    ranks = bpe.load_ranks(RANKS)
    c = bpe.Contractor(ranks)
    r = random.Random(9)
    words = ["".join(r.choice("abcdefthion é") for _ in range(r.choice((1, 2, 9, 9, 30, 1024, 1025, 4097)))).encode()[: r.choice((3, 5000))] for _ in range(30)]
    words += [b" the", "é".encode(), b"\xff\xfe", b"\x00"]
    want = [bpe.by_heap(w, ranks) for w in words]
    for part, at_once in ((bpe.PART, bpe.AT_ONCE), (50, 700)):
        monkeypatch.setattr(bpe, "PART", part)
        monkeypatch.setattr(bpe, "AT_ONCE", at_once)
        ids, sizes = c.encode(words)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
        assert c.decode(ids, np.concatenate([[0, 0], np.cumsum(sizes)])) == [b"", *words]
    assert c.decode(np.array([-1, len(ranks) + 9, ranks[b"a"]]), np.array([0, 1, 1, 3])) == [b"", b"", b"a"]


def test_token_store(spark, docs, odd, none, tmp_path):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for k, df in enumerate((docs, odd, none)):
        where = f"file://{tmp_path}/t{k}"
        token_store.write(df, where, path)
        rows = df.select("doc_id", "text").collect()
        ids = {i: [library.encode(t or "", add_special_tokens=False).ids + [0] for j, t in rows if j == i] for i in {r.doc_id for r in rows}}
        got = sorted(token_store.digests(spark, where).collect(), key=lambda r: r.start)
        assert sorted(((r.doc_id is not None, r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(((i is not None, i), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, xs in ids.items() for x in xs)
        assert [r.start for r in got] == [sum(r.n_tokens for r in got[:j]) for j in range(len(got))]
        order = [r.doc_id for r in got]
        assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    part = token_store.read(spark, f"file://{tmp_path}/t0", 20, 30)
    assert {r.doc_id for r in part.collect()} == {r.doc_id for r in docs.where("doc_id between 20 and 30").collect()}
    plan = token_store.read(spark, f"file://{tmp_path}/t0", tokens=False)._jdf.queryExecution().executedPlan().toString()
    assert "tokens" not in plan.split("ReadSchema")[1].replace("n_tokens", "")


def test_token_store_reads_added_tokens_as_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    path, end = P.path("byte_bpe_50k.json"), "<|endoftext|>"
    library = Tokenizer.from_file(path)
    texts = [f"hello {end} world", "plain text", None, f"{end}{end}", f"a  {end}  b\n\n {end}", "<|endoftext", "", f"é {end}", "last one"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    token_store.write(df, f"file://{tmp_path}/t", path)
    got = {r.doc_id: r.tokens for r in token_store.read(spark, f"file://{tmp_path}/t").collect()}
    assert got == {k: library.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}


def test_token_store_learns_a_word_once_whatever_sign_follows():
    """A word with a comma used to be another stretch, which the library encoded again."""
    own, given = token_store.build_encoder(P.path("byte_bpe_50k.json")), []
    encode = own.plain.encode
    own.plain.encode = lambda runs: given.extend(k for r in runs for k in r) or encode(runs)
    texts = [" ".join(f"{w}{sign}" for w in ("elm", "Yew3", "ash")) + " oak" for sign in (",", ".", "!", "***", "'s", ";\n", "")]
    got = [ids[a:b].tolist() for _, _, ids, bounds in own.column(pa.array(texts)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == [own.whole(t) for t in texts]
    assert len(given) == len(set(given)) and sum(b"ash" in k for k in given) == 1


def test_token_store_cuts_at_signs_as_the_library_does():
    own = token_store.build_encoder(P.path("byte_bpe_50k.json"))
    r = random.Random(4)
    pieces = ["a", "Z", "ll", "7", "é", "ß", "日", "\u0301", "²", "'", "'s", "'ll", "'re", "’s", ".", ",", "_", "-", "<|", "|>", "$$$", " ", "  ", "\n", "\n\n", "\t", "\xa0", "\u3000", "\x00", "\x7f", "endoftext"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(1, 12))) for _ in range(20_000)]
    # joined, the stretches of these two make an added token
    for some in (texts, ["b<|endoftext", "b|>c", "b,d"], ["x<|endoftext y|>c <|endoftext"]):
        got = [ids[a:b].tolist() for _, _, ids, bounds in own.column(pa.array(some)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [own.whole(t) for t in some]
    signs = [b"<|endoftext", b"|>c", b",d"]
    ids, sizes = own.plain.encode([signs])
    assert ids.tolist() == [n for k in signs for n in own.whole(k.decode())] and sizes.tolist() == [len(own.whole(k.decode())) for k in signs]


def test_token_store_encodings(spark, docs, tmp_path):
    import pyarrow.parquet as pq

    token_store.write(docs, f"file://{tmp_path}/t", P.path("byte_bpe_50k.json"))
    meta = pq.ParquetFile(next((tmp_path / "t").glob("*.parquet"))).metadata.row_group(0)
    by = {meta.column(i).path_in_schema.split(".")[0]: meta.column(i) for i in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in by["doc_id"].encodings and "RLE_DICTIONARY" in by["tokens"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in (by["doc_id"], by["n_tokens"]))


def unigram_model(path):
    """The library's own unigram segmentation over the same vocabulary: the model file with its type set to unigram."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(open(path, "rb").read())
    m.trainer_spec.model_type = 1
    least = min(p.score for p in m.pieces if p.score > token_counts.NEVER and p.type == 1) - 1
    for p in m.pieces:
        p.score = max(p.score, least)
    return sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())


def whole_viterbi(text, pieces, least):
    """Pieces of the best segmentation of a whole text, without stretches or an automaton: earliest start first, a later one must be better."""
    text = "▁" + text.replace(" ", "▁")
    best, count = [0.0] + [None] * len(text), [0] * (len(text) + 1)
    longest = max(map(len, pieces))
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            s = pieces.get(text[start:end])
            if s is not None and (best[end] is None or best[start] + s > best[end]):
                best[end], count[end] = best[start] + s, count[start] + 1
        if text[end - 1] not in pieces and (best[end] is None or best[end - 1] + least > best[end]):
            best[end], count[end] = best[end - 1] + least, count[end - 1] + len(text[end - 1].encode())
    return count[-1]


def test_token_counts_are_brute_force(docs, odd, none):
    """Every document of the smallest table, whole; sums over stretches differ from those over a whole text only where scores tie to the last bits."""
    path = P.path("piece_bpe_32k.model")
    pieces, byte_pieces = token_counts.vocabulary(path)
    table, least = dict(pieces), min(s for _, s in pieces) - token_counts.UNKNOWN_PENALTY
    assert byte_pieces
    rows = docs.where("length(text) < 6000").select("doc_id", "text").collect()
    assert len(rows) > 0.9 * docs.count()
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, path).collect()}
    assert {r.doc_id: got[r.doc_id] for r in rows} == {r.doc_id: whole_viterbi(r.text, table, least) for r in rows}
    odd_counts = Counter((r.doc_id, r.n_tokens > 0) for r in token_counts.token_counts(odd, path).collect())
    assert odd_counts == Counter((i, bool(t)) for i, t in ODD)
    assert token_counts.token_counts(none, path).count() == 0


def test_token_counts_equal_the_library(docs):
    """Word by word, since the library rounds the scores of long texts to 32 bits."""
    path = P.path("piece_bpe_32k.model")
    library, counter = unigram_model(path), token_counts.UnigramCounter(*token_counts.vocabulary(path))
    words_ = sorted({w for r in docs.select("text").collect() for w in re.split(r"[ \n\t]+", r.text or "") if w})
    assert len(words_) > 5000
    assert [counter.best("▁" + w)[1] for w in words_] == [len(library.encode(w)) for w in words_]


def test_counter_ties_and_unknowns():
    path = P.path("piece_bpe_32k.model")
    library, own = unigram_model(path), token_counts.UnigramCounter(*token_counts.vocabulary(path))
    r = random.Random(8)
    items = ["".join(r.choice("etaoinshr déñ") for _ in range(r.randint(1, 14))).strip() or "e" for _ in range(1500)]
    for w in items:
        for part in w.split():
            assert own.best("▁" + part)[1] == len(library.encode(part)), part
    tie = token_counts.UnigramCounter([("a", -1.0), ("aa", -2.0), ("aaa", -3.0)], False)
    assert tie.best("aaa") == (-3.0, 1)  # equal scores: the longest last piece
    assert tie.best("ab") == (-14.0, 2) and token_counts.UnigramCounter([("a", -1.0)], True).best("é")[1] == 2
    with pytest.raises(ValueError):
        token_counts.UnigramCounter([("a▁", 0.0)], False)


# sharding --------------------------------------------------------------------


def check_shards(rows, n, tolerance=None):
    total = sum(r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    assert all(0 <= s < n for s in by)
    if tolerance:
        largest = max((r.size for r in rows), default=1)
        assert all(abs(sum(r.size for r in by.get(k, [])) - total / n) <= 2 * (tolerance * total / n + largest) for k in range(n))


def test_shards(spark, docs, odd, none):
    got = shards.shards(docs, 16).collect()
    want = {r.doc_id: (len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == want
    check_shards(got, 16, 0.002)
    assert Counter((r.doc_id, r.text_crc32) for r in shards.shards(odd, 3).collect()) == Counter((i, zlib.crc32((t or "").encode())) for i, t in ODD)
    check_shards(shards.shards(odd, 3).collect(), 3)
    assert shards.shards(none, 4).count() == 0


def test_shards_with_a_hot_text(spark):
    """A third of all rows are one text: it is split by doc_id, other copies stay together; fine ranges change nothing."""
    rows = [(i, "same text " * 3 if i % 3 == 0 else f"text {i % 997} " * (i % 7 + 1)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = shards.shards(df, 16).collect()
    check_shards(got, 16, 0.002)
    where = {}
    for r in got:
        where.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) <= 15
    fine = {(r.doc_id, r.shard, r.slot) for r in shards.shards(df, 16, task_rows=50).collect()}
    assert fine == {(r.doc_id, r.shard, r.slot) for r in got}


# language model --------------------------------------------------------------


def test_lm_base_is_brute_force(docs, odd, none):
    for df in (docs, odd):
        rows = [(r.doc_id, [*words(r.text), b"\n"]) for r in df.select("doc_id", "text").collect()]
        held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
        c = Counter(w for i, ws in rows if not held(i) for w in ws)
        n, v = sum(c.values()), len(c)
        got = lm_score.scores(df).collect()
        key = lambda x: (x[0] is not None, x[0] or 0, x[2])
        want = sorted(((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for i, ws in rows), key=key)
        for g, w in zip(sorted(map(tuple, got), key=key), want, strict=True):
            assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], abs=1e-6)
            assert g[6] <= 1e-9 and math.isfinite(g[6])
    assert lm_score.scores(none).count() == 0


def test_lm_beats_its_base_on_held_out_texts(spark):
    got = lm_score.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > 0.96 * got.b


def test_lm_conditions_on_what_occurs_twice_in_a_large_corpus(spark):
    """12 million symbols of training do not raise the least count."""
    held, train = ([i for i in range(1000) if (zlib.crc32(str(i).encode()) % 5 == 1) == x] for x in (True, False))
    filler = spark.createDataFrame([(i,) for i in train[:60]], "doc_id bigint").select("doc_id", F.expr("repeat('x y ', 100000)").alias("text"))
    rows = [(train[60], "quince rhubarb sorrel"), (train[61], "quince rhubarb sorrel"), (held[0], "quince rhubarb sorrel"), (held[1], "sorrel quince tansy")]
    df = filler.unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r.doc_id: r for r in lm_score.scores(df).where(f"doc_id in ({held[0]}, {held[1]})").collect()}
    assert got[held[0]].train_tokens > 12_000_000
    assert got[held[0]].score > got[held[0]].base_score + 10
    assert got[held[1]].score < got[held[0]].score - 5


@pytest.mark.parametrize("share, group", [(400, 500_000), (5000, 700), (2_000_000, 500_000)])
def test_lm_buckets_equal_the_tree_in_memory(spark, docs, odd, share, group, monkeypatch):
    monkeypatch.setattr(lm_score, "GROUP", group)
    for df in (docs, odd, docs.select("doc_id", F.expr("repeat(concat(substr(text, 1, 40), ' b a a '), 3)").alias("text"))):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        train = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1 for i, _ in rows])
        parts = list(lm_score.symbols(pa.array([t for _, t in rows], pa.string())))
        stream = np.concatenate([x[2] for x in parts])
        bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[3]) for x in parts]))])
        use = np.repeat(train, np.diff(bounds))
        k, c = np.unique(stream[use], return_counts=True)
        below = math.log10(c.sum() + 0.5 * (len(k) + 1))
        k, c = k[c >= 2], c[c >= 2]
        tree = lm_score.SuffixTree(k, c, np.arange(len(k)), np.log10(c + 0.5) - below)
        for _ in range(3):
            ids, begins = tree.ids(stream, bounds)
            *_, (context, _) = tree.walk(ids, begins)
            keys, n = np.unique(((context << 32) | ids)[use & (context >= 0) & (ids >= 0)], return_counts=True)
            tree.add(keys[n >= 2], n[n >= 2], tree.totals(), 2)
        tree.finish(1.0)
        more = np.add.reduceat(tree.log_ratios(stream, bounds), bounds[:-1])
        order = lambda x: (x[0] is not None, x[0] or 0, round(x[1], 6))
        got = [(r.doc_id, r.score - r.base_score) for r in lm_score.scores(df, share=share).collect()]
        for g, w in zip(sorted(got, key=order), sorted(zip([i for i, _ in rows], more.tolist(), strict=True), key=order), strict=True):
            assert g[0] == w[0] and g[1] == pytest.approx(w[1], abs=1e-6)


@pytest.mark.parametrize("most", [500_000, 1])
def test_lm_pairs_with_frequent_words_are_summed_in_each_task(spark, docs, most, monkeypatch):
    """A row for each frequent word and task, not for each pair; the counts of all pairs are whole."""
    monkeypatch.setattr(lm_score, "PAIRS", most)
    tables, write = {}, lm_score.written
    monkeypatch.setattr(lm_score, "written", lambda df, name: tables.setdefault(name, write(df, name)))
    df = docs.where("text is not null").select("doc_id", "text").coalesce(1)
    lm_score.scores(df, share=400)
    scored, parts = tables["scored"], list(lm_score.symbols(pa.array([r.text for r in df.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 != 1])))
    words_of = np.concatenate([x[2] for x in parts])
    keys, n = np.unique(words_of, return_counts=True)
    begins = np.zeros(len(words_of), bool)
    begins[np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[3]) for x in parts]))[:-1]])] = True
    before = np.where(begins, lm_score.END, np.roll(words_of, 1))
    heavy = set(keys[n > 200].tolist())
    want = Counter((a, b) for a, b in zip(before.tolist(), words_of.tolist(), strict=True) if a in heavy)
    rows = scored.where("last is not null").select("last", "words", "times").collect()
    got = Counter()
    for r in rows:
        for word, times in zip(r.words, r.times, strict=True):
            got[r.last % 2**64, word % 2**64] += times
    assert heavy and got == want and scored.where("last is null").count() == df.count()
    if most > 1:
        assert len(rows) == len({r.last for r in rows})


def test_lm_partial_sums_are_lists_by_parts_of_the_texts(spark, docs, monkeypatch):
    tables, write = {}, lm_score.written
    monkeypatch.setattr(lm_score, "written", lambda df, name: tables.setdefault(name, write(df, name)))
    tokens = lm_score.scores(docs, share=20_000).first().train_tokens
    assert 1 < tables["parts"].where("keys is not null and waits is null").count() <= math.ceil(1.25 * tokens / 20_000) ** 2 < docs.count()


def test_lm_partial_sums_take_few_bytes(spark, docs, monkeypatch):
    """Sums by text and bucket come near to one a symbol, so they travel without the texts' keys, in less than 10 bytes each."""
    tables, write = {}, lm_score.written
    monkeypatch.setattr(lm_score, "written", lambda df, name: tables.setdefault(name, write(df, name)))
    df = docs.where("text is not null").coalesce(1)
    lm_score.scores(df, share=20_000)
    rows = tables["parts"].where("keys is not null").select("keys", "size").collect()
    assert sum(len(r["keys"]) for r in rows) < 10 * sum(len(lm_score.unpacked(r["keys"], r["size"])[0]) for r in rows)
    x = np.array([0, -1, 1, 255, -(1 << 40), (1 << 52) + 7])
    assert lm_score.from_signed_planes(lm_score.signed_planes(x), len(x)).tolist() == x.tolist()


@pytest.mark.parametrize("share", [400, 20_000])
def test_lm_scores_do_not_depend_on_which_counts_are_broadcast(spark, docs, share, monkeypatch):
    df = docs.where("text is not null").repartition(3).localCheckpoint()
    monkeypatch.setattr(lm_score, "CHUNK", 5000)
    want = {r.doc_id: (r.n_known, r.score - r.base_score) for r in lm_score.scores(df).collect()}
    monkeypatch.setattr(lm_score, "FREQUENT", 100)
    got = {r.doc_id: (r.n_known, r.score - r.base_score) for r in lm_score.scores(df, share=share).collect()}
    assert got.keys() == want.keys()
    for k, (n, more) in want.items():
        assert got[k][0] == n and got[k][1] == pytest.approx(more, abs=1e-6)


def test_suffix_tree_is_a_distribution():
    """Over all known words and the unknown one, every context's probabilities sum to 1."""
    r = random.Random(5)
    text = [r.choice(["a", "b", "c", "d"]) if k % 7 else "the" for k in range(2000)]
    hashes = {w: vec.span_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0] for w in set(text)}
    ws = sorted([*hashes.values(), lm_score.END])
    stream = np.array([hashes[w] for w in text] + [lm_score.END], np.uint64)
    known = np.array(ws, np.uint64)
    c = np.array([(stream == k).sum() for k in known])
    below = math.log10(len(stream) + 0.5 * (len(ws) + 1))
    tree = lm_score.SuffixTree(known, c, np.arange(len(known)), np.log10(c + 0.5) - below)
    bounds = np.array([0, len(stream)])
    for _ in range(2):
        ids, begins = tree.ids(stream, bounds)
        *_, (context, _) = tree.walk(ids, begins)
        k, n = np.unique(((context << 32) | ids)[(context >= 0) & (ids >= 0)], return_counts=True)
        tree.add(k, n, tree.totals(), 2)
    tree.finish(0.5)
    assert any(x.kept.any() for x in tree.levels)
    for before in (["a", "b"], ["the", "a"], ["d", "the"]):
        total = 0
        for w in [*known, np.uint64(123)]:
            s = np.array([*[hashes[x] for x in before], w], np.uint64)
            root = (np.log10(c[known == w][0] + 0.5) if w in known else math.log10(0.5)) - below
            total += 10 ** (root + tree.log_ratios(s, np.array([0, 3]))[-1])
        assert total == pytest.approx(1, abs=1e-6)


# toxicity --------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    assert all(0 <= r.score <= 1 for r in got)
    found = [r.predicted for r in got if r.toxic]
    assert sum(found) >= 0.8 * len(found) and np.mean([r.predicted for r in got if not r.toxic]) <= 0.02


def test_toxicity_recall_by_cross_validation():
    """Of the labelled rows outside the held-out fold of sf0.1, each judged by a model that has not seen it, at least 0.9 of the toxic ones are found and at most 1 % of the others."""
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.1"
    rows = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).join(pq.read_table(f"{sf}/labels.parquet"), "doc_id", join_type="inner").sort_by("doc_id").to_pylist()
    rows = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0]
    hits, said = [], []
    for fold in range(3):
        part = [zlib.crc32(b"fold" + str(r["doc_id"]).encode()) % 3 == fold for r in rows]
        model = toxicity.fit([r["text"] for r, p in zip(rows, part, strict=True) if not p], [r["toxic"] for r, p in zip(rows, part, strict=True) if not p])
        asked = [r for r, p in zip(rows, part, strict=True) if p]
        hits += (toxicity.margins(pa.array([r["text"] for r in asked]), model) >= 0).tolist()
        said += [r["toxic"] for r in asked]
    hits, said = np.array(hits), np.array(said) == 1
    assert hits[said].mean() >= 0.9 and hits[~said].mean() <= 0.01


def test_toxicity_ratios_and_margins_are_brute_force():
    """Against features counted one by one."""
    texts, labels = ["you Idiot  moron", "fine day", "moron you moron", "good day you", None, "idiot day"], [1, 0, 1, 0, 0, 1]
    model = toxicity.fit(texts, labels, bits=20, seen_in=1, least_ratio=0.1)

    def counts(t):
        raw = b" " + " ".join((t or "").lower().split(" ")).encode() + b" "
        return Counter(raw[i : i + n] for n in toxicity.ORDERS for i in range(len(raw) - n + 1)) if t else Counter()

    seen = [counts(t) for t in texts]
    bad, rest = (Counter(g for c, y in zip(seen, labels, strict=True) if y == k for g in c) for k in (1, 0))
    ratio = {g: math.log((bad[g] + 1) / (3 + 1)) - math.log((rest[g] + 1) / (3 + 1)) for g in bad | rest}
    ratio = {g: r for g, r in ratio.items() if abs(r) > 0.1}
    for (own, value), c in zip(toxicity.features(pa.array(texts), model), seen, strict=True):
        want = {g: n * ratio[g] for g, n in c.items() if g in ratio}
        norm = math.sqrt(sum(x * x for x in want.values()))
        assert sorted(value.tolist()) == pytest.approx(sorted(x * toxicity.LENGTH / norm for x in want.values()))
        assert sorted(model.ratio[own].tolist()) == pytest.approx(sorted(ratio[g] for g in want))
    assert (toxicity.margins(pa.array(texts), model) > 0).astype(int).tolist() == labels


def test_toxicity_of_repeated_labels_and_ties(spark):
    """Of several labels of an id any toxic one counts, of several texts the least; ties in the hash order are broken by id."""
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, "d"), (3, "d")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 0), (3, 1), (9, 1)], "doc_id bigint, toxic int")
    assert toxicity.labelled_sample(docs, labels, "text", "toxic", None, 10) == (["a", "c", "d"], [1, 0, 1])
    assert len(toxicity.labelled_sample(docs, labels, "text", "toxic", None, 1)[0]) <= 2


def test_long_texts_have_the_features_of_their_pieces(monkeypatch):
    text = "".join(random.Random(3).choice("abcdef ") for _ in range(5000))
    model = toxicity.fit([text, "fed cab", "abc"], [1, 0, 0], bits=14, seen_in=1, least_ratio=0.0)
    want = toxicity.margins(pa.array([text]), model)
    monkeypatch.setattr(toxicity, "PIECE", 512)
    assert toxicity.margins(pa.array([text]), model) == pytest.approx(want)


def test_toxicity_edges(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, None), (None, 1), (77, 1)], "doc_id bigint, toxic int")
    got = toxicity.toxicity(odd, labels, exclude_remainder=None).collect()
    assert len(got) == len(ODD) and len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert toxicity.toxicity(none, labels).count() == 0
    assert all(r.score < 1e-9 for r in toxicity.toxicity(odd, labels.limit(0)).collect())
    kept = toxicity.kept(odd, toxicity.fit([], []))
    assert kept.columns == odd.columns and kept.count() == len(ODD)


def test_gram_buckets_cover_every_place():
    for text in ("", "a", "ab cd", "é" * 9):
        for _, _, data, offs in vec.slabs(pa.array([text, text])):
            a, b = toxicity.gram_buckets(data, offs, 16)
            n = len(text.encode()) + 2
            assert np.array_equal(a, b) and len(a) == (sum(max(0, n - k + 1) for k in toxicity.ORDERS) if n > 2 else 0)


def test_labels_are_never_inputs(docs):
    """The score of a text depends on the text alone."""
    model = toxicity.fit(["you idiot", "fine day", "moron you", "good day"], [1, 0, 1, 0], bits=12)
    twice = docs.limit(20).unionAll(docs.limit(20).withColumn("doc_id", F.col("doc_id") + 1000).withColumn("lang", F.lit("xx")))
    got = {r.doc_id: r.score for r in toxicity.score(twice, model).collect()}
    assert all(got[i] == got[i + 1000] for i in got if i < 1000)


def test_base64_of_ranks():
    line = open(RANKS, "rb").readline().split()
    assert bpe.load_ranks(RANKS)[base64.b64decode(line[0])] == int(line[1])
