"""Near-duplicate groups: circulant MinHash, banding, exact Jaccard verification.

A signature needs two permutations only. The first places every shingle in a
universe of 2**32 places; coordinate k is the least value, over a text's
shingles, of the second permutation shifted circularly by k places. Bands of
`rows` coordinates are the buckets; at a Jaccard similarity of s a pair shares
none of `bands` buckets with probability (1 - s**rows)**bands (4e-7 at 0.85).

Buckets are never expanded into all pairs. Texts with equal shingle sets first
become one. In each bucket the member that shares most buckets, its hub, is paired
with the others, and those pairs are verified on full shingle sets. Two members of
a bucket share its hub; so whatever links are missing lie between members of
one hub that verification left in different components. Few members are paired
by a join; many are compared inside tasks, block against block, by
what distinguishes each from the hub, which gives the exact similarity, and
only links that join components come out. No link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import vec
from lakeloom.llm.common import map_arrow, only, written
from lakeloom.llm.components import components

U32 = np.uint32
BLOCK, FEW = 512, 24
FILTER_BITS, PROBES = 1 << 28, 3


def scatter(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit integers."""
    x = (x ^ (x >> U32(16))) * U32(0x7FEB352D)
    x = (x ^ (x >> U32(15))) * U32(0x846CA68B)
    return x ^ (x >> U32(16))


def text_sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: first row, end row, their distinct shingle hashes, and the bounds of each text's."""
    for i, j, data, offs in vec.slabs(column):
        data = vec.LOWER[data]
        starts, ends, bounds = vec.word_spans(data, offs)
        h, text, _ = vec.shingle_hashes(vec.span_hashes(data, starts, ends), bounds, k)
        cuts = np.searchsorted(text, np.arange(j - i + 1))
        sets = [np.unique(h[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield i, j, np.concatenate(sets) if sets else h[:0], np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def set_hashes(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set of shingles; 0 for an empty one."""
    full = np.flatnonzero(np.diff(bounds))
    s1, s2 = np.zeros(len(bounds) - 1, np.uint64), np.zeros(len(bounds) - 1, np.uint64)
    if len(full):
        s1[full] = np.add.reduceat(vec.mix(shingles), bounds[full])
        s2[full] = np.add.reduceat(vec.mix(shingles ^ np.uint64(0xD6E8FEB86659FD93)), bounds[full])
    return s1.view(np.int64), s2.view(np.int64)


def band_hashes(shingles: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Bucket hashes, one row for each text with shingles."""
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return np.zeros((0, bands), np.int64)
    place = scatter((shingles >> np.uint64(32)).astype(U32) ^ U32(0x5BD1E995))  # the first permutation
    out = np.zeros((len(full), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(full), b, np.uint64)
        for r in range(rows):
            least = np.minimum.reduceat(scatter(place - U32(b * rows + r)), bounds[full])  # the second, shifted
            h = vec.mix(h * np.uint64(0x9E3779B97F4A7C15) + least)
        out[:, b] = h
    return out.view(np.int64)


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, two hashes of the shingle set, its bucket hashes (empty without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, shingles, bounds in text_sets(batch.column(1), k):
                n, (s1, s2) = np.diff(bounds), set_hashes(shingles, bounds)
                flat = band_hashes(shingles, bounds, bands, rows).reshape(-1)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, bands, 0))]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(s1), pa.array(s2), lists], ["doc_id", "n_shingles", "s1", "s2", "buckets"])

    return map_arrow(docs, run, "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, buckets array<bigint>")


def filter_places(ids: np.ndarray, size: int) -> np.ndarray:
    """Bit numbers of ids in a Bloom filter of that size: a row for each id."""
    h = vec.mix(ids.astype(np.int64).view(np.uint64))
    step = vec.mix(h) | np.uint64(1)
    return ((h[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(size)).astype(np.int64)


def id_filter(ids: DataFrame, count: int) -> np.ndarray:
    """A Bloom filter of the ids, 12 bits each: 64-bit words, at most FILTER_BITS in all. Beyond that more ids that were not asked for pass it, to be dropped by the join after it."""
    size = -(-min(max(64, 12 * count), FILTER_BITS) // 64) * 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(size // 64, np.uint64)
        for batch in batches:
            at = filter_places(batch.column(0).to_numpy(), size).reshape(-1)
            np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        full = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(words[full].view(np.int64))], ["at", "word"])

    out = np.zeros(size // 64, np.uint64)
    got = map_arrow(ids, run, "at bigint, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    out[got.column("at").to_numpy()] = got.column("word").to_numpy().view(np.uint64)
    return out


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """node and shingles (the sorted distinct shingle hashes) of wanted nodes, each given with the doc_id and the set hashes of one of its texts.

    Tasks leave texts where they are; only the sets of doc_ids that pass a bounded filter move.
    """
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(wanted.select("doc"), wanted.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            if batch.num_rows:
                at = filter_places(batch.column(0).to_numpy(), 64 * len(own))
                batch = batch.filter(pa.array(((own[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)))
            for i, j, shingles, bounds in text_sets(batch.column(1), k):
                columns = [pa.array(x) for x in (np.diff(bounds), *set_hashes(shingles, bounds))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *columns, pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(shingles.view(np.int64)))], ["doc", "n_shingles", "s1", "s2", "shingles"])

    key = ["doc", "s1", "s2", "n_shingles"]
    found = map_arrow(docs, run, "doc bigint, n_shingles bigint, s1 bigint, s2 bigint, shingles array<bigint>")
    return found.join(wanted, key).dropDuplicates(key).select("node", "shingles")


def links_by_id(base: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the shingle sets of texts that share a doc_id."""
    key = ["s1", "s2", "n_shingles"]
    some = base.where("n_shingles > 0 and doc_id is not null").select("doc_id", *key)
    one = F.struct(*key)
    repeated = some.groupBy("doc_id").agg(F.min(one).alias("lo"), F.max(one).alias("hi")).where("lo <> hi").select("doc_id")
    held = written(some.join(repeated, "doc_id").distinct().join(nodes.select("node", *key), key).select("doc_id", "node"), "held")
    return held.join(held.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").where("a < node").select("a", F.col("node").alias("b")).distinct()


def similar(sets: DataFrame, pairs: DataFrame, a: str, b: str) -> DataFrame:
    """The pairs with sa and sb, the shingle sets of columns a and b."""
    left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{k}")) for k, x in (("a", a), ("b", b)))
    return pairs.join(left, a).join(right, b)


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) with den * intersection >= num * union on full sets."""
    both = F.size(F.array_intersect("sa", "sb"))
    return similar(sets, pairs, "a", "b").select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb") - both).alias("u")).where(den * F.col("i") >= num * F.col("u")).select("a", "b")


def block_links(rows: dict[str, list], p: int, q: int, num: int, den: int) -> list[tuple[int, int]]:
    """Links between members of block p and of block q of a hub that join different labels, at most one for two labels joined already.

    With x and y what distinguishes two texts from the hub, their sets differ in len(x) + len(y) - 2 * common shingles.
    """
    part, node, label = (np.array(rows[c]) for c in ("part", "node", "label"))
    size, own = np.array(rows["size"]), rows["own"]
    left, right = np.flatnonzero(part == p), np.flatnonzero(part == q)
    flat = np.concatenate([own[i] for i in right]) if len(right) else np.zeros(0, np.int64)
    holder = np.repeat(np.arange(len(right)), [len(own[i]) for i in right])
    order = np.argsort(flat, kind="stable")
    flat, holder = flat[order], holder[order]
    length = np.array([len(own[i]) for i in right])
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while x in root:
            x = root[x]
        return x

    out = []
    for i in left:
        lo, hi = np.searchsorted(flat, own[i], "left"), np.searchsorted(flat, own[i], "right")
        common = np.bincount(vec.gather(holder, lo, hi - lo), minlength=len(right))
        total = size[i] + size[right]
        inside = (total - (len(own[i]) + length - 2 * common)) // 2
        for j in right[(den * inside >= num * (total - inside)) & (label[right] != label[i])]:
            a, b = top(int(label[i])), top(int(label[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(min(node[i], node[j])), int(max(node[i], node[j]))))
    return out


def links_within(cells: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) found in cells: rows of one (hub, p, q), which a task reads one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, found = None, {}, []
        for batch in batches:
            columns = [c.to_pylist() if c.type != pa.list_(pa.int64()) else c for c in batch.columns]
            flat, offs = columns[-1].flatten().to_numpy(), np.concatenate([[0], np.cumsum(columns[-1].value_lengths().to_numpy())])
            for k, (hub, p, q, part, node, label, size) in enumerate(zip(*columns[:-1], strict=True)):
                if (hub, p, q) != key:
                    if key:
                        found += block_links(rows, *key[1:], num, den)
                    key, rows = (hub, p, q), {"part": [], "node": [], "label": [], "size": [], "own": []}
                for c, x in (("part", part), ("node", node), ("label", label), ("size", size), ("own", flat[offs[k] : offs[k + 1]])):
                    rows[c].append(x)
        if key:
            found += block_links(rows, *key[1:], num, den)
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], pa.int64()) for c in (0, 1)], ["a", "b"])

    dealt = cells.repartition("hub", "p", "q").sortWithinPartitions("hub", "p", "q")
    return map_arrow(dealt.select("hub", "p", "q", "part", "node", "label", "size", "own"), run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", k: int = 3, num: int = 85, den: int = 100, bands: int = 20, rows: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links) and kept, for every row.

    Words are runs of bytes outside ASCII white space after A-Z are lower-cased; a text with fewer than k words has them all as one shingle.
    Texts that are null, empty or without words have no shingles and no links. A row with a null doc_id links with nothing: component_id is null, kept true.
    Rows that share a doc_id are one document: whatever links with one of its texts links with all of them but those without shingles. n_shingles is each row's own.
    An empty table gives no rows. Shingles count as equal if their 64-bit hashes are.
    """
    slim = only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    key = ["s1", "s2", "n_shingles"]
    base = written(signatures(slim, k, bands, rows), "signatures")
    alike = base.where("n_shingles > 0 and doc_id is not null").groupBy(*key)
    nodes = written(alike.agg(F.min("doc_id").alias("doc"), F.first("buckets").alias("buckets")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    # joins on a bucket are between written tables, so that a bucket of many members can be split among tasks
    member = written(nodes.select("node", F.explode("buckets").alias("bucket")), "members")
    sizes = written(member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    shared = written(member.join(sizes, "bucket"), "shared")
    weight = shared.groupBy("node").agg(F.sum(F.log2("n")).alias("weight"))
    best = written(shared.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("m")).select("bucket", F.col("m.node").alias("hub")), "best")
    around = written(shared.join(best, "bucket").where("node <> hub").select("node", "hub").distinct(), "hubs")
    involved = around.select("node").unionAll(around.select("hub")).distinct()
    sets = written(sets_of(slim, written(involved.join(nodes.select("node", "doc", *key), "node"), "involved"), k), "sets")
    pairs = around.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = written(verified(pairs, sets, num, den).unionAll(links_by_id(base, nodes)), "links")
    labels = components(links)
    # members of one hub in different components
    placed = around.join(labels, "node", "left").select("node", "hub", F.coalesce("label", "node").alias("label"))
    split = placed.groupBy("hub").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("hub", "n")
    apart = written(placed.join(split, "hub").join(nodes.select("node", F.col("n_shingles").alias("size")), "node"), "apart")
    few = apart.where(F.col("n") <= FEW).select("hub", "node", "label", "size")
    x, y = few.alias("x"), few.alias("y")
    fits = den * F.least("x.size", "y.size") >= num * F.greatest("x.size", "y.size")
    near = x.join(y, (F.col("x.hub") == F.col("y.hub")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")) & fits).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    own = F.array_sort(F.concat(F.array_except("sa", "sb"), F.array_except("sb", "sa")))
    many = similar(sets, apart.where(F.col("n") > FEW), "node", "hub").withColumn("own", own).withColumn("parts", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("part", F.expr("cast(pmod(xxhash64(node), parts) as int)"))
    cells = many.select("hub", "node", "label", "size", "own", "part", F.explode(F.expr("sequence(0, parts - 1)")).alias("other")).withColumn("p", F.least("part", "other")).withColumn("q", F.greatest("part", "other"))
    extra = written(verified(near, sets, num, den).unionAll(links_within(cells, num, den)), "links")
    if not extra.isEmpty():
        labels = components(links.unionAll(extra))
    least = written(labels.join(nodes.select("node", "doc"), "node").groupBy("label").agg(F.min("doc").alias("least")), "least")
    roots = written(nodes.select(*key, "node", "doc").join(labels.join(least, "label"), "node", "left").select(*key, F.coalesce("least", "doc").alias("root")), "roots")
    found = base.drop("buckets").join(roots, key, "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("root", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
