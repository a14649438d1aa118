"""Sharding by histogram sort: splitters are found by counting, then rows are exchanged once.

Rows are ordered by (hash of the text, doc_id), so that equal texts lie side by
side. A round counts the exact bytes and rows below every probe in one pass over
a slim table of keys; probes then close in on each target until the bytes below
a probe are within tolerance of it. Probes are hash values first, which never
part equal texts; only where one text's copies outweigh the tolerance do probes
go on to doc_id within that hash. Copies with the same doc_id stay together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import map_arrow, only, texts, written

Key = tuple[int, int]  # hash, doc_id; a boundary is the least key at or above it
LOW, HIGH = -(2**63), 2**63 - 1


def keys(docs: DataFrame, text: str) -> DataFrame:
    """h (hash of the text), d (doc_id; null: the least integer), size, doc_id and text_crc32 of every row. A null text counts as the empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = texts(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.fill_null(batch.column(1), LOW), pa.array([len(x) + 1 for x in raw], pa.int64()), batch.column(1), pa.array([zlib.crc32(x) for x in raw], pa.int64())], ["h", "d", "size", "doc_id", "text_crc32"])

    slim = only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(slim.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "doc_id", "text"), run, "h bigint, d bigint, size bigint, doc_id bigint, text_crc32 bigint")


def bucket_of(h: np.ndarray, d: np.ndarray, probes: list[Key]) -> np.ndarray:
    """The number of sorted probes at or below each key."""
    ph, pd = np.array([p[0] for p in probes], np.int64), np.array([p[1] for p in probes], np.int64)
    out, after = np.searchsorted(ph, h, "left"), np.searchsorted(ph, h, "right")
    same = np.flatnonzero(after > out)
    for value in np.unique(h[same]):
        mine = same[h[same] == value]
        lo, hi = out[mine[0]], after[mine[0]]
        out[mine] += np.searchsorted(pd[lo:hi], d[mine], "right")
    return out


def counted(slim: DataFrame, probes: list[Key]) -> list[tuple[int, int]]:
    """Exact bytes and rows below each probe: one pass, summed in each task; a row for each task and non-empty bucket is exchanged."""
    shared = slim.sparkSession.sparkContext.broadcast(probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        size, rows = np.zeros(len(own) + 1, np.int64), np.zeros(len(own) + 1, np.int64)
        for batch in batches:
            b = bucket_of(batch.column(0).to_numpy(), batch.column(1).to_numpy(), own)
            np.add.at(size, b, batch.column(2).to_numpy())
            rows += np.bincount(b, minlength=len(own) + 1)
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(size[full]), pa.array(rows[full])], ["b", "bytes", "rows"])

    got = map_arrow(slim.select("h", "d", "size"), run, "b bigint, bytes bigint, rows bigint").groupBy("b").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect()
    size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for r in got:
        size[r["b"]], rows[r["b"]] = r["bytes"], r["rows"]
    return list(zip(np.cumsum(size)[:-1].tolist(), np.cumsum(rows)[:-1].tolist(), strict=True))


def spread(lo: int, hi: int, n: int) -> list[int]:
    """Up to n whole numbers strictly between lo and hi, evenly apart."""
    return sorted({lo + (hi - lo) * k // (n + 1) for k in range(1, n + 1)} - {lo, hi})


def refined(lo: Key, hi: Key, ids: Key, probes: int) -> list[Key]:
    """Probes between two boundaries: by hash as long as hashes lie between, then by doc_id within one hash. ids: the least doc_id and one above the largest."""
    if hi[0] - lo[0] >= 2:
        return [(x, LOW) for x in spread(lo[0], hi[0], probes)]
    if hi[0] == lo[0] + 1 and hi[1] != LOW:
        return [(hi[0], LOW)]
    return [(lo[0], x) for x in spread(max(lo[1], ids[0]), min(hi[1], ids[1]) if hi[0] == lo[0] else ids[1], probes)]


def splitters(slim: DataFrame, targets: list[tuple[float, float]], probes: int = 24) -> tuple[list[Key], dict[Key, tuple[int, int]]]:
    """For targets (bytes below, slack), boundaries whose bytes below are within slack of the target, or the nearest where no key lies between its neighbours; and the exact bytes and rows below every boundary probed."""
    t = slim.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows"), F.min("d").alias("low"), F.max("d").alias("high")).first()
    ids = (LOW if t["low"] is None else t["low"], HIGH if t["high"] is None else min(HIGH, t["high"] + 1))
    known: dict[Key, tuple[int, int]] = {(LOW, LOW): (0, 0), (HIGH, HIGH): (t["bytes"], t["rows"])}
    final: dict[int, Key] = {}
    while len(final) < len(targets):
        order = sorted(known)
        below = np.array([known[k][0] for k in order])
        ask: set[Key] = set()
        for k, (target, slack) in enumerate(targets):
            if k in final:
                continue
            at = min(max(int(np.searchsorted(below, target, "right")), 1), len(order) - 1)
            lo, hi = order[at - 1], order[at]
            near = min((lo, hi), key=lambda x: abs(known[x][0] - target))
            fresh = [] if abs(known[near][0] - target) <= slack else [x for x in refined(lo, hi, ids, probes) if x not in known]
            if fresh:
                ask.update(fresh)
            else:
                final[k] = near
        if ask:
            listed = sorted(ask)
            known |= dict(zip(listed, counted(slim, listed), strict=True))
    return [final[k] for k in range(len(targets))], known


def shards(docs: DataFrame, n: int = 16, text: str = "text", tolerance: float = 0.002, task_rows: int = 500_000) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null) of every row: shards of nearly equal bytes, equal texts together where that keeps them so.

    Boundaries are within tolerance * total / n bytes of their targets. Rows with a null doc_id come first among equal texts; repeated rows have slots of their own and stay together.
    An empty table gives no rows; with fewer distinct keys than shards some shards are empty. A shard of many rows is ordered as several ranges, whose first slots follow from the counts.
    """
    slim = written(keys(docs, text), "keys")
    t = slim.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    fine = max(1, -(-t["rows"] // (n * task_rows)))
    share = t["bytes"] / n
    targets = [(share * k / fine, max(1.0, tolerance * share) if k % fine == 0 else 0.5 * share / fine) for k in range(1, n * fine)]
    cuts, known = splitters(slim, targets)
    edges = cuts[fine - 1 :: fine][: n - 1]
    ranges = sorted({(LOW, LOW), *cuts})
    shard = [sum(e <= k for e in edges) for k in ranges]
    first = [known[k][1] - (known[edges[s - 1]][1] if s else 0) for k, s in zip(ranges, shard, strict=True)]
    shared = docs.sparkSession.sparkContext.broadcast((ranges[1:], np.array(shard, np.int32), np.array(first, np.int64)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes, own, offset = shared.value
        for batch in batches:
            b = bucket_of(batch.column(0).to_numpy(), batch.column(1).to_numpy(), probes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(b.astype(np.int32)), pa.array(own[b]), pa.array(offset[b])], [*batch.schema.names, "range", "shard", "offset"])

    dealt = map_arrow(slim, assign, "h bigint, d bigint, size bigint, doc_id bigint, text_crc32 bigint, range int, shard int, offset bigint")
    slot = F.col("offset") + F.row_number().over(Window.partitionBy("range").orderBy("h", "d")) - 1
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
