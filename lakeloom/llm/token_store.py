"""Token ids in Parquet: a list column per document, delta-encoded keys, controlled row groups, pages with an index.

Files hold documents in ascending doc_id order, so that row-group statistics and
the page index let a reader fetch the tokens of a range of documents, or the
metadata of all, without the rest: ids are dictionary-encoded, keys and
counts delta-encoded (writer version 2). A written store is only ever added as
a whole; Spark's committer makes lost tasks harmless.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.chunks import ChunkEncoder, sizes_of, word_cuts
from lakeloom.llm.common import held, map_arrow, only, written

WRITER = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.page.write-checksum.enabled": "true",
    "compression": "zstd",
}


@dataclass
class Encoder:
    """Ids as the library's encode() gives them: texts that hold one of the `added` tokens (a pattern) go to the library whole, all others by stretches."""

    plain: ChunkEncoder
    added: str
    whole: Callable[[str], list[int]]

    def column(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For runs of texts: first row, end row, all their ids, and the bounds of each text's."""
        holds = pc.fill_null(pc.match_substring_regex(column, self.added), False) if self.added else pa.repeat(False, len(column))
        held = np.flatnonzero(holds.to_numpy(zero_copy_only=False))
        rest = pc.if_else(holds, pa.scalar(None, column.type), column) if len(held) else column
        for i, j, ids, bounds in self.plain.column(rest):
            here = held[(held >= i) & (held < j)]
            if len(here):
                more = [np.array(self.whole(column[int(k)].as_py()), ids.dtype) for k in here]
                sizes = np.zeros(j - i, np.int64)
                sizes[here - i] = [len(x) for x in more]
                ids = np.insert(ids, np.repeat(bounds[here - i], sizes[here - i]), np.concatenate(more))
                bounds = bounds + np.concatenate([[0], np.cumsum(sizes)])
            yield i, j, ids, bounds


def build_encoder(path: str) -> Encoder:
    """The library encodes runs of distinct stretches of text, and whole texts where added tokens occur."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks have one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    vocabulary = tokenizer.get_vocab()
    length = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each token, a character of the vocabulary being a byte
    length[list(vocabulary.values())] = list(map(len, vocabulary))

    added = "|".join(re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values())
    arises = re.compile(added.encode()).search if added else lambda text: None

    def encode(runs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        runs = [part for r in runs for part in ([[k] for k in r] if len(r) > 1 and arises(b"".join(r)) else [r])]  # texts of added tokens that only joining makes
        got = [np.array(x.ids, np.uint32) for x in tokenizer.encode_batch_fast([b"".join(r).decode() for r in runs], add_special_tokens=False)]
        return np.concatenate(got), np.concatenate([sizes_of(r, length[x]) for r, x in zip(runs, got, strict=True)])

    return Encoder(ChunkEncoder(encode, word_cuts), added, lambda text: tokenizer.encode(text, add_special_tokens=False).ids)


def encoder(path: str) -> Encoder:
    """One for each worker."""
    return held(("tokenizer", path), lambda: build_encoder(path))


def token_ids(docs: DataFrame, tokenizer: str, text: str = "text", end: int | None = 0) -> DataFrame:
    """doc_id, n_tokens and tokens of every whole text as the library encodes it, added tokens' strings being those tokens, with the id `end` after each (unless None). Null and empty texts have the end id alone; repeated rows stay, an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            for i, j, ids, bounds in own.column(batch.column(1)):
                if end is not None:
                    ids = np.insert(ids, bounds[1:], end)
                    bounds = bounds + np.arange(j - i + 1)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(bounds).astype(np.int32)), lists], ["doc_id", "n_tokens", "tokens"])

    return map_arrow(only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id bigint, n_tokens int, tokens array<int>", holds=True)


def write(docs: DataFrame, path: str, tokenizer: str, text: str = "text", end: int | None = 0) -> None:
    """Encodes every text and writes doc_id, n_tokens, tokens in ascending doc_id order; null ids come first, repeated rows stay, an empty table gives a store without rows. Texts are exchanged by range once, and encoded in the order they are written."""
    slim = only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    token_ids(slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id"), tokenizer, end=end).write.options(**WRITER).parquet(path)


def read(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, tokens: bool = True) -> DataFrame:
    """The store's rows, or those with first <= doc_id <= last: only their row groups and pages are read. Without `tokens`, only metadata columns are."""
    out = spark.read.schema("doc_id bigint, n_tokens int, tokens array<int>").parquet(path)
    if first is not None:
        out = out.where(F.col("doc_id") >= first)
    if last is not None:
        out = out.where(F.col("doc_id") <= last)
    return out if tokens else out.drop("tokens")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the store's files.

    A task counts the ids before each document within its run of a file; only the runs' totals, a row for each, are summed in order.
    """
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for batch in batches:
            column, sizes = batch.column(2), batch.column(1).to_numpy().astype(np.int64)
            ids = column.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            ends = np.concatenate([[0], np.cumsum(sizes)])
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            local, at = [], batch.column(3).to_pylist()
            for key, n in zip(at, sizes.tolist(), strict=True):
                if key != last:
                    last, total = key, 0
                local.append(total)
                total += n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), batch.column(3), pa.array(local, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "n_tokens", "at", "local", "ids_crc32"])

    rows = read(spark, path).select("doc_id", "n_tokens", "tokens", place.alias("at"))
    hashed = written(map_arrow(rows, run, "doc_id bigint, n_tokens bigint, at struct<file:string,block:bigint>, local bigint, ids_crc32 bigint"), "digests")
    totals = hashed.groupBy("at").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum("n_tokens").alias("n"))
    order = Window.orderBy(F.col("high").asc_nulls_first(), F.col("low").asc_nulls_first(), "at").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("at", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return hashed.join(before, "at").select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
