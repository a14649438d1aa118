"""Linkage of anchors that arrive in files: each micro-batch is matched against the static targets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators import blocking, decision
from lakeloom.plans.linkage import score
from lakeloom.sources.records import normalized, union_all
from lakeloom.sources.stage import written
from lakeloom.sources.tsv import RENAMED


def anchor_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Normalized anchors of tab-separated files as they arrive in a folder."""
    raw = spark.readStream.schema(schema).csv(folder, sep="\t", header=True, quote='"', escape='"')
    return normalized(raw.withColumnsRenamed(RENAMED).na.fill(""))


def link(stream: DataFrame, targets: DataFrame, threshold: float, sink: Callable[[DataFrame, int], None], checkpoint: str, fitted=None, max_token_freq: int = 10, **trigger) -> StreamingQuery:
    """Calls sink(matching lists, batch id) for every batch, one row for each of its anchors. A batch that is run again gives the same rows, so a sink that overwrites by batch id is exact.

    The targets and their rare postings are written once, before the first batch.
    """
    targets = written(targets, "targets")
    postings = {c: written(blocking.rare_postings(targets, c, max_token_freq), "postings") for c in ("name", "address")}

    def one(batch: DataFrame, batch_id: int) -> None:
        pairs = blocking.retrieve(batch, targets, max_token_freq, postings)
        sink(decision.assemble_matches(score(union_all([batch, targets]), pairs, fitted), threshold, batch), batch_id)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
