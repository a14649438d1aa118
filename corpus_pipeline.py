"""A training-data pipeline over `documents`: toxicity, near-duplicates, benchmark decontamination, byte-level BPE."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import bpe, decontaminate, near_dedup, toxicity
from lakeloom.llm.common import release, table, written


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled rows outside the held-out fold, does not call toxic. Rows with a null doc_id are scored like others."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(*toxicity.labelled_sample(table(spark, sf_dir, "documents"), labels, "text", "toxic", 0, 1500))
    release()
    return toxicity.kept(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group: five words, a similarity of 0.8 or more; null ids come last.

    Rows are judged by their texts, whatever their ids: those with a null or repeated doc_id are documents of their own, named by a hash of id and text, and
    only they are exchanged whole. Of rows equal in id and text the least stays; rows with a null doc_id and no words all stay.
    """
    twice = written(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("other")), "repeated")
    same = F.col("doc_id") == F.col("other")
    plain = docs.where("doc_id is not null").join(twice, same, "left_anti")
    odd = written(docs.where("doc_id is null").unionByName(docs.join(twice, same, "left_semi")).withColumn("other", F.xxhash64("doc_id", "text")), "odd")
    keyed = docs if odd.isEmpty() else plain.select("doc_id", "text").unionByName(odd.select(F.col("other").alias("doc_id"), "text"))
    groups = written(near_dedup.near_duplicates(keyed, k=5, num=80, den=100, bands=25, rows=4), "groups")
    names = odd.select("other", F.col("doc_id").alias("id"), F.lit(True).alias("odd")).distinct()
    member = groups.where("n_shingles > 0").select(F.col("doc_id").alias("other"), "component_id").distinct().join(names, "other", "left")
    member = member.withColumn("id", F.when(F.col("odd"), F.col("id")).otherwise(F.col("other")))
    rank = F.struct(F.col("id").isNull(), "id", "other")
    best = written(member.groupBy("component_id").agg(F.min_by("other", rank).alias("best"), F.count("*").alias("n")).where("n > 1").drop("n"), "best")  # so that a large group can be split among tasks
    lost = written(member.join(best, "component_id").where("other <> best").select("other", F.coalesce("odd", F.lit(False)).alias("odd")), "lost")
    single = plain.join(lost.where("not odd"), same, "left_anti")
    rest = odd.join(lost.where("odd").select("other"), "other", "left_anti").select("other", *docs.columns)
    blank = F.col("doc_id").isNull() & ~F.coalesce("text", F.lit("")).rlike("[^\\t-\\r ]")
    least = rest.where(~blank).groupBy("other").agg(F.min(F.struct(*docs.columns)).alias("r"))
    return single.unionByName(least.select("r.*").select(*docs.columns)).unionByName(rest.where(blank).select(*docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    return bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", not_toxic), ("near_dedup", one_of_each_group), ("decontamination", without_benchmark), ("bpe", tokens)]

#: The stages train a model, cluster by MinHash and contract byte pairs: not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
