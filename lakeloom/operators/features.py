"""Pair features: both records' attributes joined to a pair, ten similarities in a fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import similarity as S
from lakeloom.sources.stage import even

FEATURES = ["name_exact_match", "name_jaccard", "name_seq_matcher", "addr_exact_match", "addr_jaccard", "addr_seq_matcher", "city_match", "state_match", "country_match", "zip_match"]
AGREEMENTS = {"city_match": "city", "state_match": "state", "country_match": "country", "zip_match": "zip_code"}
ATTRIBUTES = ["name", "address", *AGREEMENTS.values()]


def attributes(pairs: DataFrame, records: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The pairs with <column>_1 and <column>_2 of either record; a missing record or value is ''. Columns that no feature needs are pruned before the joins."""
    columns = columns or ATTRIBUTES
    out = pairs
    for k in (1, 2):
        side = records.select(F.col("record_id").alias(f"id_{k}"), *[(F.col(c) if c in records.columns else F.lit("")).alias(f"{c}_{k}") for c in columns])
        out = out.join(side, f"id_{k}", "left")
    return out.na.fill("", [f"{c}_{k}" for c in columns for k in (1, 2)])


def name_features(a: str, b: str, prefix: str = "name") -> list:
    x, y = F.col(a), F.col(b)
    return [S.exact_match(x, y).alias(f"{prefix}_exact_match"), S.jaccard(x, y).alias(f"{prefix}_jaccard"), S.seq_ratio(x, y).alias(f"{prefix}_seq_matcher")]


def agreement_features() -> list:
    return [S.agreement(F.col(f"{c}_1"), F.col(f"{c}_2")).alias(f) for f, c in AGREEMENTS.items()]


def build_features(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """id_1, id_2 and the features of every distinct pair, argument order as in the pair."""
    wide = even(attributes(pairs.select("id_1", "id_2").distinct(), records))
    return wide.select("id_1", "id_2", *name_features("name_1", "name_2"), *name_features("address_1", "address_2", "addr"), *agreement_features())


def baseline_score(features: DataFrame) -> DataFrame:
    """score: the mean of the similarities present among three, nulls left out; 0 if there is none."""
    have = [c for c in ("name_jaccard", "addr_jaccard", "name_seq_matcher") if c in features.columns]
    if not have:
        return features.withColumn("score", F.lit(0.0))
    total = sum((F.coalesce(F.nanvl(F.col(c), F.lit(None)), F.lit(0.0)) for c in have), F.lit(0.0))
    known = sum((F.when(F.col(c).isNull() | F.isnan(c), 0).otherwise(1) for c in have), F.lit(0))
    return features.withColumn("score", F.when(known > 0, total / known).otherwise(0.0))
