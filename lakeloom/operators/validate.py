"""Checks of written results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT = ["source1_entity_id", "matched_entity_ids"]
SCORED = ["id_1", "id_2", "score"]


def findings(df: DataFrame, expected: list[str], blank_ok: list[str] | None = None) -> DataFrame:
    """One row: rows, columns_ok (exactly the expected ones, in order), nulls (in columns that may not be blank) and valid."""
    strict = [c for c in df.columns if c not in (blank_ok or [])]
    nulls = sum((F.col(f"`{c}`").isNull().cast("long") for c in strict), F.lit(0).cast("long"))
    ok = df.columns == expected
    out = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(nulls), F.lit(0).cast("long")).alias("nulls"))
    return out.select("rows", F.lit(ok).alias("columns_ok"), "nulls", (F.lit(ok) & (F.col("nulls") == 0)).alias("valid"))


def validate_file(spark: SparkSession, path: str, expected: list[str] = RESULT, blank_ok: list[str] | None = None) -> bool:
    """Whether the file exists, has exactly the expected columns and no null but in columns that may be blank (the match list of the default schema)."""
    from lakeloom.sources.records import exists

    if not exists(spark, path):
        return False
    if blank_ok is None:
        blank_ok = ["matched_entity_ids"] if expected == RESULT else []
    return findings(spark.read.csv(path, sep="\t", header=True), expected, blank_ok).first()["valid"]
