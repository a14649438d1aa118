"""Tab-separated files: sources, ground truth and results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RENAMED = {"entity_id": "record_id", "business_name": "name", "business_address": "address"}
EXPECTED = ["record_id", "name", "address", "city", "state", "zip_code", "country"]


def holds_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field may hold a line break: some line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """Files whose lines are whole rows are split among tasks; only those with line breaks in a field take one task each."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=False, quote='"', escape='"', multiLine=holds_breaks(spark, path), encoding="UTF-8")


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings under internal names; blanks are '', the literal NA stays text. A missing file is an error."""
    return _scan(spark, path).withColumnsRenamed(RENAMED).na.fill("")


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """anchor and matches, by position: an id and a comma-joined list of ids, null if blank."""
    df = _scan(spark, path)
    first, second = (F.col(f"`{c}`") for c in df.columns[:2])
    blank = F.trim(F.coalesce(second, F.lit(""))).isin("", "nan", "NaN", "NA", "N/A", "NULL", "null", "None", "n/a")
    return df.select(first.alias("anchor"), F.when(~blank, second).alias("matches"))


def missing_columns(df: DataFrame, expected: Iterable[str] = EXPECTED) -> list[str]:
    return [c for c in expected if c not in df.columns]


def require_columns(df: DataFrame, name: str, expected: Iterable[str] = EXPECTED) -> DataFrame:
    """The frame itself, or an error that lists what is missing. No job runs."""
    if lost := missing_columns(df, expected):
        raise ValueError(f"{name}: missing columns {lost}")
    return df


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, single: bool = False) -> None:
    """Writes a folder of tab-separated parts; blanks stay blank. `single` asks for one part."""
    (df.coalesce(1) if single else df).write.mode(mode).csv(path, sep="\t", header=header, quote='"', escape='"', emptyValue="", nullValue="")


def write_rows(spark: SparkSession, rows: Iterable[Mapping[str, object]], path: str, fields: list[str]) -> None:
    """Rows given as mappings, in the order of `fields`."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    data = [tuple(None if r.get(f) is None else str(r[f]) for f in fields) for r in rows]
    write_tsv(spark.createDataFrame(data, schema), path, single=True)
