"""Records of three sources: ingest of files, and adapters from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import normalize as N
from lakeloom.sources.tsv import read_source

ANCHOR = "S1-"
COLUMNS = ["record_id", "name", "address", "city", "state", "zip_code", "country"]


def is_anchor(record_id: Column | str = "record_id") -> Column:
    return (F.col(record_id) if isinstance(record_id, str) else record_id).startswith(ANCHOR)


def with_defaults(df: DataFrame) -> DataFrame:
    """Absent optional columns as ''; others pass through."""
    return df.withColumns({c: F.lit("") for c in COLUMNS if c not in df.columns}).na.fill("")


def normalized(df: DataFrame) -> DataFrame:
    """Name, address and country normalized where present."""
    by = {"name": N.normalize_name, "address": N.normalize_address, "country": N.normalize_country}
    return df.withColumns({c: f(F.col(c)) for c, f in by.items() if c in df.columns})


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows; columns that a frame lacks are ''."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.na.fill("")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ingest(spark: SparkSession, dataset: str, split: str) -> DataFrame | None:
    """The normalized records of a split's three files, or None (with a warning) if one is missing."""
    paths = [f"{dataset}/{split}/{split}_source{k}.tsv" for k in (1, 2, 3)]
    if lost := [p for p in paths if not exists(spark, p)]:
        print(f"warning: {lost} missing, split {split} is empty")
        return None
    return union_all([normalized(read_source(spark, p)) for p in paths])


def unique_ids(records: DataFrame) -> DataFrame:
    """The records, or an error if a record_id repeats."""
    again = records.groupBy("record_id").count().where("count > 1").limit(3).collect()
    if again:
        raise ValueError(f"record ids repeat: {[r.record_id for r in again]}")
    return records


def from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in records of the documents table, every row one record: source by doc_id, name and address the first and last six words of the cleaned text; text_id is a digest that equal texts share."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", F.split(N.six_words("text"), "\n").alias("ends"))
    return docs.select(F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("record_id"), F.col("ends")[0].alias("name"), F.col("ends")[1].alias("address"), F.col("lang").alias("country"), F.sha2("text", 256).alias("text_id"))


def from_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in records of customers (S1), suppliers (S2) and parts (S3), with nations as countries."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    nation = read("nation").select(F.col("n_nationkey").alias("k"), F.lower("n_name").alias("country"))
    ident = lambda s, c: F.concat(F.lit(s), F.col(c).cast("string")).alias("record_id")
    customer = read("customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("k"), "left").select(ident("S1-", "c_custkey"), N.clean_text("c_name").alias("name"), F.lower("c_mktsegment").alias("address"), "country")
    supplier = read("supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("k"), "left").select(ident("S2-", "s_suppkey"), N.clean_text("s_name").alias("name"), F.lit("").alias("address"), "country")
    part = read("part").select(ident("S3-", "p_partkey"), N.clean_text("p_name").alias("name"), N.clean_text("p_type").alias("address"), F.lit("").alias("country"))
    return union_all([customer, supplier, part])
