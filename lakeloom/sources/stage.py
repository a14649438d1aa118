"""Written tables: intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Unset, it is a local one on a local master, as in tests, and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (named or "file:///tmp/checkpoints").rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lakeloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df`, written as Parquet in the shared folder and read again: cuts lineage, survives lost executors and is computed once."""
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def even(df: DataFrame) -> DataFrame:
    """Rows dealt out by turns to the session's number of partitions, which adaptive execution leaves as it is: few bytes may be much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
