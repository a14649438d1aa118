"""Blocking: candidate pairs by equi joins on names, rare tokens, n-grams and exact keys.

A blocker is a function of frames that gives id_1, id_2 with id_1 < id_2; Catalyst
plans the union of several as one query. Frequencies are counted and cut before
any join on the key, so that a frequent token never meets itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.normalize import char_ngrams, tokens
from lakeloom.sources.records import is_anchor


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("id_1"), F.greatest(a, b).alias("id_2")]


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.where("a <> b").select(*ordered(F.col("a"), F.col("b"))).distinct()


def _keyed(df: DataFrame, keys: Column, side: str) -> DataFrame:
    """One row for each record and distinct key."""
    return df.select(F.col("record_id").alias(side), F.explode(F.array_distinct(keys)).alias("key")).distinct()


def exact_name(anchors: DataFrame, targets: DataFrame, column: str = "name", max_name_freq: int | None = None) -> DataFrame:
    """Anchors and targets of equal, non-blank, trimmed names; targets of the anchors' source are skipped.

    All pairs come out, so the output grows with the square of a name's frequency. max_name_freq, if given, leaves out names of more targets;
    exact_name_groups has the same links in a row for each record.
    """
    left = anchors.select(F.col("record_id").alias("a"), F.trim(column).alias("key")).where("key <> ''")
    right = targets.where(~is_anchor()).select(F.col("record_id").alias("b"), F.trim(column).alias("key")).where("key <> ''")
    if max_name_freq is not None:
        right = right.join(right.distinct().groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") <= max_name_freq).select("key"), "key")
    return _pairs(left.join(right, "key"))


def exact_name_groups(anchors: DataFrame, targets: DataFrame, column: str = "name") -> DataFrame:
    """record_id, anchor and group_id (the least record_id of the group) of every record whose non-blank, trimmed name an anchor and a target share: exact_name without the pairs."""
    left = anchors.select("record_id", F.trim(column).alias("key"), F.lit(True).alias("anchor"))
    both = left.unionAll(targets.where(~is_anchor()).select("record_id", F.trim(column).alias("key"), F.lit(False).alias("anchor"))).where("key <> ''").distinct()
    groups = both.groupBy("key").agg(F.min("record_id").alias("group_id"), F.bool_or("anchor").alias("a"), F.bool_and("anchor").alias("all")).where("a and not all")
    return both.join(groups, "key").select("record_id", "anchor", "group_id")


def _words(column: str) -> Column:
    return F.filter(tokens(F.col(column)), lambda w: F.length(w) > 2)


def rare_postings(targets: DataFrame, column: str = "name", max_token_freq: int = 100) -> DataFrame:
    """b and key: targets by each of their tokens of over two characters that at most max_token_freq targets have."""
    postings = _keyed(targets.where(~is_anchor()), _words(column), "b")
    rare = postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") <= max_token_freq).select("key")
    return postings.join(rare, "key")


def rare_token(anchors: DataFrame, targets: DataFrame, column: str = "name", max_token_freq: int = 100, postings: DataFrame | None = None) -> DataFrame:
    """Anchors and targets that share a token of over two characters which at most max_token_freq targets have. `postings`, if given, are the targets' rare_postings."""
    held = rare_postings(targets, column, max_token_freq) if postings is None else postings
    return _pairs(_keyed(anchors, _words(column), "a").join(held, "key"))


def ngram(anchors: DataFrame, targets: DataFrame, column: str = "name", n: int = 3, max_ngram_freq: int = 200, min_shared_ngrams: int = 2) -> DataFrame:
    """Anchors and targets that share at least min_shared_ngrams n-grams which at most max_ngram_freq targets have. Targets are taken as given."""
    grams = char_ngrams(F.col(column), n)
    postings = _keyed(targets, grams, "b")
    rare = postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") <= max_ngram_freq).select("key")
    shared = _keyed(anchors, grams, "a").join(postings.join(rare, "key"), "key").groupBy("a", "b").agg(F.count("*").alias("shared"))
    return _pairs(shared.where(F.col("shared") >= min_shared_ngrams))


def token(records: DataFrame, column: str, stop_words: list[str] | None = None, max_token_freq: int = 1000) -> DataFrame:
    """Any two records that share a token of over two characters, no stop word, which 2 to max_token_freq records have."""
    stop = F.array(*[F.lit(w) for w in stop_words or []]).cast("array<string>")
    posting = _keyed(records.where(F.col(column).isNotNull()), F.array_except(F.filter(tokens(F.col(column)), lambda w: F.length(w) > 2), stop), "a")
    rare = posting.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n").between(2, max_token_freq)).select("key")
    kept = posting.join(rare, "key")
    return kept.join(kept.withColumnRenamed("a", "b"), "key").where("a < b").select(F.col("a").alias("id_1"), F.col("b").alias("id_2")).distinct()


def exact_key(records: DataFrame, keys: list[str]) -> DataFrame:
    """Any two records that agree in all key columns. Null keys pair with nothing, blank ones do; no keys, no pairs."""
    if not keys:
        return records.sparkSession.createDataFrame([], "id_1 string, id_2 string")
    slim = records.select(F.col("record_id").alias("a"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).dropna()
    on = [f"k{i}" for i in range(len(keys))]
    return slim.join(slim.withColumnRenamed("a", "b"), on).where("a < b").select(F.col("a").alias("id_1"), F.col("b").alias("id_2")).distinct()


def combined(pairs: list[DataFrame]) -> DataFrame:
    """The distinct union of blockers' pairs."""
    return reduce(DataFrame.unionByName, pairs).distinct()


def layered(records: DataFrame, max_token_freq: int = 20) -> DataFrame:
    """Token blocking on name and on address, over all sources."""
    return combined([token(records, c, max_token_freq=max_token_freq) for c in ("name", "address")])


def retrieve(anchors: DataFrame, targets: DataFrame, max_token_freq: int = 10, postings: dict[str, DataFrame] | None = None) -> DataFrame:
    """The pipeline's candidates: exact names, rare name tokens, rare address tokens. `postings`: rare_postings of the targets by column, where they are at hand."""
    return combined([exact_name(anchors, targets), *(rare_token(anchors, targets, c, max_token_freq, (postings or {}).get(c)) for c in ("name", "address"))])
