"""Links between groups of equal records: records that agree in every attribute are one group, and a pair of groups stands for all pairs of their members.

A name that thousands of records share makes millions of pairs, but few pairs of groups. Candidates, similarities, scores and counts are made once
for each pair of groups; lists are made once for each group, and pairs of records come out last, from chunks that are dealt out evenly. Nothing is left out.

A group goes by its least record_id, so that groups can stand where records do: `groups` and pairs of them (id_1, id_2; the first has anchors, the second
targets) have the columns that features and scores expect. Records whose id repeats are groups by id, whatever their attributes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.normalize import tokens
from lakeloom.operators.evaluate import block_metrics, metrics
from lakeloom.sources.records import is_anchor
from lakeloom.sources.stage import even, written

#: Ids in a chunk; a pair of chunks expands to the square of this at most.
CHUNK = 256


@dataclass
class Groups:
    #: record_id of the group, its attributes, n_anchors, n_targets; several rows only where an id repeats.
    groups: DataFrame
    #: record_id of the group, anchor, and at most about CHUNK members: structs of id and ts, the texts of theirs that both sides hold.
    chunks: DataFrame

    def members(self, anchor: bool) -> DataFrame:
        """group and record_id."""
        side = F.col("anchor") if anchor else ~F.col("anchor")
        return self.chunks.where(side).select(F.col("record_id").alias("group"), F.explode("members.id").alias("record_id"))

    def sizes(self) -> DataFrame:
        """record_id of each group, n_anchors and n_targets."""
        return self.groups.groupBy("record_id").agg(F.max("n_anchors").alias("n_anchors"), F.max("n_targets").alias("n_targets"))

    def truth(self) -> DataFrame:
        """Pairs of groups that hold n_true pairs of equal texts."""
        each = self.chunks.select("record_id", "anchor", F.explode("members").alias("m")).select("record_id", "anchor", F.explode("m.ts").alias("t"))
        each = each.groupBy("record_id", "anchor", "t").agg(F.count("*").alias("n"))
        left, right = (each.where(side).select(F.col("record_id").alias(f"id_{k}"), "t", F.col("n").alias(f"n_{k}")) for k, side in ((1, "anchor"), (2, "not anchor")))
        found = left.join(right, "t").groupBy("id_1", "id_2").agg(F.sum(F.col("n_1") * F.col("n_2")).alias("n_true"))
        return self.with_sizes(found).withColumn("n_true", F.least("n_true", "n")).drop("n")  # ids that repeat may share two texts

    def with_sizes(self, pairs: DataFrame) -> DataFrame:
        """The pairs of groups with n, the number of pairs of their members."""
        sizes = self.sizes()
        out = pairs.join(sizes.select(F.col("record_id").alias("id_1"), F.col("n_anchors").alias("__a")), "id_1").join(sizes.select(F.col("record_id").alias("id_2"), F.col("n_targets").alias("__t")), "id_2")
        return out.withColumn("n", F.col("__a") * F.col("__t")).drop("__a", "__t")

    def labelled(self, pairs: DataFrame) -> DataFrame:
        """The pairs of groups with n and n_true."""
        return self.with_sizes(pairs).join(self.truth(), ["id_1", "id_2"], "left").na.fill(0, ["n_true"])

    def counted(self, pairs: DataFrame) -> DataFrame:
        """The pairs of groups in a row for each label, with n, the number of their members' pairs that have it."""
        labels = F.array(*[F.struct(F.lit(y).alias("label"), n.alias("n")) for y, n in ((1, F.col("n_true")), (0, F.col("n") - F.col("n_true")))])
        return self.labelled(pairs).withColumn("__y", F.explode(labels)).drop("n", "n_true").select("*", "__y.label", "__y.n").drop("__y").where("n > 0")

    def expanded(self, pairs: DataFrame, label: bool = False) -> DataFrame:
        """Every pair of members, with the columns of its pair of groups; with `label`, 1 where the texts are equal, else 0."""
        rest = [c for c in pairs.columns if c not in ("id_1", "id_2")]
        out = self.labelled(pairs) if label else pairs
        member = F.col("members") if label else F.col("members.id")
        for k, side in ((1, F.col("anchor")), (2, ~F.col("anchor"))):
            out = out.join(self.chunks.where(side).select(F.col("record_id").alias(f"id_{k}"), member.alias(f"m_{k}")), f"id_{k}")
        out = even(out.drop("id_1", "id_2"))
        for k in (1, 2):
            out = out.select(*[c for c in out.columns if c != f"m_{k}"], F.explode(f"m_{k}").alias(f"e_{k}"))
        if not label:
            return out.select(F.col("e_1").alias("id_1"), F.col("e_2").alias("id_2"), *rest)
        same = F.when(F.col("n_true") == 0, 0).when(F.col("n_true") == F.col("n"), 1).otherwise(F.arrays_overlap("e_1.ts", "e_2.ts").cast("int"))
        return out.select(F.col("e_1.id").alias("id_1"), F.col("e_2.id").alias("id_2"), *rest, same.alias("label"))

    def lists(self, pairs: DataFrame, name: str, anchors: DataFrame | None = None) -> DataFrame:
        """source1_entity_id and the comma-joined, sorted partners of every anchor, '' for none; `anchors`, if given, are some of members(True). Anchors of a group share a list."""
        held = self.chunks.where(~F.col("anchor")).select(F.col("record_id").alias("id_2"), F.col("members.id").alias("ids"))
        made = pairs.select("id_1", "id_2").distinct().join(held, "id_2").groupBy(F.col("id_1").alias("group")).agg(F.array_join(F.array_sort(F.flatten(F.collect_list("ids"))), ",").alias(name))
        every = self.members(True) if anchors is None else anchors
        return every.join(made, "group", "left").select(F.col("record_id").alias("source1_entity_id"), F.coalesce(name, F.lit("")).alias(name))


def grouped(records: DataFrame) -> Groups:
    """Groups of records of record_id, attributes and text_id, a digest that equal texts share. Rows without an id belong to neither side."""
    columns = [c for c in records.columns if c not in ("record_id", "text_id")]
    again = records.groupBy("record_id").agg(F.count("*").alias("n")).where("n > 1").select("record_id", F.col("record_id").alias("own"))
    marked = written(records.where("record_id is not null").join(again, "record_id", "left").withColumn("anchor", is_anchor()), "marked")
    number = lambda side: F.when(F.first("own").isNotNull(), F.max(side.cast("long"))).otherwise(F.sum(side.cast("long")))
    groups = marked.groupBy("own", *columns).agg(F.min("record_id").alias("record_id"), number(F.col("anchor")).alias("n_anchors"), number(~F.col("anchor")).alias("n_targets"))
    groups = written(groups, "groups")
    shared = marked.where("text_id is not null").groupBy("text_id").agg(F.min("record_id").alias("t"), F.bool_or("anchor").alias("a"), F.bool_and("anchor").alias("all")).where("a and not all").select("text_id", "t")
    names = groups.select(F.col("record_id").alias("group"), F.col("own").alias("__own"), *[F.col(c).alias(f"__{c}") for c in columns], (F.col("n_anchors") + F.col("n_targets")).alias("size"))
    same = F.lit(True)
    for c in ("own", *columns):
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    each = marked.join(shared, "text_id", "left").join(names, same).groupBy("group", "record_id").agg(F.first("anchor").alias("anchor"), F.first("size").alias("size"), F.collect_set("t").alias("ts"))
    part = F.pmod(F.xxhash64("record_id"), F.ceil(F.col("size") / CHUNK))
    chunks = each.groupBy(F.col("group").alias("group"), "anchor", part.alias("part")).agg(F.collect_list(F.struct(F.col("record_id").alias("id"), "ts")).alias("members"))
    return Groups(groups.drop("own"), written(chunks.select(F.col("group").alias("record_id"), "anchor", "members"), "members"))


def _words(column: str) -> Column:
    return F.array_distinct(F.filter(tokens(F.col(column)), lambda w: F.length(w) > 2))


def equal_values(g: Groups, column: str, trimmed: bool = True) -> DataFrame:
    """Pairs of groups of equal, non-blank values."""
    key = F.trim(column) if trimmed else F.col(column)
    left, right = (g.groups.where(f"{n} > 0").select(F.col("record_id").alias(f"id_{k}"), key.alias("key")).where("key <> ''") for k, n in ((1, "n_anchors"), (2, "n_targets")))
    return left.join(right, "key").select("id_1", "id_2")


def rare_token(g: Groups, column: str, max_token_freq: int) -> DataFrame:
    """Pairs of groups that share a token of over two characters which at most max_token_freq targets have."""
    keyed = g.groups.select("record_id", "n_anchors", "n_targets", F.explode(_words(column)).alias("key")).distinct()
    rare = keyed.groupBy("key").agg(F.sum("n_targets").alias("n")).where(F.col("n").between(1, max_token_freq)).select("key")
    targets = keyed.where("n_targets > 0").join(rare, "key").select(F.col("record_id").alias("id_2"), "key")
    return keyed.where("n_anchors > 0").select(F.col("record_id").alias("id_1"), "key").join(targets, "key").select("id_1", "id_2")


def retrieve(g: Groups, max_token_freq: int = 10) -> DataFrame:
    """Distinct pairs of groups that hold blocking.retrieve's candidates: exact names, rare name tokens, rare address tokens."""
    return written(equal_values(g, "name").unionAll(rare_token(g, "name", max_token_freq)).unionAll(rare_token(g, "address", max_token_freq)).distinct(), "pairs")


def match_metrics(g: Groups, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """evaluate.match_metrics of all members' pairs against equal texts."""
    zero = F.lit(0).cast("long")
    both = g.with_sizes(predicted.select("id_1", "id_2").distinct()).join(g.truth(), ["id_1", "id_2"], "full")
    total = lambda c: F.coalesce(F.sum(c), zero)
    hit = F.when(F.col("n").isNotNull(), F.coalesce("n_true", zero)).otherwise(zero)
    return metrics(both.agg(total(hit).alias("true_positives"), total(F.col("n") - hit).alias("false_positives"), total(F.col("n_true") - hit).alias("false_negatives")), beta)


def blocking_metrics(g: Groups, pairs: DataFrame, total_records: DataFrame) -> DataFrame:
    """evaluate.blocking_metrics of all members' pairs against equal texts."""
    truth, candidates = g.truth(), pairs.select("id_1", "id_2").distinct()
    long = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    found = truth.join(candidates.withColumn("hit", F.lit(1)), ["id_1", "id_2"], "left").agg(long("n_true").alias("true_match_count"), long(F.col("n_true") * F.col("hit")).alias("matches_found"))
    return block_metrics(found, g.with_sizes(candidates).agg(long("n").alias("candidate_count")), total_records)


def with_names(g: Groups, pairs: DataFrame) -> DataFrame:
    """The pairs of groups with name and country of both."""
    out = pairs.select("id_1", "id_2")
    for k in (1, 2):
        out = out.join(g.groups.select(F.col("record_id").alias(f"id_{k}"), F.col("name").alias(f"name_{k}"), F.col("country").alias(f"country_{k}")), f"id_{k}")
    return out
