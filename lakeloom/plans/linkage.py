"""Training and inference of the linkage pipeline, and its commands.

python -m lakeloom.plans.linkage train|infer|evaluate|validate|package [settings file]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators import blocking, decision, evaluate, features, model, validate
from lakeloom.plans.config import Settings, load
from lakeloom.plans.package import DOCUMENTS, build_zip
from lakeloom.sources import records as R
from lakeloom.sources import tsv
from lakeloom.sources.stage import written


def session(name: str = "lakeloom") -> SparkSession:
    return SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true").getOrCreate()


def sides(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    return records.where(R.is_anchor()), records.where(~R.is_anchor())


def train(spark: SparkSession, s: Settings) -> float | None:
    """Fits, tunes the threshold on held-out pairs, refits on all pairs; returns the threshold, or None without data."""
    records = R.ingest(spark, s.dataset_dir, "train")
    if records is None:
        return None
    truth = tsv.read_ground_truth(spark, f"{s.dataset_dir}/train/train_ground_truth.tsv")  # before any work: a missing file is an error
    records = R.unique_ids(written(records, "records"))
    anchors, targets = sides(records)
    chosen = evaluate.capped_anchors(anchors, truth.where(F.col("matches").isNotNull()), s.anchor_cap, s.random_seed)
    pairs = blocking.retrieve(chosen, targets, s.max_token_freq)
    rows = evaluate.label_pairs(features.build_features(records, pairs), evaluate.explode_matches(truth))
    rows = written(rows, "features")
    if rows.isEmpty():
        raise ValueError("blocking found no candidate pairs")
    split = written(evaluate.holdout(rows, s.test_size, s.random_seed), "split")
    params = {"seed": s.random_seed}
    tuned = model.PairModel(params).fit(split.where(~F.col("held_out")).drop("held_out"))
    threshold, f = decision.best_threshold(tuned.predict(split.where("held_out")), s.beta)
    final = model.PairModel(params).fit(rows)
    final.save(spark, s.model_dir)
    model.save_threshold(spark, s.model_dir, threshold, f)
    return threshold


def score(records: DataFrame, pairs: DataFrame, fitted: model.PairModel | None) -> DataFrame:
    """Scored pairs; without a model, by the unsupervised baseline."""
    rows = features.build_features(records, pairs)
    return fitted.predict(rows) if fitted else features.baseline_score(rows)


def infer(spark: SparkSession, s: Settings, resume: bool = False) -> bool:
    """Writes candidate and matching lists, one row for each anchor; False without data. Records and candidates are written tables, which survive lost executors.

    With `resume`, anchors that the matching lists hold already are left as they are and the others are added.
    """
    records = R.ingest(spark, s.dataset_dir, "test")
    if records is None:
        return False
    records = R.unique_ids(written(records, "records"))
    anchors, targets = sides(records)
    results, mode = f"{s.output_dir}/matching_results.tsv", "overwrite"
    if resume and R.exists(spark, results):
        anchors, mode = written(decision.remaining(anchors, tsv.read_source(spark, results)), "remaining"), "append"
    pairs = written(blocking.retrieve(anchors, targets, s.max_token_freq), "candidates")
    scored = score(records, pairs, model.PairModel.load(spark, s.model_dir))
    tsv.write_tsv(decision.candidate_lists(pairs, anchors), f"{s.output_dir}/candidate_pairs.tsv", mode=mode)
    tsv.write_tsv(decision.assemble_matches(scored, model.load_threshold(spark, s.model_dir), anchors), results, mode=mode)
    return True


def assess(spark: SparkSession, s: Settings) -> DataFrame:
    """Match metrics of written results against the test split's truth."""
    found = spark.read.csv(f"{s.output_dir}/matching_results.tsv", sep="\t", header=True)
    truth = tsv.read_ground_truth(spark, f"{s.dataset_dir}/test/test_ground_truth.tsv")
    return evaluate.match_metrics(evaluate.explode_matches(found, "source1_entity_id", "matched_entity_ids"), evaluate.explode_matches(truth), s.beta)


def main(args: list[str]) -> int:
    command, settings = args[0] if args else "", load(*args[1:])
    if command == "package":
        names = ("matching_results.tsv", "candidate_pairs.tsv")
        if lost := build_zip(".", "submission.zip", {f"output/{n}": f"{settings.output_dir}/{n}" for n in names}, documents=DOCUMENTS):
            print(f"warning: no {lost}", file=sys.stderr)
        return 0
    spark = session()
    try:
        if command == "train":
            print(train(spark, settings))
        elif command == "infer":
            infer(spark, settings)
        elif command == "evaluate":
            assess(spark, settings).show(truncate=False)
        elif command == "validate":
            return int(not validate.validate_file(spark, f"{settings.output_dir}/matching_results.tsv"))
        else:
            print(__doc__)
            return 2
    except Exception as e:  # a command says what failed and exits with 1
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
