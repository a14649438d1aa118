import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import blocking as B
from lakeloom.operators import decision as D
from lakeloom.operators import evaluate as E
from lakeloom.operators import features as X
from lakeloom.operators import validate as V
from lakeloom.plans import linkage
from lakeloom.plans.config import Manager, Settings, load, resolved
from lakeloom.plans.package import DOCUMENTS, build_zip
from lakeloom.sources import records as R
from lakeloom.sources import tsv


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_tsv_round_trip(spark, tmp_path):
    p = tmp_path / "in.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"Quoted ""X"" Co"\t\tNA\n')
    df = tsv.read_source(spark, str(p))
    assert df.columns == ["record_id", "name", "address", "country"]
    assert rows(df) == {("S1-1", 'Quoted "X" Co', "", "NA")}
    assert tsv.missing_columns(df) == ["city", "state", "zip_code"]
    with pytest.raises(ValueError, match="city"):
        tsv.require_columns(df, "in")
    out = tmp_path / "out"
    tsv.write_tsv(spark.createDataFrame([("a", "")], "x string, y string"), str(out), single=True)
    assert next(out.glob("part*")).read_text() == "x\ty\na\t\n"
    tsv.write_rows(spark, [{"x": 1}], str(out), ["x", "y"])
    assert next(out.glob("part*")).read_text() == "x\ty\n1\t\n"


def test_ground_truth(spark, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text("a\tb\nS1-1\tS2-1, S3-2\nS1-2\t\nS1-3\tnan\n")
    assert rows(E.explode_matches(tsv.read_ground_truth(spark, str(p)))) == {("S1-1", "S2-1"), ("S1-1", "S3-2")}


def test_symmetric_blockers(spark):
    df = spark.createDataFrame([("1", "A", "US"), ("2", "A", "US"), ("3", "B", "US"), ("4", "B", "CA"), ("5", None, "CA"), ("6", "", "x"), ("7", "", "x")], "record_id string, city string, country string")
    assert rows(B.exact_key(df, ["city", "country"])) == {("1", "2"), ("6", "7")}
    assert rows(B.exact_key(df, [])) == set()
    names = spark.createDataFrame([("1", "acme corp"), ("2", "acme inc"), ("3", "widgets llc"), ("4", None)], "record_id string, name string")
    assert rows(B.token(names, "name")) == {("1", "2")}
    assert rows(B.token(names, "name", ["acme"])) == set()
    assert rows(B.token(names, "name", max_token_freq=1)) == set()


def test_anchor_blockers(spark):
    df = spark.createDataFrame([("S1-1", "acme tools", ""), ("S1-2", "", "x"), ("S2-1", "acme tools", "x"), ("S2-2", "acme", ""), ("S3-1", "", ""), ("S3-2", " acme tools ", "")], "record_id string, name string, address string")
    a, t = linkage.sides(df)
    assert rows(B.exact_name(a, t)) == {("S1-1", "S2-1"), ("S1-1", "S3-2")}
    assert rows(B.exact_name(a, df)) == rows(B.exact_name(a, t))
    assert rows(B.rare_token(a, t, "name", 2)) == {("S1-1", "S2-1"), ("S1-1", "S3-2")}  # 'acme' is in three targets
    assert rows(B.rare_token(a, t, "name", 3)) == {("S1-1", x) for x in ("S2-1", "S2-2", "S3-2")}
    assert rows(B.ngram(a, t, min_shared_ngrams=3)) == {("S1-1", "S2-1"), ("S1-1", "S3-2")}
    assert rows(B.retrieve(a.limit(0), t)) == set() and rows(B.retrieve(a, t.limit(0))) == set()


def test_features(spark):
    records = spark.createDataFrame([("S1-1", "acme", "1 main st", "us"), ("S2-1", "acme", "2 main st", "")], "record_id string, name string, address string, country string")
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S9-9")], "id_1 string, id_2 string")
    got = {r.id_2: r for r in X.build_features(records, pairs).collect()}
    assert X.build_features(records, pairs).columns == ["id_1", "id_2", *X.FEATURES]
    assert got["S2-1"].name_exact_match == 1 and got["S2-1"].addr_jaccard == 0.5 and got["S2-1"].country_match == -1 and got["S2-1"].city_match == -1
    assert got["S9-9"].name_jaccard == 0
    scored = X.baseline_score(spark.createDataFrame([(1.0, None), (None, None)], "name_jaccard double, addr_jaccard double"))
    assert [r.score for r in scored.collect()] == [1.0, 0.0]
    assert X.baseline_score(pairs).first().score == 0


def test_sweep_is_brute_force(spark):
    r = random.Random(1)
    data = [(r.choice([round(r.random(), 2), 0.01, 0.99, 1.0, 0.0]), int(r.random() < 0.3)) for _ in range(200)]
    df = spark.createDataFrame(data, "score double, label int")
    for row in D.sweep(df).collect():
        t = row.threshold
        tp, fp, fn = sum(s >= t and y for s, y in data), sum(s >= t and not y for s, y in data), sum(s < t and y for s, y in data)
        assert (row.true_positives, row.false_positives, row.false_negatives) == (tp, fp, fn)
    assert D.best_threshold(df.where("label = 0")) == (0.01, 0.0)
    assert D.best_threshold(df.limit(0)) == (0.01, 0.0)


def test_f_beta_and_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 0)], "label int, predicted int")
    assert D.f_beta_score(df).first().f_beta == 1
    assert D.f_beta_score(spark.createDataFrame([(1, 0), (1, 0)], "label int, predicted int")).first().f_beta == 0
    pred = spark.createDataFrame([("1", "2"), ("3", "4")], "id_1 string, id_2 string")
    truth = spark.createDataFrame([("1", "2"), ("4", "3")], "id1 string, id2 string")
    m = E.match_metrics(pred, truth).first()
    assert (m.true_positives, m.false_positives, m.false_negatives, m.f0_5) == (2, 0, 0, 1)
    n = spark.createDataFrame([(4,)], "n bigint")
    b = E.blocking_metrics(pred, truth.limit(1), n).first()
    assert (b.pair_completeness, b.reduction_ratio, b.candidate_count) == (1, 1 - 2 / 6, 2)
    assert E.blocking_metrics(pred, truth.limit(0), n).count() == 0
    assert E.blocking_metrics(pred, truth, n.select(F.lit(1).alias("n"))).first().reduction_ratio == 0


def test_lists_and_errors(spark, tmp_path):
    anchors = spark.createDataFrame([("S1-1",), ("S1-2",)], "record_id string")
    scored = spark.createDataFrame([("S1-1", "S3-1", 0.5), ("S1-1", "S2-1", 0.9), ("S1-2", "S2-1", 0.1)], "id_1 string, id_2 string, score double")
    out = D.assemble_matches(scored, 0.5, anchors)
    assert rows(out) == {("S1-1", "S2-1,S3-1"), ("S1-2", "")}
    assert rows(D.singletons(anchors, scored.where("score >= 0.5"), "id_1")) == {("S1-2",)}
    assert V.findings(out, V.RESULT, ["matched_entity_ids"]).first().valid
    assert not V.findings(scored, V.RESULT).first().valid
    records = spark.createDataFrame([("S1-1", "a", "us"), ("S2-1", "b", "de")], "record_id string, name string, country string")
    truth = spark.createDataFrame([("S2-1", "S1-1")], "a string, b string")
    assert rows(E.false_merges(scored, truth, records)) == {("S1-1", "S3-1", "a", "us", None, None), ("S1-2", "S2-1", None, None, "b", "de")}
    E.error_reports(scored, truth, records, str(tmp_path))
    assert (tmp_path / "false_merges.csv").exists() and not (tmp_path / "missed_matches.csv").exists()


def test_validate_file(spark, tmp_path):
    p = tmp_path / "m.tsv"
    assert not V.validate_file(spark, str(p))
    p.write_text("id_1\tid_2\tscore\n1\t2\t0.9\n")
    assert V.validate_file(spark, str(p), V.SCORED)
    p.write_text("id_1\tscore\n1\t0.9\n")
    assert not V.validate_file(spark, str(p), V.SCORED)
    p.write_text("id_1\tid_2\tscore\n1\t2\t\n")
    assert not V.validate_file(spark, str(p), V.SCORED)


def test_holdout_and_sample(spark):
    df = spark.range(310).select(F.concat(F.lit("a"), "id").alias("id_1"), F.lit("b").alias("id_2"), (F.col("id") < 31).cast("int").alias("label"))
    got = {(r.label, r.held_out): r["count"] for r in E.holdout(df).groupBy("label", "held_out").count().collect()}
    assert got == {(1, True): 7, (1, False): 24, (0, True): 56, (0, False): 223}
    assert rows(E.holdout(df)) == rows(E.holdout(df.repartition(7)))
    with pytest.raises(ValueError, match="label"):
        E.holdout(df.drop("label"))
    anchors = df.select(F.col("id_1").alias("record_id"))
    known = anchors.limit(10).select(F.col("record_id").alias("anchor"))
    few = E.capped_anchors(anchors, known, 20)
    assert few.count() == 20 and few.join(known, F.col("record_id") == F.col("anchor")).count() == 10
    assert E.capped_anchors(anchors, known, 5).join(known, F.col("record_id") == F.col("anchor")).count() == 5
    with pytest.raises(ValueError, match="repeat"):
        R.unique_ids(anchors.unionAll(anchors))


def make_split(folder, split, n):
    r = random.Random(n)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "zeta"]
    (folder / split).mkdir(parents=True)
    lines = {k: ["entity_id\tbusiness_name\tbusiness_address\tcountry"] for k in (1, 2, 3)}
    truth = ["id\tmatches"]
    for i in range(n):
        name, address = f"{r.choice(words)} {r.choice(words)} u{i}", f"{i} {r.choice(words)} Street"
        lines[1].append(f"S1-{i}\t{name} Inc\t{address}\tUSA")
        if i % 3:
            lines[2].append(f"S2-{i}\t{name}\t{address.replace('Street', 'St')}\tUnited States")
        lines[3].append(f"S3-{i}\t{r.choice(words)} u{i} other\t{r.choice(words)} road\tFrance")
        truth.append(f"S1-{i}\t{f'S2-{i}' if i % 3 else ''}")
    for k, x in lines.items():
        (folder / split / f"{split}_source{k}.tsv").write_text("\n".join(x) + "\n")
    (folder / split / f"{split}_ground_truth.tsv").write_text("\n".join(truth) + "\n")


def test_end_to_end(spark, tmp_path, monkeypatch):
    s = Settings(str(tmp_path / "data"), str(tmp_path / "out"), str(tmp_path / "model"))
    assert linkage.train(spark, s) is None and linkage.infer(spark, s) is False and not (tmp_path / "out").exists()
    monkeypatch.setitem(linkage.model.DEFAULTS, "maxIter", 3)
    make_split(tmp_path / "data", "train", 40)
    make_split(tmp_path / "data", "test", 30)
    threshold = linkage.train(spark, s)
    assert 0 < threshold < 1
    audit = json.loads((tmp_path / "model" / "metadata.json").read_text())
    assert audit["features"] == X.FEATURES and len(audit["feature_importance"]) == 10
    assert linkage.infer(spark, s)
    assert V.validate_file(spark, f"{s.output_dir}/matching_results.tsv")
    out = spark.read.csv(f"{s.output_dir}/matching_results.tsv", sep="\t", header=True)
    assert out.count() == 30
    assert linkage.assess(spark, s).first().recall > 0.9
    cand = E.explode_matches(spark.read.csv(f"{s.output_dir}/candidate_pairs.tsv", sep="\t", header=True), "source1_entity_id", "candidate_entity_ids")
    assert E.explode_matches(out, "source1_entity_id", "matched_entity_ids").join(cand, ["id_1", "id_2"], "left_anti").count() == 0


def test_stream_of_anchors(spark, tmp_path):
    from lakeloom.streaming.anchors import anchor_stream, link

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\nS1-1\tAcme Tools Inc\t1 Main Street\nS1-2\tNone\t\n")
    targets = spark.createDataFrame([("S2-1", "acme tools", "1 main st")], "record_id string, name string, address string")
    got = {}
    link(anchor_stream(spark, str(tmp_path / "in"), "entity_id string, business_name string, business_address string"), targets, 0.5, lambda df, i: got.update({i: rows(df)}), str(tmp_path / "ck")).awaitTermination(120)
    assert got == {0: {("S1-1", "S2-1"), ("S1-2", "")}}


def test_settings_and_zip(tmp_path):
    a, b = tmp_path / "a.json", tmp_path / "b.yaml"
    a.write_text('{"random_seed": 1, "other": 2}')
    b.write_text("random_seed: 7\noutput_dir: there\n")
    s = load(str(a), str(b))
    assert (s.random_seed, s.output_dir, s.beta) == (7, "there", 0.5)
    with pytest.raises(FileNotFoundError):
        load(str(tmp_path / "none.json"))
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "x").write_text("x")
    assert build_zip(str(tmp_path), str(tmp_path / "z.zip"), {"output/a": str(a), "output/c": "none"}) == ["output/c"]
    assert sorted(zipfile.ZipFile(tmp_path / "z.zip").namelist()) == ["code/a.json", "code/b.yaml", "output/a"]


def test_settings_folder(tmp_path):
    (tmp_path / "default.yaml").write_text("random_seed: 5\n")
    (tmp_path / "model.json").write_text('{"maxIter": 9}')
    m = Manager(str(tmp_path))
    assert m.get("random_seed") == 5 and m.get("model") == {"maxIter": 9} and m.get("blocking") is None and m.get("x", 1) == 1
    assert Manager(str(tmp_path / "none")).values == {}
    assert resolved(str(tmp_path), "a/b") == str(tmp_path / "a" / "b") and resolved("x", "/a") == "/a" and resolved("x", "s3://a/b") == "s3://a/b"


def test_documents_in_the_zip(tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "Documentation_template.md").write_text("how")
    assert build_zip(str(tmp_path), str(tmp_path / "z.zip"), {}, documents=[*DOCUMENTS, "docs/none.md"]) == ["none.md"]
    assert "Documentation_template.md" in zipfile.ZipFile(tmp_path / "z.zip").namelist()


def test_line_breaks_decide_how_a_file_is_split(spark, tmp_path):
    plain, broken = tmp_path / "a.tsv", tmp_path / "b.tsv"
    plain.write_text('entity_id\tbusiness_name\nS1-1\t"Quoted ""X"""\nS1-2\ty\n')
    broken.write_text('entity_id\tbusiness_name\nS1-1\t"two\nlines"\nS1-2\ty\n')
    assert not tsv.holds_breaks(spark, str(plain)) and tsv.holds_breaks(spark, str(broken))
    assert rows(tsv.read_source(spark, str(plain))) == {("S1-1", 'Quoted "X"'), ("S1-2", "y")}
    assert rows(tsv.read_source(spark, str(broken))) == {("S1-1", "two\nlines"), ("S1-2", "y")}


def test_name_groups_and_limits(spark):
    df = spark.createDataFrame([("S1-1", "a"), ("S1-2", "a "), ("S2-1", "a"), ("S3-1", "a"), ("S1-3", "b"), ("S2-2", "c"), ("S1-4", ""), ("S2-3", "")], "record_id string, name string")
    a, t = linkage.sides(df)
    assert rows(B.exact_name_groups(a, t)) == {("S1-1", True, "S1-1"), ("S1-2", True, "S1-1"), ("S2-1", False, "S1-1"), ("S3-1", False, "S1-1")}
    assert len(rows(B.exact_name(a, t))) == len(rows(B.exact_name(a, t, max_name_freq=2))) == 4 and rows(B.exact_name(a, t, max_name_freq=1)) == set()


def test_resume(spark, tmp_path):
    """A run that goes on gives what a whole run gives; repeated ids are an error."""
    s = Settings(str(tmp_path / "data"), str(tmp_path / "out"), str(tmp_path / "model"))
    make_split(tmp_path / "data", "train", 20)
    make_split(tmp_path / "data", "test", 12)
    linkage.model.DEFAULTS["maxIter"], had = 2, linkage.model.DEFAULTS["maxIter"]
    try:
        linkage.train(spark, s)
    finally:
        linkage.model.DEFAULTS["maxIter"] = had
    linkage.infer(spark, s)
    path = f"{s.output_dir}/matching_results.tsv"
    whole = rows(tsv.read_source(spark, path))
    tsv.write_tsv(spark.createDataFrame(sorted(whole)[:5], "source1_entity_id string, matched_entity_ids string"), path)
    linkage.infer(spark, s, resume=True)
    assert rows(tsv.read_source(spark, path)) == whole and tsv.read_source(spark, path).count() == 12
    with open(tmp_path / "data" / "test" / "test_source3.tsv", "a") as f:
        f.write("S3-1\tagain\tx\tFrance\n")
    with pytest.raises(ValueError, match="repeat"):
        linkage.infer(spark, s)
