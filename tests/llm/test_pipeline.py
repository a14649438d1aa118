"""The corpus pipeline, stage by stage, against brute force."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from lakeloom.llm import queries
from tests_llm_helpers import brute_components, brute_leaks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, f in C.STAGES:
        docs = f(spark, docs, SF)
        rows = docs.collect()
        out.append(rows)
        docs = spark.createDataFrame(rows, docs.schema)
    return out


def test_columns_and_decisions(spark, stages):
    names = spark.read.parquet(f"{SF}/documents.parquet").columns
    for before, after in zip(stages[:-2], stages[1:-1], strict=True):
        assert list(after[0].asDict()) == names and {r.doc_id for r in after} <= {r.doc_id for r in before}
    assert [r.doc_id for r in stages[4]] == [r.doc_id for r in stages[3]]


def test_toxic_documents_go(spark, stages):
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    kept = {r.doc_id for r in stages[1]}
    assert len(toxic & kept) <= 0.15 * len(toxic) and len(clean - kept) <= 0.05 * len(clean)


def test_one_of_each_group(stages):
    want = brute_components([(r.doc_id, r.text) for r in stages[1]], 5, 80, 100)
    assert {r.doc_id for r in stages[2]} == {i for i, (_, c) in want.items() if i == c}


def test_benchmark_passages_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = brute_leaks([(r.doc_id, r.text) for r in stages[2]], items)
    assert {r.doc_id for r in stages[3]} == {r.doc_id for r in stages[2]} - {d for d, _ in leaks}


def test_run_is_all_stages(spark, stages):
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(map(tuple, stages[-1]))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_covers_its_table(spark, name):
    df = queries.QUERIES[name](spark, SF)
    if name == "op1_html_extract":
        assert df.select("page_id").distinct().count() == spark.read.parquet(f"{SF}/pages.parquet").count()
    elif name != "op3_decontaminate":
        assert df.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_stages_of_nulls(spark):
    """Null ids and texts pass every filter; nothing crashes on them."""
    labelled = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0"), "doc_id")
    clean = labelled.orderBy("doc_id").first().text
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame([(None, None, None, None, None), (None, clean, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0)], schema)
    for _, f in C.STAGES[:-1]:
        docs = f(spark, docs, SF)
    assert docs.count() == 4 and C.STAGES[-1][1](spark, docs, SF).count() == 4
    assert C.one_of_each_group(spark, docs.limit(0), SF).count() == 0
    assert docs.where(F.col("doc_id").isNull()).count() == 2


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in ("ash", "birch", "cedar"))
    rows = [(3, one), (3, two), (3, two), (3, one + " more"), (5, two), (7, three), (8, three), (8, "elm oak"), (None, one), (None, "yew fir"), (None, "yew fir"), (9, ""), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], schema)
    got = [(r.doc_id, r.text) for r in C.one_of_each_group(spark, docs, SF).collect()]
    short = sorted(((i, t) for i, t in got if t not in (one, one + " more")), key=str)
    assert short == sorted([(3, two), (7, three), (8, "elm oak"), (None, "yew fir"), (9, "")], key=str)
    assert [i for i, t in got if t in (one, one + " more")] == [3]


def test_benchmark_passages_go_whatever_their_ids(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first().text
    rows = [(None, f"before {passage} after"), (None, "clean words only in this row"), (4, passage), (4, "another clean text of that id"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], schema)
    got = {(r.doc_id, r.text) for r in C.without_benchmark(spark, docs, SF).collect()}
    assert got == {rows[1], rows[3], rows[4]}
