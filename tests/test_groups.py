import pyarrow as pa
from pyspark.sql import functions as F

from lakeloom.functions import normalize as N
from lakeloom.operators import blocking as B
from lakeloom.operators import decision as D
from lakeloom.operators import evaluate as E
from lakeloom.operators import groups as G
from lakeloom.plans.linkage import sides

COLUMNS = "record_id string, name string, address string, country string, text_id string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def sample(spark, copies=300):
    same = [(f"S{k % 2 + 1}-{k}", "acme tools", "main st", "en", f"t{k % 3}") for k in range(2 * copies)]
    odd = [("S1-a", "rare word", "", None, None), ("S2-b", "other word", "", "de", None), ("S3-c", "", "", "", "x"), ("S1-d", "", "", "", "x"), ("S1-e", "one", "elm way", "en", "y"), ("S3-f", "two", "elm way", "en", "z"), (None, "acme tools", "", "", "t0")]
    return spark.createDataFrame(same + odd, COLUMNS)


def test_copies_are_a_pair_of_groups(spark):
    records = sample(spark)
    g = G.grouped(records)
    pairs = G.retrieve(g)
    assert pairs.count() == 3  # of copies one, not 90,000
    expected = B.retrieve(*sides(records.select("record_id", "name", "address")))
    assert expected.count() > 90_000 and rows(g.expanded(pairs)) == rows(expected)
    assert max(g.chunks.select(F.size("members").alias("n")).toPandas().n) < 300
    lists = {r[0]: r[1] for r in g.lists(pairs, "x").collect()}
    assert lists == {r[0]: r[1] for r in D.lists(expected, sides(records)[0], "x").collect()}


def test_labels_and_counts_are_those_of_pairs(spark):
    records = sample(spark, 20)
    again = [("S1-r", "acme tools", "main st", "en", "t1"), ("S1-r", "one", "oak st", "en", "y2"), ("S2-r", "acme tools", "", "", "t1"), ("S2-r", "one", "oak st", "", "y2")]
    for records in (records, records.unionAll(spark.createDataFrame(again, COLUMNS))):
        g = G.grouped(records)
        pairs = G.retrieve(g)
        a, t = sides(records)
        truth = a.select(F.col("record_id").alias("id_1"), "text_id").join(t.select(F.col("record_id").alias("id_2"), "text_id"), "text_id").select("id_1", "id_2").distinct()
        every = E.label_pairs(B.retrieve(a, t), truth).select("id_1", "id_2", "label")
        assert rows(g.expanded(pairs, label=True)) == rows(every)
        counted = {r[0]: r[1] for r in g.counted(pairs).groupBy("label").agg(F.sum("n")).collect()}
        assert counted == {r[0]: r[1] for r in every.groupBy("label").count().collect()}
        assert rows(G.match_metrics(g, pairs)) == rows(E.match_metrics(every, truth))
        n = records.agg(F.count("*").alias("n"))
        assert rows(G.blocking_metrics(g, pairs, n)) == rows(E.blocking_metrics(every, truth, n))


def test_a_weight_is_a_number_of_rows(spark):
    weighted = spark.createDataFrame([(0.3, 1, 3), (0.3, 0, 2), (0.9, 1, 1)], "score double, label int, n long")
    each = weighted.withColumn("x", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("x")
    assert rows(D.sweep(weighted, weight="n")) == rows(D.sweep(each)) and D.best_threshold(weighted, weight="n") == D.best_threshold(each)
    said = lambda df: df.withColumn("predicted", (F.col("score") > 0.5).cast("int"))
    assert rows(D.f_beta_score(said(weighted), weight="n")) == rows(D.f_beta_score(said(each)))


def test_ends_are_those_of_the_whole_text():
    texts = [None, "", " - ", "one", "a b c d e f g", "x" * 300, "é" * 600 + " a", "!" * 400 + " one two" + "?" * 400, "word " * 500, "Ａ1 ﬁ İ Σ é " * 90, ("w" * 50 + " ") * 9, "a b c d e f " + "." * 500, "." * 500 + "a b c d e f g h"]
    for text, got in zip(texts, N.ends_array(pa.array(texts, pa.string())).to_pylist(), strict=True):
        words = N.WORD.findall(N.fold_array(pa.array([text], pa.string()))[0].as_py())
        assert got == f"{' '.join(words[:6])}\n{' '.join(words[-6:])}"
