import duckdb
import pytest

from lakeloom import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def values(df):
    cols = sorted(df.columns)
    return cols, sorted(map(tuple, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()), key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    assert values(registry.QUERIES[name](spark, SF).toPandas()) == values(con.execute(registry.ORACLE_SQL[name]).df())


def test_scores_are_probabilities(spark):
    assert registry.baseline_score(spark, SF).where("score < 0 or score > 1 or score is null").isEmpty()


def test_entry(spark):
    import __spark_entry__ as e

    assert set(registry.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
