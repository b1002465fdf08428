"""Every query against its SQL."""

import pytest

import __spark_entry__
from quire.plans import GROUPS
from tests.compare import SF, connection, same

QUERIES = {k: (f, g.sql.get(k)) for g in GROUPS for k, f in g.queries.items()}


@pytest.fixture(scope="module")
def con():
    return connection()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_is_its_sql(spark, con, name):
    query, sql = QUERIES[name]
    if sql is None:
        assert query(spark, SF).count() > 0
    else:
        same(query(spark, SF), con, sql)


def test_entry_and_registry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_short_items_are_found_too(spark, tmp_path):
    import duckdb

    items = ["fox", "quick brown", "brown fox jumps", "the quick brown fo", "the quick brown fox jum", "a quick brown fox jumps"]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, "see the quick brown fox jumps"), (2, "foxes"), (3, "fox"), (4, "quick  brown")], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for name in ("benchmark", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    query, sql = QUERIES["provenance_check"]
    same(query(spark, str(tmp_path)), con, sql)
