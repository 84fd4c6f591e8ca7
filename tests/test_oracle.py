"""Every registered query against its DuckDB SQL twin (sf0.001, the smoke
scale; ``python -m tests.oracle_compare`` runs the same check at sf0.01)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF001
from tests.oracle_compare import compare, duck

# the corpus queries have tests of their own
REGISTRY = entry._registry()
QUERIES, SQL = REGISTRY.QUERIES, REGISTRY.ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_sql_or_is_iterative():
    assert set(QUERIES) - set(SQL) == {"comment_kmeans"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], SQL[name], SF001)
    assert res["match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "value_click" in df.columns


def test_kmeans_rows(spark):
    out = QUERIES["comment_kmeans"](spark, SF001)
    docs = spark.read.parquet(f"{SF001}/conversations.parquet").filter("text IS NOT NULL").count()
    assert out.count() == docs
    assert {r["cluster"] for r in out.select("cluster").distinct().collect()} <= {0, 1}
