"""Every registered query against its SQL statement on DuckDB (small scale)."""

import pytest

import __spark_entry__ as E
from tessera.compare import compare, duck
from tessera.plans import catalog, oracle
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)
    assert catalog.QUERIES.items() <= E.queries().items()
    assert oracle.SQL.items() <= E.oracle_sql().items()


@pytest.fixture
def arrow(spark, request):
    """Spark's default is off; queries may not depend on it."""
    name = "spark.sql.execution.arrow.pyspark.enabled"
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.unset(name)


@pytest.mark.parametrize("arrow", ["false", "true"], indirect=True)
@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_sql(spark, con, name, arrow):
    res = compare(E.queries()[name](spark, SF_SMALL), con, E.oracle_sql()[name])
    assert res["columns_match"], res["columns"]
    assert res["rows_spark"] == res["rows_sql"]
    assert res["values_match"], (res["spark_only"], res["sql_only"])


@pytest.mark.parametrize("arrow", ["false", "true"], indirect=True)
def test_entry_smoke(spark, arrow):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "center", "cost"] and len(rows) == 4
