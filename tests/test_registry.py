"""Every registered query against its DuckDB SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


# The training-data operators have tests of their own in tests/llm.
OWN = sorted(set(registry.queries()) - set(registry.llm.QUERIES if registry.llm else ()) - {"pipeline"})


def test_every_query_has_its_sql():
    assert set(OWN) <= set(ORACLES) <= set(registry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF_DIR).toPandas()
    want = duck.execute(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (
        frame[columns].sort_values(columns).reset_index(drop=True) for frame in (got, want)
    )
    assert got.equals(want.astype(got.dtypes.to_dict()))


def test_entry(spark):
    out = registry.entry(spark)
    assert out.columns == ["doc_id", "term", "score"]
    assert not out.isEmpty()
