import duckdb
import pytest
from pathlib import Path

import __spark_entry__ as entry
from check import rows_of


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "customerID" and df.count() == 963


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    rel = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, rel.fetchall())


@pytest.mark.parametrize("name", ["cox_hazard_ratios", "cox_horizon", "cox_concordance"])
def test_fitted_queries_run(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0
