"""Driver contract: entry() runs, every query has a SQL twin, and all of them match DuckDB on sf0.001."""
import duckdb
import pytest

import __spark_entry__ as E
from transitlake.plans import catalog
from tools.check_oracle import TABLES, rows_of


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["line_number", "transport_type", "fuel_type", "operator", "snapshot_date",
                          "hour", "vehicle_count"]


def test_every_query_has_oracle():
    assert not set(catalog.registry()) - set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.registry()))
def test_matches_duckdb(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = E.queries()[name](spark, sf_dir)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(res.fetchall(), ocols)
