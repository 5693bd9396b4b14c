import duckdb
import pytest

from tools.check_oracle import rows_of
from transitlake.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.queries()[name](spark, sf_dir)
    want = con.execute(oracle.SQL[name])
    cols = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(want.fetchall(), cols)
