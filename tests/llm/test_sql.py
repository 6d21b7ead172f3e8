"""The training-data queries that have an SQL form, against DuckDB over all rows of sf0.001."""
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_va_search", "op10_line_dedup", "op11_exact_dedup"])
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = queries()[name](spark, SF)
    types = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}
    assert [(c, types[t]) for c, t in sdf.dtypes] == [r[:2] for r in con.execute(f"DESCRIBE ({oracle_sql()[name]})").fetchall()]
    want = Counter(con.execute(oracle_sql()[name]).fetchall())
    assert want and Counter(map(tuple, sdf.collect())) == want
