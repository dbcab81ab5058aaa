from pathlib import Path

import duckdb

import __spark_entry__ as se

from ..conftest import SF0001


def test_every_oracle_is_sql_that_duckdb_runs():
    con = duckdb.connect()
    for t in Path(SF0001).glob("*.parquet"):
        con.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM read_parquet('{t}')")
    for name, sql in se.oracle_sql().items():
        assert isinstance(sql, str), name
        con.execute(sql).fetchone()
