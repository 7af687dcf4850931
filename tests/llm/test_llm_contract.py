"""The queries that SQL can express, against it."""

from pathlib import Path

import duckdb
import pytest

from rankdex.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    result = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert rows and sorted(rows, key=repr) == sorted(expected, key=repr)
