"""Every query with an SQL twin gives the same rows in DuckDB."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from firmlens.plans import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), v) for v in row])


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    query = QUERIES[name]
    df = query.run(spark, sf_dir)
    columns = sorted(df.columns)
    ours = ordered([[plain(v) for v in row] for row in df.select(*(f"`{c}`" for c in columns)).collect()])
    result = duck.execute(query.sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = ordered([[plain(row[i]) for i in at] for row in result.fetchall()])
    assert ours == theirs
