"""Every registered query that has SQL gives the same rows as DuckDB at the smallest size."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = Path("/root/testdata/sf0.001")


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v if v is None or isinstance(v, (int, str)) else str(v)

    return sorted(repr([cell(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in FOLDER.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, name):
    got = entry.queries()[name](spark, str(FOLDER))
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), want.columns)


def test_two_and_three_more_bytes(spark, tmp_path):
    """Event ids of a table 60 times as large as sf0.1, where numbers take six and seven bytes."""
    name = "q56_twos_complement"
    ids = [None, 0, 1, 2, 121_893, 121_895, 121_897, 1_950_322, 1_950_323, 5_999_998, 5_999_999]
    spark.createDataFrame([(i,) for i in ids], "event_id bigint").write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    got = entry.queries()[name](spark, str(tmp_path))
    want = con.sql(entry.oracle_sql()[name])
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), want.columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
