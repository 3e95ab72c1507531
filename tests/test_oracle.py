"""Every query against the same question in SQL, on the smallest tables."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

ORACLE = entry_module.oracle_sql()
QUERIES = entry_module.queries()
# Many small files; the operators behind them have tests of their own.
SLOW = {
    "ml_logistic_cv", "ml_training", "stream_lake", "stream_stop", "lake_merged", "raw_load", "raw_contract", "stream_scores",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else round(value, 9)
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_matches_sql(spark, duck, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    assert sorted(ours.columns) == sorted(columns)
    assert _rows(ours.columns, ours.collect()) == _rows(columns, theirs)
