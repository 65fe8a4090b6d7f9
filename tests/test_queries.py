"""Every query with oracle SQL against DuckDB on the smallest tables, and the driver's entry."""

import datetime
import os

import duckdb
import pytest

from tidemark import queries as Q

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, datetime.datetime) and not (v.hour or v.minute or v.second or v.microsecond):
        return v.date().isoformat()
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_equals_its_oracle(spark, duck, name):
    got = Q.QUERIES[name](spark, SF)
    want = duck.execute(Q.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


def test_the_chunked_query_sees_a_wrong_slice(spark, monkeypatch):
    right = Q.B.slice_of
    monkeypatch.setattr(Q.B, "slice_of", lambda *a, **k: right(*a, **k) & Q.F.lit(False))
    assert sum(Q.QUERIES["chunked_equals_single"](spark, SF).first()) > 0


def test_every_query_has_an_oracle():
    assert set(Q.QUERIES) == set(Q.ORACLE)


def test_entry_gives_a_row_that_holds(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).first()["ok"]


def test_scans_push_the_cut_off_and_read_few_columns(spark):
    plan = Q.QUERIES["share_count"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(ts" in plan and "ReadSchema: struct<ts:timestamp_ntz>" in plan
