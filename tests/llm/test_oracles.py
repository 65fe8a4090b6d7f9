import os

import duckdb
import pytest

from tidemark.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    want = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    got = registry.QUERIES[name](spark, SF).select(*names)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_one_query_an_operator():
    assert [int(n[2:].split("_")[0]) for n in registry.QUERIES] == list(range(1, 11))
