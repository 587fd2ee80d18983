"""The registered queries over a folder of the benchmark tables."""

import duckdb
import pytest

from trendspark.llm import queries as Q

SF_SMALL = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in Q.QUERIES} and set(Q.QUERIES) | {"pipeline"} <= names


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracle(spark, name):
    with duckdb.connect() as c:
        for t in ("pages", "documents", "benchmark"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        names = [x[0] for x in c.execute(Q.ORACLES[name]).description]
        expected = c.execute(Q.ORACLES[name]).fetchall()
    got = Q.QUERIES[name](spark, SF_SMALL).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
