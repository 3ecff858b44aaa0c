"""Every registered query against its SQL twin, on the given tables."""

import duckdb
import pytest
from conftest import TABLES, TESTDATA

from lanewise import plans

QUERIES, ORACLES = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def twins():
    made = {}
    for scale in ("0.001", "0.01"):
        made[scale] = duckdb.connect()
        for name in TABLES:
            path = f"{TESTDATA}/sf{scale}/{name}.parquet"
            made[scale].execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return made


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


# The smallest tables give graphs with vertices that have no way out, and empty results.
CASES = [(name, "0.01") for name in sorted(QUERIES)]
CASES += [(name, "0.001") for name in sorted(QUERIES) if name.startswith("graph_")]


@pytest.mark.parametrize("name,scale", CASES)
def test_query(spark, twins, name, scale):
    df = QUERIES[name](spark, f"{TESTDATA}/sf{scale}")
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(row)) for row in df.select(*columns).collect())
    if name not in ORACLES:
        assert columns and rows
        return
    result = twins[scale].execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted(repr(tuple(row[i] for i in order)) for row in result.fetchall())


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["dst", "count"] and df.count() == 3
