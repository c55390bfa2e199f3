"""Every registered query against its check SQL in DuckDB, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")

QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.12g}"
    return str(value)


def test_every_query_has_an_oracle():
    """But for text operators, which have brute-force tests of their own where SQL cannot state them."""
    assert set(ORACLES) <= set(QUERIES)
    assert all(name == "pipeline" or name.startswith("op") for name in set(QUERIES) - set(ORACLES))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(comparable(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    expected = sorted(tuple(comparable(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert columns == sorted(names)
    assert got == expected


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 21
