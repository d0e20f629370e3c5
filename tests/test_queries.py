"""Every registered query against its SQL on the smallest data set."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from sparkscan.plans import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def comparable(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = Counter(tuple(comparable(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(names) == columns
    for field in df.schema.fields:
        assert SQL_TYPES[field.dataType.simpleString()] == types[field.name], field.name
    order = [names.index(c) for c in columns]
    want = Counter(tuple(comparable(row[i]) for i in order) for row in result.fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    found = entry_points.entry(spark)
    assert found.columns == ["pattern_id", "hits", "docs"] and found.count() == 20
