"""Every query against its SQL, over whole tables: names, types and values."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from catalog.oracles import ORACLES
from catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _sorted_rows(records):
    return sorted((tuple(_plain(v) for v in record) for record in records), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    result = duck.execute(entry_module.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    duck_types = {column[0]: str(column[1]) for column in result.description}
    expected = _sorted_rows(result.fetchall())
    actual = _sorted_rows(df.select(*[f"`{n}`" for n in names]).collect())
    assert len(actual) == len(expected)
    assert actual == expected
    assert actual, "the query should return rows"
    spark_types = {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in df.schema}
    assert spark_types == duck_types


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
