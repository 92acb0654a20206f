"""All registered queries against their SQL, on the smallest data set."""

import sys
from pathlib import Path

import duckdb
import pytest

from tests.conftest import SMALL

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402
from carebundle.checks.oracles import oracles  # noqa: E402
from carebundle.checks.queries import QUERIES  # noqa: E402

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in sorted(Path(SMALL).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracles())
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 1500


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    cursor = duck.execute(oracles()[name])
    names = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    assert sorted(result.columns) == sorted(names)
    assert {column: TYPES[kind] for column, kind in result.dtypes} == types
    expected = sorted(repr(row) for row in cursor.fetchall())
    assert sorted(repr(tuple(row)) for row in result.select(*names).collect()) == expected
    assert expected or name in ("orphan_keys", "key_collisions")
