import json
import re
from pathlib import Path

import pytest
from pyspark.sql import types as T

from carebundle.schema import (
    TARGET_TABLES,
    from_avro_json,
    primary_key,
    read_avro_schemas,
    target_schema,
    target_schemas,
    to_avro_json,
)
from carebundle.sources.literal import empty_table, empty_target

LETTERS = {"L": "bigint", "S": "string", "F": "double", "B": "boolean", "T": "timestamp", "D": "date"}


def _documented():
    text = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text()
    tables = {}
    for name, note, columns in re.findall(r"^\| `(\w+)`(.*?)\| \d+ \| ([^|]*:[LSFBTD][^|]*) \|", text, re.M):
        if "not in the bundle" not in note:
            tables[name] = [(c.split(":")[0], LETTERS[c.split(":")[1]]) for c in columns.split()]
    return tables


def test_schemas_are_the_documented_ones():
    documented = _documented()
    assert set(documented) == set(TARGET_TABLES) and len(TARGET_TABLES) == 17
    for table, columns in documented.items():
        fields = target_schema(table).fields
        assert [(f.name, f.dataType.simpleString()) for f in fields] == columns, table
        assert all(f.nullable for f in fields) and primary_key(table) in dict(columns)


def test_unknown_table():
    with pytest.raises(KeyError, match="weather"):
        target_schema("weather")


def test_avro_round_trip():
    for schema in target_schemas().values():
        assert from_avro_json(to_avro_json(schema)) == schema
    nested = T.StructType.fromDDL(
        "a int, b array<string>, c map<string,double>, d decimal(10,2), e struct<f:timestamp_ntz,g:binary>, h float"
    ).add("i", "string", False)
    assert from_avro_json(to_avro_json(nested)) == nested


def test_avro_null_first_and_millis():
    text = json.dumps(
        {"type": "record", "name": "r", "fields": [
            {"name": "t", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}]},
            {"name": "n", "type": "long"}]}
    )
    assert from_avro_json(text) == T.StructType().add("t", "timestamp").add("n", "long", False)


UNION = '{"type": "record", "name": "r", "fields": [{"name": "x", "type": ["int", "string"]}]}'


@pytest.mark.parametrize("avro", ['"long"', UNION])
def test_avro_that_is_no_table(avro):
    with pytest.raises(TypeError):
        from_avro_json(avro)


def test_schemas_from_files(spark, tmp_path):
    (tmp_path / "person.avro").write_text(to_avro_json(T.StructType().add("b", "long").add("a", "date")))
    assert read_avro_schemas(spark, str(tmp_path), ["person"])["person"].names == ["b", "a"]


def test_empty_tables(spark):
    bundle = empty_target(spark).as_target()
    assert bundle.validate().valid
    assert empty_table(spark, "role").count() == 0
    plan = empty_table(spark, "role")._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan <empty>" in plan
