import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.operators.columns import add_missing_columns, concept_stem, expand_concept_columns, with_hash
from carebundle.operators.copies import number_copies
from carebundle.operators.validate import validate_frame
from carebundle.schema import target_schema
from carebundle.sources.literal import empty_target


@pytest.fixture
def bundle(frame):
    return Bundle({"a": frame([(1, "x"), (2, "y")], "id bigint, v string"), "b": frame([(3,)], "id bigint")})


def test_lookup_and_replace(bundle, frame):
    assert bundle["a"].count() == 2 and list(bundle) == ["a", "b"] and len(bundle) == 2
    with pytest.raises(KeyError, match="no table 'c'"):
        bundle["c"]
    replaced = bundle.replace(b=frame([(4,), (5,)], "id bigint"))
    assert replaced["b"].count() == 2 and bundle["b"].count() == 1
    with pytest.raises(KeyError, match="c"):
        bundle.replace(c=bundle["a"])
    with pytest.raises(TypeError):
        bundle.frames["a"] = None


def test_require(bundle, source):
    assert bundle.require(["b", "a"]) is bundle
    with pytest.raises(ValueError, match="patients"):
        bundle.as_source()
    assert source.as_source() is source


def test_coalesce(bundle):
    spread = Bundle({name: frame.repartition(6) for name, frame in bundle.items()})
    assert [f.rdd.getNumPartitions() for f in spread.coalesce(2).values()] == [2, 2]
    assert [f.rdd.getNumPartitions() for f in spread.coalesce({"b": 1, "a": 3}).values()] == [3, 1]
    with pytest.raises(ValueError, match="b"):
        spread.coalesce({"a": 1})


def test_collect_and_counts(bundle):
    assert [row.id for row in bundle.collect()["a"]] == [1, 2]
    assert {row.table_name: row.n for row in bundle.counts().collect()} == {"a": 2, "b": 1}


def test_collect_names_the_table_and_keeps_the_cause(bundle):
    broken = bundle.replace(b=bundle["b"].select(F.raise_error(F.lit("no disk"))))
    with pytest.raises(RuntimeError, match="cannot collect table b") as caught:
        broken.collect()
    assert "no disk" in str(caught.value.__cause__)


def test_cache(bundle):
    cached = bundle.cache()
    assert cached["a"].storageLevel.useMemory
    cached.unpersist()
    assert not cached["a"].storageLevel.useMemory


def test_add_missing_columns(frame):
    table = frame([("x", 1)], "extra string, person_id int")
    result = add_missing_columns(table, target_schema("person"))
    expected = [name for name in target_schema("person").names if name != "person_id"]
    assert result.columns == ["extra", "person_id", *expected]
    assert result.schema["person_id"].dataType == T.IntegerType()
    assert all(result.schema[n].dataType == target_schema("person")[n].dataType for n in expected)
    assert set(result.first()[2:]) == {None}


def test_add_missing_columns_refuses_required_ones(frame):
    with pytest.raises(ValueError, match="may not be null: must"):
        add_missing_columns(frame([(1,)], "a int"), T.StructType().add("must", "integer", False))


def test_schemas_must_fit_the_tables(bundle):
    for call in (bundle.validate, bundle.add_missing_columns):
        with pytest.raises(ValueError, match="b"):
            call({"a": bundle["a"].schema})


def test_validation_errors_in_order(frame):
    table = frame([(1, "x", 2, 3)], "a int, B string, odd int, c int")
    schema = T.StructType().add("a", "long").add("b", "string").add("c", "integer").add("d", "date")
    assert validate_frame(table, schema).errors == (
        "lacks the columns b, d",
        "the schema does not know the columns B, odd",
        'column a is "integer" where the schema wants "long"',
    )
    assert validate_frame(table, schema, allow_missing_fields=True).errors[0].startswith("the schema")


def test_nullability_is_not_compared(spark):
    assert validate_frame(spark.range(1), T.StructType().add("id", "long", True)).valid


def test_bundle_validation(bundle):
    schemas = {name: frame.schema for name, frame in bundle.items()}
    assert bundle.validate(schemas).valid and bundle.checkpoint(schemas) is bundle
    schemas["b"] = T.StructType().add("id", "integer")
    result = bundle.validate(schemas)
    assert result.errors == ('table b: column id is "long" where the schema wants "integer"',)
    with pytest.raises(ValueError, match="do not fit their schemas:\ntable b: "):
        bundle.checkpoint(schemas)


def test_with_hash(spark, bundle):
    hashed = empty_target(spark).with_hash()
    assert hashed.validate().valid
    assert [row.hash for row in bundle.with_hash()["a"].collect()] == [123, 123]
    content = bundle["a"].union(bundle["a"]).transform(lambda f: with_hash(f, content=True))
    again = with_hash(content, content=True)
    assert content.select("hash").distinct().count() == 2
    assert sorted(r.hash for r in again.collect()) == sorted(r.hash for r in content.collect())
    assert content.schema["hash"].dataType == T.LongType()


def test_concept_stem():
    assert concept_stem("foo_concept_id") == "foo"
    assert concept_stem("foo_type_source_concept_id") == "foo"
    assert concept_stem("foo_source_value") == "foo"
    assert concept_stem("foo_id") is None and concept_stem("name") is None and concept_stem("concept_id") is None


def test_expand_concept_columns(frame):
    table = frame([(1, 2, "x")], "foo_id bigint, foo_concept_id bigint, foo_type_source_value string")
    result = expand_concept_columns(table)
    assert result.columns[:3] == table.columns
    assert {f.name: f.dataType.simpleString() for f in result.schema.fields[3:]} == {
        "foo_type_source_concept_id": "bigint",
        "foo_type_concept_id": "bigint",
        "foo_source_value": "string",
        "foo_source_concept_id": "bigint",
    }
    assert result.first()[:3] == (1, 2, "x")


def test_number_copies(frame):
    rows = [("hot", None)] * 1000 + [("hot", 1)] * 3 + [(None, None)] * 2 + [(f"k{i}", i) for i in range(500)]
    table = frame(rows, "a string, b int").repartition(5)
    result = number_copies(table, chunk=64).collect()
    expected = {(a, b, i + 1) for a, b in set(rows) for i in range(rows.count((a, b)))}
    assert len(result) == len(rows) and {tuple(r) for r in result} == expected


def test_copies_of_a_hot_row_are_spread(spark):
    hot = spark.range(400_000).select(F.lit("same").alias("a"))
    placed = number_copies(hot, chunk=1000).groupBy(F.spark_partition_id()).count()
    sizes = [row["count"] for row in placed.collect()]
    assert sum(sizes) == 400_000 and len(sizes) == 8 and max(sizes) < 100_000


def test_copies_are_counted_before_the_shuffle(spark):
    plan = number_copies(spark.range(10))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan and "Window" not in plan
