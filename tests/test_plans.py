"""The plans a large cluster would run."""

import pytest
from pyspark.sql import functions as F

from carebundle.bundle import Bundle
from carebundle.checks.queries import CODES, COST, COST_BY_LINE, PERSON, QUERIES
from carebundle.operators.access import readable_persons, with_root_provider
from carebundle.plans import convert
from carebundle.plans.star import ROW_IDS, Star
from carebundle.sources.literal import empty_table
from tests.conftest import SMALL


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_tables(spark):
    """Plans as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Star(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def small_skew(spark):
    """Partitions count as hot from a few kilobytes on."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ScalaUDF"):
        assert word not in plan


def test_large_sides_are_shuffled_not_broadcast(large_tables):
    plan = _plan(convert.to_costs(large_tables.procedures(COST_BY_LINE), ROW_IDS["procedures"]))
    assert plan.count("SortMergeJoin") == 1 and "Broadcast" not in plan and "REPARTITION" not in plan
    assert "part.parquet" not in plan


def test_joins_that_nobody_needs_are_left_out(spark, large_tables):
    for name in ("visit_concept", "gender_concept", "parse_date", "to_persons"):
        assert "Join" not in _plan(QUERIES[name](spark, SMALL)), name
    assert _plan(QUERIES["parse_day"](spark, SMALL)).count("SortMergeJoin") == 1


def test_the_source_is_joined_once_for_all_targets(spark, large_tables):
    for name in ("convert_row_counts", "orphan_keys"):
        assert "orders.parquet" not in _plan(QUERIES[name](spark, SMALL)), name


def test_concepts_need_no_orders(large_tables):
    plan = _plan(convert.to_concepts(large_tables.conditions(CODES), large_tables.procedures(CODES)))
    assert "orders.parquet" not in plan and plan.count("Exchange") <= 6
    assert "EqualTo(l_returnflag,R)" in plan


def test_row_ids_save_the_shuffle_of_rows(large_tables):
    with_id = _plan(convert.to_costs(large_tables.procedures(COST_BY_LINE), ROW_IDS["procedures"]))
    without = _plan(convert.to_costs(large_tables.procedures(COST)))
    assert with_id.count("Exchange hashpartitioning") == 2
    assert "partial_count(1)" in without and "Window" not in without


def test_copies_read_their_shuffle_twice_but_write_it_once(spark):
    from carebundle.operators.copies import number_copies

    frame = number_copies(spark.range(1000).select((F.col("id") % 7).alias("k")), chunk=142)
    assert len(frame.collect()) == 1000
    final = _plan(frame).split("Initial Plan")[0]
    assert "ReusedExchange" in final and "REPARTITION_BY_NUM" in final


def test_only_used_columns_are_read(large_tables):
    plan = _plan(convert.to_persons(large_tables.patients(PERSON)))
    assert "ReadSchema: struct<c_custkey:bigint>" in plan and "nation.parquet" not in plan


def test_scalar_subquery_instead_of_a_count_on_the_driver(large_tables):
    assert "Subquery" in _plan(large_tables.encounters())


def test_hot_keys_in_joins(spark, large_tables, small_skew, tmp_path):
    """A third of all lines belong to one order; adaptive execution splits that partition and loses no row."""
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").where("l_returnflag <> 'R'")
    hot = F.when(F.col("l_linenumber") <= 3, F.lit(7)).otherwise(F.col("l_orderkey"))
    lines.withColumn("l_orderkey", hot).repartition(16).write.parquet(str(tmp_path / "lineitem.parquet"))
    for name in ("orders", "part"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    costs = convert.to_costs(Star(spark, str(tmp_path)).procedures(COST_BY_LINE), ROW_IDS["procedures"])
    rows = costs.collect()
    assert len(rows) == lines.count() and "skew=true" in _plan(costs)


def test_the_cohort_of_all_persons_is_split(spark, large_tables, small_skew, tmp_path):
    """The root cohort holds every person under one definition."""
    persons = spark.range(20_000).select(F.col("id").alias("person_id"))
    empty = {name: empty_table(spark, name) for name in ("cohort_definition", "cohort", "role", "care_site_history", "care_site", "provider")}
    bundle = with_root_provider(Bundle({"person": persons, **empty}), "admin")
    stored = {}
    for name, frame in bundle.items():
        frame.repartition(16).write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    found = readable_persons(Bundle(stored), "admin")
    assert len(found.collect()) == 20_000 and "skew=true" in _plan(found)
