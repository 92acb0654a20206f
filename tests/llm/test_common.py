"""Helpers that the operators share."""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from carebundle.llm import common
from carebundle.operators.copies import write_copies


def test_filters_hold_all_hashes_and_few_others(spark):
    held = spark.range(0, 200_000, 7).select(F.xxhash64("id").alias("h")).union(spark.sql("select xxhash64(cast(null as bigint))"))
    bits = common.hash_filter(held, "h")
    asked = spark.range(200_000).select("id", common.may_hold(bits, F.xxhash64("id")).alias("may"))
    rows = Counter((r.id % 7 == 0, r.may) for r in asked.collect())
    assert rows[True, False] == 0 and rows[False, True] < 1000
    extremes = spark.sql("select explode(array(-9223372036854775808, -1, 0, 1, 9223372036854775807)) as h")
    bits = common.hash_filter(extremes, "h")
    assert all(r.may for r in extremes.select(common.may_hold(bits, F.col("h")).alias("may")).collect())
    nothing = common.hash_filter(held.limit(0), "h")
    assert not any(r.may for r in held.select(common.may_hold(nothing, F.col("h")).alias("may")).collect())


def test_without(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (None, "a", "y"), (None, None, "z"), (2, "a", "x")], "doc_id bigint, text string, `key 0` string")
    keys = [(docs["doc_id"], "d"), (docs["text"], "t")]
    dropped = spark.createDataFrame([(1, "a"), (None, None), (3, "c")], "d bigint, t string")
    kept = common.without(docs, dropped, keys)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, "b"), (None, "a"), (2, "a")])
    assert common.without(docs, dropped.limit(0), keys).count() == 5 and common.without(docs.limit(0), dropped, keys).count() == 0


def test_whole_rows_are_shuffled_only_where_they_may_go(spark, tmp_path):
    """The rows that no dropped id can have are read and passed on."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    docs = spark.range(5000).select("id", F.repeat(F.lit("x"), 100).alias("text"))
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = common.without(docs, spark.range(0, 5000, 1000).toDF("d"), [(docs["id"], "d")])
    assert kept.count() == 4995
    plan = kept._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Union" in plan and plan.count("SortMergeJoin") == 1


def test_each_once(spark):
    rows = [(1, "a", 9), (1, "a", 3), (1, "a", 3), (2, "b", 1), (None, "n", 2), (None, "n", 1), (4, "d", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, extra bigint")
    keys = [(docs["doc_id"], "i"), (docs["text"], "t")]
    names = "i bigint, t string"
    found = common.each_once(docs, spark.createDataFrame([(2, "b")], names), spark.createDataFrame([(1, "a"), (None, "n")], names), keys)
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(1, "a", 3), (None, "n", 1), (4, "d", 0)], key=str)
    empty = spark.createDataFrame([], names)
    assert common.each_once(docs, empty, empty, keys).count() == len(rows)


def test_copies_of_counted_rows(spark):
    counted = spark.createDataFrame([("a", 1), ("b", 7), (None, 3), ("c", 0)], "copy string, n bigint")
    rows = write_copies(counted, "n", "number", chunk=2).collect()
    assert Counter((r.copy, r.number) for r in rows) == Counter([("a", 1), *(("b", k) for k in range(1, 8)), *((None, k) for k in range(1, 4))])


def test_bounded_batches(spark):
    names = [f"spark.sql.execution.arrow.{name}" for name in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(name, None) for name in names]
    for given, rows, size in (("10000", "1000", str(4 << 20)), ("10", "10", str(4 << 20)), ("0", "1000", str(4 << 20))):
        spark.conf.set(names[0], given)
        spark.conf.set(names[1], "64MB")
        common.bounded_batches(spark)
        assert spark.conf.get(names[0]) == rows
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_thrifty_functions_pass_batches_on():
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(3))], ["x"])
    assert [b.num_rows for b in common.thrifty(lambda batches: (b for b in batches))(iter([batch, batch]))] == [3, 3]


def test_filters_are_broadcast_once(spark):
    """A filter is no value of the plan, which the driver would write into the tasks of every stage."""
    held = spark.range(0, 20_000, 7).select(F.xxhash64("id").alias("h"))
    rows = spark.range(20_000).select("id", F.lit("x").alias("filter bits"), F.lit(1).alias("bits"))
    bits = common.filter_rows(held, "h")
    kept = common.filtered(rows, bits, F.xxhash64(rows["id"]))
    rest = common.filtered(rows, bits, F.xxhash64("id"), held=False)
    assert kept.columns == rest.columns == rows.columns
    found, others = ({r.id for r in part.collect()} for part in (kept, rest))
    assert found >= set(range(0, 20_000, 7)) and len(found) < 2 * len(range(0, 20_000, 7))
    assert not found & others and len(found | others) == 20_000
    assert common.filtered(rows, common.filter_rows(held.limit(0), "h"), F.xxhash64("id")).isEmpty()
    nothing = rows.select(F.lit(None).cast("bigint").alias("h"))
    assert common.filtered(nothing, bits, F.col("h")).isEmpty() and common.filtered(nothing, bits, F.col("h"), held=False).count() == 20_000
    docs = rows.select("id", "bits")
    plan = common.without(docs, held.toDF("d").limit(3), [(docs["id"], "d")])._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "BroadcastExchange" in plan
