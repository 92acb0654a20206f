"""Queries over a concept table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def count_by(frame: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column (column, count); counted in part before the shuffle."""
    return frame.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def count_by_sql(spark: SparkSession, view: str, column: str) -> DataFrame:
    """The same query as SQL text over a view."""
    return spark.sql(f"select {column}, count(*) as count from {view} group by {column}")


def preview(frame: DataFrame, *columns: str, rows: int = 10) -> DataFrame:
    """The first rows only: tasks stop reading once there are enough."""
    return frame.select(*columns).limit(rows)


def one_per_code(frame: DataFrame, code: str, description: str) -> DataFrame:
    """One row per code with its smallest description, so that re-runs give the same row.

    The distinct pairs come first: they are found by hashing, while the minimum of a text is found by sorting.
    """
    return frame.select(code, description).distinct().groupBy(code).agg(F.min(description).alias(description))


def events_per_person(persons: DataFrame, visits: DataFrame, conditions: DataFrame) -> DataFrame:
    """(person_id, n_visits, n_conditions, first_visit): each event table is grouped by person before it meets the persons, so
    tables in equal buckets of persons need no shuffle."""
    visited = visits.groupBy("person_id").agg(F.count(F.lit(1)).alias("n_visits"), F.min("visit_start_datetime").alias("first_visit"))
    ill = conditions.groupBy("person_id").agg(F.count(F.lit(1)).alias("n_conditions"))
    counted = persons.select("person_id").join(visited, "person_id", "left").join(ill, "person_id", "left")
    return counted.select(
        "person_id", F.coalesce("n_visits", F.lit(0)).alias("n_visits"), F.coalesce("n_conditions", F.lit(0)).alias("n_conditions"), "first_visit"
    )
