"""Small fixed relations as local tables, which the optimizer can fold and prune."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.schema import TARGET_TABLES, target_schema

_ARROW = {
    T.LongType: pa.int64(),
    T.StringType: pa.string(),
    T.DoubleType: pa.float64(),
    T.BooleanType: pa.bool_(),
    T.DateType: pa.date32(),
    T.TimestampType: pa.timestamp("us", "UTC"),
}


def literal_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A local relation with exactly this schema.  Rows given as a Python list would become an RDD scan with as
    many tasks as the cluster has cores."""
    rows = list(rows)
    arrays = [
        pa.array([row[i] for row in rows], _ARROW[type(field.dataType)]) for i, field in enumerate(schema.fields)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names), schema)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return literal_frame(spark, [], target_schema(table))


def empty_target(spark: SparkSession) -> Bundle:
    return Bundle({table: empty_table(spark, table) for table in TARGET_TABLES})
