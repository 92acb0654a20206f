"""Run a row-by-row conversion over new source rows only.

All conversions that are one projection (persons, observations, locations, visits, notes, care sites, providers, and
conditions, procedures and costs with ``row_id``) work on a stream without state, so no watermark is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def stream_csvs(spark: SparkSession, folder: str, columns: Iterable[str]) -> DataFrame:
    """New CSV files of one source table, with a header and these text columns in the files' order."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.readStream.schema(schema).option("header", True).csv(folder)


def append_converted(
    stream: DataFrame,
    conversion: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    data_format: str = "parquet",
) -> StreamingQuery:
    """Convert all rows that have arrived and append them to a folder, exactly once; both folders must be shared."""
    return (
        conversion(stream)
        .writeStream.format(data_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
