"""Concepts over streams: every pair of code and description is passed on once while it is remembered.

Unlike the row-by-row conversions this needs state.  A pair stays in it until the watermark has passed its time by the
delay, so the state is bounded by the pairs of one delay and not by the stream.  A pair that comes again after that is passed
on again, and folding pairs into concepts makes no difference between once and twice.  A row whose time is before the
watermark is late and dropped by Spark: choose a delay as long as rows can be late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carebundle.plans.convert import to_concepts
from carebundle.sources.literal import literal_frame

PAIRS = T.StructType([T.StructField(name, T.StringType()) for name in ("code", "description")])


def append_pairs(stream: DataFrame, time: str, delay: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append the new pairs (code, description) of a stream with an event time to a folder, exactly once each while they are
    remembered; what is remembered survives a restart from the checkpoint.  Both folders must be shared."""
    rows = stream.select("code", "description", F.col(time).alias("event_time"))
    new = rows.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["code", "description"])
    return (
        new.select("code", "description")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def streamed_concepts(spark: SparkSession, path: str) -> DataFrame:
    """The concepts of all pairs that have arrived, as the batch conversion makes them of whole tables."""
    return to_concepts(spark.read.schema(PAIRS).parquet(path), literal_frame(spark, [], PAIRS))
