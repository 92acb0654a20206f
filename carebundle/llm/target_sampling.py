"""Importance resampling towards a target distribution, with array-scored weights and an exact numeric cutoff.

A text's features are its runs of one to ``longest`` words; each falls into a bucket.  The gain of a bucket is the scaled
log-ratio of its share in the target texts to its share in all documents, an array as long as there are buckets
whatever the corpus.  A document's weight is the mean gain of its features, looked up in that array, and its score the
weight plus Gumbel noise drawn from its id, so the highest scores are a sample without replacement by importance.

The scores are written once.  The cutoff is found in them by halving an interval of scores, then one of the ids that are
tied at that score: each job counts rows at a few thresholds and sends those counts to the driver, nothing else.
Only the rows above the cutoff are range-partitioned, sorted and numbered from the sizes of the partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import bounded_batches, quoted, slices, stored, text_buffers
from carebundle.operators.copies import number_copies

SLICE = 1 << 21
# Words whose bucket a process remembers; forgetting them changes no result.
KNOWN_WORDS = 200_000
# Thresholds whose rows one job counts: four halvings at once.
THRESHOLDS = 16
LAST_ID = (1 << 63) - 1
# Letters A-Z to lower case; bytes that belong to no word to spaces.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Settings:
    """``percent`` of the documents with at least ``least_words`` words are drawn."""

    longest: int = 1
    buckets: int = 10_000
    scale: int = 1000
    percent: int = 10
    least_words: int = 20
    seed: int = 2024


class _Buckets(dict):
    """The bucket of a feature, by CRC-32."""

    def __init__(self, count: int) -> None:
        super().__init__()
        self.count = count

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[feature] = bucket = crc32(feature) % self.count
        return bucket


def _features(words: list[bytes], longest: int) -> Iterator[bytes]:
    def runs(n: int) -> Iterator[bytes]:
        return (b" ".join(words[i : i + n]) for i in range(len(words) - n + 1))

    return chain(words, *map(runs, range(2, longest + 1)))


def _bucketed(column: pa.Array, known: _Buckets, longest: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows, each with the numbers of words and of features of its texts and the buckets of all features in order."""
    data, offsets = text_buffers(column)
    raw = memoryview(data)
    for low, high in slices(offsets, SLICE):
        n_words, n_features = np.zeros(high - low, np.int64), np.zeros(high - low, np.int64)
        found = []
        for row in range(low, high):
            words = bytes(raw[offsets[row] : offsets[row + 1]]).translate(_WORD_BYTES).split()
            buckets = np.fromiter(map(known.__getitem__, _features(words, longest)), np.int64)
            n_words[row - low], n_features[row - low] = len(words), len(buckets)
            found.append(buckets)
        yield low, high, n_words, n_features, np.concatenate(found) if found else np.zeros(0, np.int64)


def bucket_gains(
    documents: DataFrame, target: DataFrame, settings: Settings, text_column: str = "text", target_column: str = "text"
) -> np.ndarray:
    """The gain of each bucket, from all documents and all target texts."""
    bounded_batches(documents.sparkSession)
    buckets, longest = settings.buckets, settings.longest

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, totals = _Buckets(buckets), np.zeros((2, buckets), np.int64)
        for batch in batches:
            sides = batch.column(1).to_numpy(zero_copy_only=False)
            for low, high, _, sizes, found in _bucketed(batch.column(0), known, longest):
                side = np.repeat(sides[low:high], sizes)
                totals += np.bincount(side * buckets + found, minlength=2 * buckets).reshape(2, buckets)
        side, bucket = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(side, pa.int32()), pa.array(bucket, pa.int32()), pa.array(totals[side, bucket])], ["side", "bucket", "n"]
        )

    texts = documents.select(quoted(text_column).cast("string").alias("text"), F.lit(0).alias("side"))
    texts = texts.unionByName(target.select(quoted(target_column).cast("string").alias("text"), F.lit(1).alias("side")))
    counts = texts.mapInArrow(counted, "side int, bucket int, n bigint").groupBy("side", "bucket").agg(F.sum("n").alias("n"))
    totals = [[0] * buckets, [0] * buckets]
    for row in counts.collect():  # at most two rows for each bucket
        totals[row["side"]][row["bucket"]] = row["n"]
    (raw, wanted), (n_raw, n_wanted) = totals, map(sum, totals)
    ratios = [(t + 1.0) * (n_raw + buckets) / ((s + 1.0) * (n_wanted + buckets)) for s, t in zip(raw, wanted, strict=True)]
    return np.array([math.floor(settings.scale * math.log(ratio)) for ratio in ratios], np.int64)


def gumbel_noise(document: Column, settings: Settings) -> Column:
    """Scaled Gumbel noise from the first 32 bits of a digest of the seed and an id; null counts as an empty id."""
    text = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(document.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-settings.scale * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def scores(
    documents: DataFrame, gains: np.ndarray, settings: Settings, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row: doc_id, n_words, n_features, weight, score."""
    bounded_batches(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(gains)  # one number for each bucket
    longest = settings.longest

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(len(held.value))
        for batch in batches:
            for low, high, n_words, sizes, found in _bucketed(batch.column(1), known, longest):
                sums = np.concatenate([[0], np.cumsum(held.value[found])])
                ends = np.cumsum(sizes)
                weights = (sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(n_words), pa.array(sizes), pa.array(weights)],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    rows = documents.select(quoted(id_column).cast("bigint").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    found = rows.mapInArrow(weighed, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    return found.withColumn("score", F.col("weight") + gumbel_noise(F.col("doc_id"), settings))


def threshold(rows: DataFrame, value: Column, wanted: int) -> int:
    """The smallest whole number v such that at least ``wanted`` rows have a value of at most v, by repeated counts."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        marks = sorted({low + (high - low) * k // THRESHOLDS for k in range(THRESHOLDS)})
        counts = rows.agg(*(F.count_if(value <= mark) for mark in marks)).first()
        reached = [mark for mark, count in zip(marks, counts, strict=True) if count >= wanted]
        missed = [mark for mark, count in zip(marks, counts, strict=True) if count < wanted]
        high, low = min([high, *reached]), max([low, *(mark + 1 for mark in missed)])
    return low


def _ranked(chosen: DataFrame, wanted: int) -> DataFrame:
    """The rows with ranks by falling score, then id; rows with equal ids by their other numbers.  Ranks above ``wanted``,
    which only repeated ids can have, are null."""
    spark = chosen.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("copy")]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = number_copies(chosen, "copy").repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    # The lower 33 bits number the rows of a partition.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(dealt.withColumns({"part": F.spark_partition_id(), "place": place}), "drawn-rows")
    offsets, before = [], 0
    for row in placed.groupBy("part").count().orderBy("part").collect():  # a row for each partition
        offsets.append((row["part"], before))
        before += row["count"]
    starts = spark.createDataFrame(offsets or [(0, 0)], "part int, before bigint")
    rank = F.col("before") + F.col("place") + 1
    return placed.join(F.broadcast(starts), "part").withColumn("rank", F.when(rank <= wanted, rank))


def resample_to_target(
    documents: DataFrame,
    target: DataFrame,
    settings: Settings = Settings(),  # noqa: B008
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_features, weight, score, rank (1, 2, ... by falling score, then id, of the
    rows drawn; null for the others).

    Null, empty and blank texts have no features and weight 0, and are too short to be drawn unless no words are asked
    for.  Ids are whole numbers; null ids come after all others, and have the noise of an empty id.  Ties go to the
    smaller id; of rows with the same id and score those with fewer features, then the smaller weight come first, and
    among rows equal in all that any order is the same result.  Exactly the percentage of the long enough rows, rounded
    down, is drawn.  An empty table gives an empty result, without target texts all buckets count as unseen there; other
    columns are not looked at.
    """
    gains = bucket_gains(documents, target, settings, text_column, target_column)
    rows = stored(scores(documents, gains, settings, id_column, text_column), "target-scores")
    long_enough = F.col("n_words") >= settings.least_words
    eligible = rows.where(long_enough)
    wanted = eligible.count() * settings.percent // 100
    names = ("doc_id", "n_features", "weight", "score")
    if not wanted:
        return rows.select(*names, F.lit(None).cast("bigint").alias("rank"))
    score, place = -threshold(eligible, -F.col("score"), wanted), F.coalesce(F.col("doc_id"), F.lit(LAST_ID))
    above, tied = F.col("score") > score, F.col("score") == score
    missing = wanted - eligible.where(above).count()
    last = threshold(eligible.where(tied), place, missing)
    chosen = long_enough & (above | (tied & (place <= last)))
    drawn = _ranked(rows.where(chosen), wanted).select(*names, "rank")
    rest = rows.where(~chosen).select(*names, F.lit(None).cast("bigint").alias("rank"))
    return rest.unionByName(drawn)
