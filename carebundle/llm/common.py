"""Helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carebundle.sources.storage import new_folder

# The white space of every contract: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
FILTER_BITS = 1 << 25
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20
_ARROW = "spark.sql.execution.arrow"


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    return F.col(quoted_name(name))


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: what follows neither recomputes it nor loses it with an
    executor."""
    spark = frame.sparkSession
    folder = new_folder(spark, label)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality of all named columns in which null equals null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offset of each text in them; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), ends
    return np.frombuffer(data, np.uint8), ends


def slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes, at least one row each, so that working memory does not follow the batch."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most so many rows and bytes, whatever the texts: a setting of the session, lowered where it
    is higher, since a batch is held in the JVM and in the Python worker at once."""
    for name, most in ((f"{_ARROW}.maxRecordsPerBatch", BATCH_ROWS), (f"{_ARROW}.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(name, None)
        digits = "".join(c for c in now or "" if c.isdigit())
        if not digits or int(digits) == 0 or int(digits) > most:
            spark.conf.set(name, str(most))


def thrifty(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function over Arrow batches that gives freed memory back to the system when its task ends: Python workers live on
    beside those of later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
            if trim:
                trim(0)

    return run


def filter_rows(hashes: DataFrame, column: str) -> DataFrame:
    """The bits of some hashes in 1024 rows of 4 KB at most, whatever their number.  Above some ten millions of hashes they let
    more and more others through, and what follows has to do the whole work."""
    bit = F.pmod(F.col(column), F.lit(FILTER_BITS)) + 1  # the bitmap functions count from 1
    return hashes.groupBy(F.bitmap_bucket_number(bit).alias("filter bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("filter bits")
    )


def hash_filter(hashes: DataFrame, column: str) -> Column:
    """The bits of :func:`filter_rows` as one value of at most 4 MB, which the JVM can look up: see :func:`may_hold`.  The
    driver writes it again for each stage that looks it up; :func:`filtered` broadcasts it once."""
    bits = F.map_from_entries(F.collect_list(F.struct("`filter bucket`", "`filter bits`")))
    return filter_rows(hashes, column).agg(bits.alias("bits")).scalar()


def _bit_of(bits: Column, bit: Column) -> Column:
    """Whether the bits of a bucket hold a bit, which counts from 1."""
    place = F.bitmap_bit_position(bit)
    byte = F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))
    powers = F.array(*(F.lit(1 << k) for k in range(8)))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.coalesce(number.bitwiseAND(F.element_at(powers, (place % 8).cast("int") + 1)) != 0, F.lit(False))


def may_hold(bits: Column, value: Column) -> Column:
    """Whether a hash may be among those of a filter; false says that it is not."""
    bit = F.pmod(value, F.lit(FILTER_BITS)) + 1
    return _bit_of(F.element_at(bits, F.bitmap_bucket_number(bit)), bit)


def filtered(frame: DataFrame, bits: DataFrame, value: Column, held: bool = True) -> DataFrame:
    """The rows of a frame whose hash may be among those of :func:`filter_rows`, or the others.  Columns of any name are kept."""
    bit = F.pmod(value, F.lit(FILTER_BITS)) + 1
    condition = (bits["`filter bucket`"] == F.bitmap_bucket_number(bit)) & _bit_of(bits["`filter bits`"], bit)
    return frame.join(F.broadcast(bits), condition, "left_semi" if held else "left_anti")


def without(documents: DataFrame, dropped: DataFrame, keys: Sequence[tuple[Column, str]]) -> DataFrame:
    """The rows of ``documents`` that ``dropped`` does not name: each key is an expression over the documents and the column
    of ``dropped`` it is compared with, null equal to null.  Columns of any name are kept.

    Rows whose first key no dropped row can have pass where they are; only the others, whole rows, are shuffled to meet the
    dropped ones.
    """
    dropped = stored(dropped.select(*(quoted(name).alias(f"key {i}") for i, (_, name) in enumerate(keys))), "dropped")
    bits, hashed = filter_rows(dropped.select(F.xxhash64("`key 0`").alias("hash")), "hash"), F.xxhash64(keys[0][0])
    condition = F.lit(True)
    for i, (expression, _) in enumerate(keys):
        condition = condition & expression.eqNullSafe(dropped[f"`key {i}`"])
    maybe = filtered(documents, bits, hashed)
    return filtered(documents, bits, hashed, held=False).unionByName(maybe.join(dropped, condition, "left_anti"))


def each_once(
    documents: DataFrame, dropped: DataFrame, repeated: DataFrame, keys: Sequence[tuple[Column, str]]
) -> DataFrame:
    """The rows of ``documents`` without those that ``dropped`` names, and of the rows that ``repeated`` names, which ``dropped``
    does not, one for each key: the first by all its columns.  Keys are as in :func:`without`."""
    names = [name for _, name in keys]
    repeated = stored(repeated.select(*map(quoted, names)).distinct(), "repeated")
    rest = without(documents, dropped.select(*map(quoted, names)).unionByName(repeated), keys)
    if repeated.isEmpty():
        return rest
    marks = repeated.select(*(quoted(name).alias(f"key {i}") for i, name in enumerate(names)))
    bits = filter_rows(marks.select(F.xxhash64("`key 0`").alias("hash")), "hash")
    condition = F.lit(True)
    for i, (expression, _) in enumerate(keys):
        condition = condition & expression.eqNullSafe(marks[f"`key {i}`"])
    # They meet in a partial aggregate, so a row that makes up a third of the table is a row for each task.
    row = F.struct(*(documents[quoted_name(name)] for name in documents.columns))
    again = filtered(documents, bits, F.xxhash64(keys[0][0])).join(marks, condition, "left_semi")
    folded = again.groupBy(*(expression.alias(f"key {i}") for i, (expression, _) in enumerate(keys)))
    return rest.unionByName(folded.agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*"))
