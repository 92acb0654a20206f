"""Exact duplicates by composable polynomial fingerprints and a chunkwise comparison.

A normalised text is cut into chunks of bytes.  A chunk hashes to ``h = sum(byte_i * base^(n-1-i)) mod p`` for two primes
and keeps its shift ``m = base^n mod p``; chunks next to each other combine to ``(h1 * m2 + h2, m1 * m2)``.  Chunks are
hashed independently of each other, so no step needs a whole huge text at once but its owner's row.  Texts with equal
fingerprints are then compared chunk by chunk: for every chunk position the smallest and the largest chunk of the
group have to be the same.  Both are partial aggregates, so a group with a third of all rows sends one row for each
task and position.  A group that fails the comparison is split by SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import bounded_batches, each_once, hash_filter, may_hold, null_safe, quoted, SPACES, stored, thrifty
from carebundle.operators.copies import write_copies

CHUNK_BYTES = 1 << 20
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
FINGERPRINT = ("fp1", "fp2", "n_bytes")
_PARTS = "array<struct<h1:bigint,h2:bigint,m1:bigint,m2:bigint>>"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def chunks(data: Column, size: int) -> Column:
    """The byte chunks of a text; the empty text has one empty chunk."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(data) / size)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def combined(parts: Column, primes: tuple[int, int]) -> Column:
    """The fingerprint of a text from the hashes and shifts of its chunks, by length-shifted arithmetic."""
    start = F.struct(F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2"))
    return F.aggregate(
        parts,
        start,
        lambda a, x: F.struct(
            ((a.h1 * x.m1 + x.h1) % primes[0]).alias("h1"), ((a.h2 * x.m2 + x.h2) % primes[1]).alias("h2")
        ),
    )


def _chunk_hasher(size: int, primes: tuple[int, int]):
    def powers(base: int, prime: int) -> np.ndarray:
        """Powers of the base, the highest first; their sum with bytes stays below 2^64."""
        values = np.ones(1, np.uint64)
        while len(values) < size:
            factor = np.uint64(pow(base, len(values), prime))
            values = np.concatenate([values, values * factor % np.uint64(prime)])
        return values[:size][::-1].copy()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [powers(base, prime) for base, prime in zip(BASES, primes, strict=True)]
        shifts: dict[int, tuple[int, int]] = {}
        for batch in batches:
            lists = batch.column("chunks")
            flat = lists.flatten()
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            columns: list[list[int]] = [[], [], [], []]
            for chunk in flat:
                data = np.frombuffer(chunk.as_buffer(), np.uint8).astype(np.uint64)
                n = len(data)
                if n not in shifts:
                    shifts[n] = tuple(pow(base, n, prime) for base, prime in zip(BASES, primes, strict=True))
                for k, (powers_of, prime) in enumerate(zip(tables, primes, strict=True)):
                    columns[k].append(int(data @ powers_of[size - n :]) % prime if n else 0)
                    columns[2 + k].append(shifts[n][k])
            values = pa.StructArray.from_arrays(
                [pa.array(column, pa.int64()) for column in columns], names=["h1", "h2", "m1", "m2"]
            )
            parts = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
            kept = [batch.column(name) for name in ("id", "n_points", "n_bytes", "text_sha256")]
            yield pa.RecordBatch.from_arrays([*kept, parts], ["id", "n_points", "n_bytes", "text_sha256", "parts"])

    return hashed


def fingerprints(
    documents: DataFrame, id_column: str, text_column: str, chunk_bytes: int, primes: tuple[int, int]
) -> DataFrame:
    """One row per row: its id, the length of the original in code points and of the normalised text in bytes, SHA-256
    and fingerprint of the latter."""
    bounded_batches(documents.sparkSession)
    text = quoted(text_column)
    rows = documents.select(
        quoted(id_column).alias("id"),
        F.coalesce(F.length(text), F.lit(0)).cast("bigint").alias("n_points"),
        F.encode(normalised(text), "utf-8").alias("data"),
    ).select(
        "id",
        "n_points",
        F.octet_length("data").cast("bigint").alias("n_bytes"),
        F.sha2("data", 256).alias("text_sha256"),
        chunks(F.col("data"), chunk_bytes).alias("chunks"),
    )
    kind = documents.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, n_points bigint, n_bytes bigint, text_sha256 string, parts {_PARTS}"
    parts = rows.mapInArrow(thrifty(_chunk_hasher(chunk_bytes, primes)), schema)
    whole = parts.withColumn("fp", combined(F.col("parts"), primes))
    return whole.select(
        "id", "n_points", "n_bytes", "text_sha256", F.col("fp.h1").alias("fp1"), F.col("fp.h2").alias("fp2")
    )


def exact_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    primes: tuple[int, int] = PRIMES,
) -> DataFrame:
    """One row per row of ``documents``: doc_id, keep_id, group_size, kept, text_sha256, n_points
    (code points of the original text).

    Texts are equal when equal without white space; null counts as empty, and so does a text of white space.  Of
    equal texts the one with most code points stays, then the smallest id (null last).  Of repeated rows with the same
    id and text exactly one is kept.  Other columns, whatever their names, are not looked at.  An empty table gives
    an empty result.
    """
    key = list(FINGERPRINT)
    rows = fingerprints(documents, id_column, text_column, chunk_bytes, primes)
    distinct = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    distinct = stored(distinct, "fingerprints")
    groups = distinct.groupBy(*key).agg(F.sum("copies").alias("size"))
    shared = stored(groups.where("size > 1").drop("size"), "shared-fingerprints")
    # Only texts that share their fingerprint are read again.
    suspects = stored(
        distinct.join(shared, key).select("id", "text_sha256", *key).distinct(), "suspects"
    )
    # The texts of all other rows stay where they are: a filter that the JVM looks up by id comes before anything else.
    text = quoted(text_column)
    bits = hash_filter(suspects.select(F.xxhash64("id").alias("hash")), "hash")
    again = documents.select(quoted(id_column).alias("id"), text.alias("text")).where(may_hold(bits, F.xxhash64("id")))
    again = again.select("id", F.encode(normalised(F.col("text")), "utf-8").alias("data"))
    again = again.withColumn("text_sha256", F.sha2("data", 256))
    compared = (
        again.join(suspects, null_safe(again, suspects, ["id", "text_sha256"]))
        .select(*key, F.posexplode(chunks(F.col("data"), chunk_bytes)).alias("position", "chunk"))
        .groupBy(*key, "position")
        .agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    )
    unequal = stored(compared.where("least <> most").select(*key).distinct(), "unequal-fingerprints")
    marked = distinct.join(unequal.withColumn("unequal", F.lit(True)), key, "left").withColumn(
        "part", F.when(F.col("unequal"), F.col("text_sha256")).otherwise("")
    )
    marked = marked.drop("unequal")
    key.append("part")
    best = F.min(F.struct((-F.col("n_points")).alias("n"), F.col("id").isNull().alias("none"), "id"))
    classes = marked.groupBy(*key).agg(F.sum("copies").alias("group_size"), best.alias("best"))
    classes = stored(classes, "classes")
    whole = marked.join(classes, key)
    first = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("n_points") == -F.col("best.n"))
    whole = whole.select(
        F.col("id").alias("doc_id"),
        F.col("best.id").alias("keep_id"),
        "group_size",
        first.alias("first"),
        "text_sha256",
        "n_points",
        "copies",
    )
    return write_copies(stored(whole, "dedup-rows"), "copies", "copy").select(
        "doc_id", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"), "text_sha256", "n_points"
    )


def deduplicated(documents: DataFrame, duplicates: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that :func:`exact_duplicates` keeps, with all their columns; of repeated rows one."""
    text = documents[f"`{text_column.replace('`', '``')}`"]
    keys = [
        (documents[f"`{id_column.replace('`', '``')}`"], "doc_id"),
        (F.sha2(normalised(text), 256), "text_sha256"),
        (F.coalesce(F.length(text), F.lit(0)).cast("bigint"), "n_points"),
    ]
    names = [name for _, name in keys]
    kept = duplicates.groupBy(*names).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    kept = stored(kept, "kept-texts")
    return each_once(documents, kept.where("not kept"), kept.where("kept and n > 1"), keys)
