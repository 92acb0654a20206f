"""Runs of words that repeat with a period, found along diagonals of matches.

The words at lag q that equal the word q places before them form the diagonal of that lag.  A stretch of matches on it is
a stretch of words with period q, and a run covers at least q matches, so words whose number is a multiple of q are
enough to notice it: the words of a text go by in order, each is compared with its earlier occurrences at the lags that
divide its number, and where one matches on a diagonal that is not active, the length of the match is taken in both
directions.  The diagonal is then active until the match ends, and a match that is long enough is emitted at once.  Match
lengths grow by halving steps over fingerprints of word sequences rather than word by word.  So a text of n words costs
about n log n comparisons, one word repeated a million times included, where counting every earlier occurrence costs
n * n / 2.

A stretch with period q and a smaller period that divides q shows on both diagonals with the same first and last word; the
smaller one names the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import bounded_batches, quoted, slices, text_buffers

LEAST = 12
SLICE = 1 << 20
BLOCK = 1 << 15
PRIMES = (2147483647, 2147483629)
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class _Sequences:
    """Fingerprints, two residues of a polynomial, of all stretches of a sequence of numbers."""

    def __init__(self, codes: np.ndarray) -> None:
        self.n, self.tables = len(codes), []
        for prime, base in zip(PRIMES, (1_000_003, 998_244_353), strict=True):
            p = np.uint64(prime)
            powers = np.ones(1, np.uint64)
            while len(powers) <= self.n:
                powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), prime)) % p])
            values = (codes.astype(np.uint64) + np.uint64(1)) % p * powers[: self.n] % p
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values, out=sums[1:])  # below 2^31 each
            self.tables.append((p, powers, sums % p))

    def same(self, first: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of a size from ``first`` on equal those a lag before."""
        equal = np.ones(len(first), bool)
        for p, powers, sums in self.tables:
            later = (sums[first + size] + p - sums[first]) % p
            earlier = (sums[first - lag + size] + p - sums[first - lag]) % p
            equal &= later == earlier * powers[lag] % p
        return equal

    def matches(self, at: np.ndarray, lag: np.ndarray, backwards: bool) -> np.ndarray:
        """How many words in a row match on a diagonal, from a word on or before it."""
        limit = at - lag if backwards else self.n - at
        length = np.zeros(len(at), np.int64)
        step = 1 << max(int(limit.max(initial=0)).bit_length() - 1, 0)
        while step and len(at):
            rows = np.flatnonzero(length + step <= limit)
            first = at[rows] - length[rows] - step if backwards else at[rows] + length[rows]
            good = self.same(first, lag[rows], np.full(len(rows), step))
            length[rows[good]] += step
            step >>= 1
        return length


def runs_of(codes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """The runs of a sequence of numbers: rows of start, length and period, by start, then period.

    A run is a stretch with smallest period q, of at least ``least`` and at least 2q members, that no neighbour extends.
    """
    n = len(codes)
    nothing = np.zeros((0, 3), np.int64)
    if n < max(least, 2) or not _may_repeat(codes, least // 2):
        return nothing
    sequences, longest = _Sequences(codes), n // 2
    active_until = np.zeros(longest + 1, np.int64)  # by lag
    emitted = [nothing]
    for low in range(1, n, BLOCK):
        high = min(low + BLOCK, n)
        lags = np.arange(1, min(longest, high - 1) + 1)
        first = -(-low // lags) * lags
        times = np.maximum((high - 1 - first) // lags + 1, 0)
        lag, start = np.repeat(lags, times), np.repeat(np.cumsum(times) - times, times)
        at = np.repeat(first, times) + (np.arange(len(lag)) - start) * lag
        seen = np.flatnonzero((codes[at] == codes[at - lag]) & (at >= active_until[lag]))
        at, lag = at[seen], lag[seen]
        after, before = sequences.matches(at, lag, False), sequences.matches(at, lag, True)
        np.maximum.at(active_until, lag, at + after)
        enough = after + before >= np.maximum(lag, least - lag)
        at, lag, after, before = at[enough], lag[enough], after[enough], before[enough]
        emitted.append(np.unique(np.stack([at - before - lag, after + before + lag, lag], 1), axis=0))
    rows = np.unique(np.concatenate(emitted), axis=0)  # of equal stretches the smallest period comes first
    if len(rows):
        rows = rows[np.concatenate([[True], np.any(rows[1:, :2] != rows[:-1, :2], axis=1)])]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _may_repeat(codes: np.ndarray, size: int) -> bool:
    """Whether some ``size`` members in a row occur twice, as they do in every run; equal sums may say so wrongly."""
    size = max(size, 1)
    sums = np.zeros(len(codes) - size + 1, np.uint64)
    for k in range(size):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + len(sums)].astype(np.uint64)
    sums.sort()
    return bool((sums[1:] == sums[:-1]).any())


def _kept(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words outside what repeats: of each run its first period stays."""
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def periodic_runs(
    documents: DataFrame, least: int = LEAST, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row: doc_id, n_words, runs (array of start, length, period; words counted from 0; by start, then period) and
    collapsed (the words that no run repeats, joined by one space).

    Words are what white space separates; they are equal if their bytes are.  Stretches of words are compared by
    fingerprints of 62 bits.  Null, empty and blank texts have no words, no runs and an empty collapsed text; a text of
    any length is looked at as a whole.  Repeated rows give repeated rows, an empty table an empty one; null ids stay null;
    other columns are not looked at.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            raw = memoryview(data)
            for low, high in slices(offsets, SLICE):
                counts, sizes, rows, texts = [], [0], [], []
                for row in range(low, high):
                    words = bytes(raw[offsets[row] : offsets[row + 1]]).split()
                    numbers: dict[bytes, int] = {}
                    codes = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))
                    own = runs_of(codes, least)
                    counts.append(len(words))
                    sizes.append(sizes[-1] + len(own))
                    rows.append(own)
                    texts.append(b" ".join(_kept(words, own) if len(own) else words).decode("utf-8"))
                flat = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
                structs = pa.StructArray.from_arrays(
                    [pa.array(flat[:, k], pa.int64()) for k in range(3)], names=["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), structs),
                        pa.array(texts, pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    bounded_batches(documents.sparkSession)
    rows = documents.select(quoted(id_column).alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(found, f"doc_id {kind}, n_words bigint, runs {_RUNS}, collapsed string")


def longest_run(runs: Column) -> Column:
    """The run with the greatest length, of equals the first, then that with the smallest period; null without runs."""
    ordered = F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(ordered)


def run_lines(runs: Column) -> Column:
    """A line ``start,length,period`` for each run, each ended by a line feed."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")


def summary(found: DataFrame) -> DataFrame:
    """One row per row of :func:`periodic_runs`: doc_id, n_runs, the longest run (start, length, period, exponent_milli: thousandths
    of periods in it, rounded down) and digests of all runs and of the collapsed text."""
    best = found.withColumn("best", longest_run(F.col("runs")))
    length, period = -F.col("best.n"), F.col("best.period")
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("bigint").alias("exponent_milli"),
        F.sha2(run_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_periods(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and text, in which one document of ten, by a checksum of its id, repeats some of its words to its end: with
    g = checksum / 10, word i from a = g % n on is the original word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8).  Null ids,
    and texts without words, are left as they are."""
    number, text = quoted(id_column), quoted(text_column).cast("string")
    checksum = F.crc32(number.cast("string"))
    rows = documents.select(number.alias("doc_id"), text.alias("text"), checksum.alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    g = F.floor(F.col("h") / 10)
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, g % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    moved = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    planted = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", moved(i)))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
