"""Quality by importance resampling: the ratio of two hashed n-gram models, sampled by Gumbel top-k.

A text's features are hashed n-grams of its words and of their shapes (case, last character, length, repetition of the word
before).  The target model counts them in texts labelled good, the raw model in all texts.  The importance of a text
is the mean over its features of the log-ratio of their probabilities.  As many texts are taken as pass a cut
learned from labels; which ones, Gumbel noise on the importances decides, so sampling follows the importance weights
and stays without replacement.  A low temperature leaves only texts near the cut to chance.

A few toxic words vanish in the mean of a long text, so toxicity is judged by a text's worst window: labels give each hashed
word, and each beginning of words, as words are inflected, the log-ratio of its frequencies in toxic and in clean texts, as
far as the counts are sure of it.  A word weighs as its worst feature, and the largest sum over a window of words must stay
below a cut of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import bounded_batches, quoted, slices, stored, text_buffers, thrifty
from carebundle.llm.words import mixed, word_hashes

SLICE = 1 << 19
# Bytes of the beginnings of words that count for toxicity beside the words themselves; at most eight.
BEGINNINGS = (5, 7)
KINDS = 1 + len(BEGINNINGS)


@dataclass(frozen=True)
class Settings:
    """``label_rows`` bounds the labelled rows that the target model and the cut are fitted on: of more, those with the
    smallest hashes of their ids.  Counts of words in toxic and clean texts are moved by ``sure`` standard deviations towards no
    difference before they are compared; ``toxic_window`` words are judged together.  ``miss`` is the largest share of good labelled texts that the cut may reject, and a good
    text that it rejects weighs as ``loss_weight`` bad ones that it lets pass."""

    bins: int = 1 << 16
    smoothing: float = 1.0
    label_rows: int = 20_000
    temperature: float = 0.01
    miss: float = 0.002
    loss_weight: float = 20.0
    toxic_window: int = 64
    sure: float = 2.0
    seed: int = 0


@dataclass(frozen=True)
class Model:
    """Log-ratios and cuts; a text is good from ``cut`` on and toxic from ``toxic_cut`` on."""

    log_ratio: np.ndarray
    cut: float
    settings: Settings
    toxicity: np.ndarray = field(default_factory=lambda: np.zeros(KINDS))
    toxic_cut: float = np.inf


def _shapes(data: np.ndarray, first: np.ndarray, last: np.ndarray, hashes: np.ndarray, same: np.ndarray) -> np.ndarray:
    """A small number for the look of each word; ``same`` tells which words stand in the text of the word before."""
    upper = np.concatenate([[0], np.cumsum((data - np.uint8(65)) < 26)])
    lower = np.concatenate([[0], np.cumsum((data - np.uint8(97)) < 26)])
    sign = np.concatenate([[0], np.cumsum((data > 32) & (data < 127) & ~(((data | 32) - np.uint8(97)) < 26) & ~((data - np.uint8(48)) < 10))])
    n_upper, n_lower, n_sign = upper[last] - upper[first], lower[last] - lower[first], sign[last] - sign[first]
    final = data[last - 1]
    ending = np.where((final == 46) | (final == 44), 1, np.where((final > 32) & (final < 48) | (final > 90) & (final < 97) | (final == 63) | (final == 64) | (final == 124), 2, 0))
    repeated = np.zeros(len(hashes), np.int64)
    repeated[1:] = (hashes[1:] == hashes[:-1]) & same
    shouting = (n_upper >= 2) & (n_lower == 0)
    return (((ending * 2 + shouting) * 2 + repeated) * 4 + np.minimum(n_sign, 3)) * 3 + np.minimum((last - first) // 8, 2)


def _word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of some texts, and where their words begin and end in them."""
    own = data[offsets[0] : offsets[-1]]
    space = (own == 32) | ((own - np.uint8(9)) < 5)
    edges = np.zeros(len(own) + 1, bool)
    edges[offsets - offsets[0]] = True
    before, behind = np.concatenate([[True], space[:-1]]), np.concatenate([space[1:], [True]])
    return own, np.flatnonzero(~space & (before | edges[:-1])), np.flatnonzero(~space & (behind | edges[1:])) + 1


def features(data: np.ndarray, offsets: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The bins of all features of some texts, and the text each belongs to."""
    hashes, firsts = word_hashes(data, offsets)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own, first, last = _word_places(data, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    same = owner[1:] == owner[:-1]
    shapes = mixed(_shapes(own, first, last, hashes, same).astype(np.uint64), 7)
    found, texts = [], []
    for kind, codes in enumerate((hashes, shapes)):
        pairs = mixed(codes[:-1] * np.uint64(31) + codes[1:], 11 + kind)[same]
        for order, values in ((1, codes), (2, pairs)):
            found.append((mixed(values, 2 * kind + order) >> np.uint64(20)).astype(np.int64) % bins)
        texts += [owner, owner[1:][same]]
    return np.concatenate(found), np.concatenate(texts)


def word_slots(data: np.ndarray, offsets: np.ndarray, bins: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each word of some texts in order, in lower case, its own slot and those of its beginnings, -1 where it is shorter;
    and the text each belongs to.  Slots of different kinds are apart."""
    hashes, firsts = word_hashes(data, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    slots = [(mixed(hashes, 1) >> np.uint64(20)).astype(np.int64) % bins]
    if not len(hashes):
        return slots * (1 + len(BEGINNINGS)), owner
    own, first, last = _word_places(data, offsets)
    lower = own | (((own - np.uint8(65)) < 26).astype(np.uint8) << np.uint8(5))
    padded = np.concatenate([lower, np.zeros(8, np.uint8)])
    for kind, size in enumerate(BEGINNINGS, 1):
        packed = np.zeros(len(first), np.uint64)
        for k in range(size):
            packed = packed << np.uint64(8) | padded[first + k]
        codes = (mixed(packed, 40 + size) >> np.uint64(20)).astype(np.int64) % bins + kind * bins
        slots.append(np.where(last - first >= size, codes, -1))
    return slots, owner


def _weights(slots: list[np.ndarray], toxicity: np.ndarray) -> np.ndarray:
    """The weight of each word: that of its worst feature."""
    worst = np.zeros(len(slots[0]))
    for kind in slots:
        worst = np.maximum(worst, np.where(kind >= 0, toxicity[kind], 0.0))
    return worst


def _worst(weights: np.ndarray, owner: np.ndarray, texts: int, window: int) -> np.ndarray:
    """The largest sum of weights, none negative, over a window of words of each text; 0 without words."""
    worst = np.zeros(texts)
    if len(weights):
        sums = np.concatenate([[0.0], np.cumsum(weights)])
        last = np.arange(1, len(weights) + 1)
        first = np.searchsorted(owner, owner)  # of the text
        np.maximum.at(worst, owner, sums[last] - sums[np.maximum(last - window, first)])
    return worst


def _scores(column: pa.Array, log_ratio: np.ndarray, toxicity: np.ndarray, window: int) -> tuple[list[float | None], list[float]]:
    """The importance and the toxicity of each text."""
    data, offsets = text_buffers(column)
    means: list[float | None] = []
    worst: list[float] = []
    for low, high in slices(offsets, SLICE):
        found, texts = features(data, offsets[low : high + 1], len(log_ratio))
        total = np.bincount(texts, log_ratio[found], high - low)
        count = np.bincount(texts, minlength=high - low)
        means += [float(t / n) if n else None for t, n in zip(total, count, strict=True)]
        words, owner = word_slots(data, offsets[low : high + 1], len(toxicity) // KINDS)
        worst += _worst(_weights(words, toxicity), owner, high - low, window).tolist()
    return means, worst


def fit(
    documents: DataFrame, labels: DataFrame, settings: Settings = Settings(),  # noqa: B008
    id_column: str = "doc_id", text_column: str = "text",
) -> Model:
    """A model from documents and labels (doc_id, quality 1 or 0, toxic).  Good texts that are not toxic are the target.
    Of contradicting labels of an id the lowest quality and the highest toxicity count.  Without good labels nothing is
    rejected, and without toxic or without clean ones nothing as toxic."""
    bounded_batches(documents.sparkSession)
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    known = stored(known, "labels")
    share = min(1.0, settings.label_rows / max(known.count(), 1))
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    is_toxic = (F.col("toxic") != 0).cast("int")
    sample = known.where(hashed < int(share * (1 << 30))).select(
        F.col("doc_id").alias("labelled"), F.when((F.col("quality") == 1) & (is_toxic == 0), 1).otherwise(0).alias("good"),
        F.when(F.col("quality") == 1, is_toxic).alias("toxic"),
    )
    sample = stored(sample, "label-sample")
    rows = documents.select(quoted(id_column).alias("id"), quoted(text_column).alias("text"))
    marked = rows.join(sample, rows["id"] == sample["labelled"], "left").select("text", "good", "toxic")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Features of all texts and of good ones in the first slots; words and beginnings in clean and toxic texts.
        totals = np.zeros((4, KINDS * settings.bins), np.int64)
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            good = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False) == 1
            toxic = batch.column(2).fill_null(-1).to_numpy(zero_copy_only=False)
            for low, high in slices(offsets, SLICE):
                found, texts = features(data, offsets[low : high + 1], settings.bins)
                totals[0, : settings.bins] += np.bincount(found, minlength=settings.bins)
                totals[1, : settings.bins] += np.bincount(found[good[low:high][texts]], minlength=settings.bins)
                if (toxic[low:high] >= 0).any():
                    words, owner = word_slots(data, offsets[low : high + 1], settings.bins)
                    kind = toxic[low:high][owner]
                    for slots in words:
                        for k in (0, 1):
                            totals[2 + k] += np.bincount(slots[(kind == k) & (slots >= 0)], minlength=totals.shape[1])
        used = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array(row[used]) for row in totals)], ["bin", "raw", "target", "clean", "toxic"]
        )

    sums = (F.sum(name).alias(name) for name in ("raw", "target", "clean", "toxic"))
    counts = marked.mapInArrow(thrifty(counted), "bin int, raw bigint, target bigint, clean bigint, toxic bigint").groupBy("bin").agg(*sums)
    found = counts.toPandas()  # at most one row for each bin of each kind
    raw, target, clean, toxic = np.zeros((4, KINDS * settings.bins))
    for values, name in ((raw, "raw"), (target, "target"), (clean, "clean"), (toxic, "toxic")):
        values[found["bin"]] = found[name]
    toxicity = _toxic_ratio(toxic, clean, settings.sure)
    if not target.sum():
        return Model(np.zeros(settings.bins), -np.inf, settings, toxicity)
    logs = [np.log((n[: settings.bins] + settings.smoothing) / (n[: settings.bins] + settings.smoothing).sum()) for n in (target, raw)]
    log_ratio = logs[0] - logs[1]
    examples = rows.join(sample, rows["id"] == sample["labelled"]).select("text", "good", "toxic")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means, worst = _scores(batch.column(0), log_ratio, toxicity, settings.toxic_window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(means, pa.float64()), pa.array(worst, pa.float64()), batch.column(1), batch.column(2)],
                ["score", "worst", "good", "toxic"],
            )

    scored = examples.mapInArrow(thrifty(judged), "score double, worst double, good int, toxic int")
    scored = scored.where("score is not null").toPandas()  # bounded by the labels
    # Toxic texts can look as good as others: each cut is learned from what it can tell apart.
    looks = scored[scored["toxic"].fillna(0) == 0]
    cut = _cut(looks["score"].to_numpy(), looks["good"].to_numpy() == 1, settings)
    told = scored[scored["toxic"].notna()]
    toxic_cut = -_cut(-told["worst"].to_numpy(), told["toxic"].to_numpy() == 0, settings)
    return Model(log_ratio, cut, settings, toxicity, toxic_cut)


def _toxic_ratio(toxic: np.ndarray, clean: np.ndarray, sure: float) -> np.ndarray:
    """For each slot the log-ratio of its frequencies in toxic and in clean texts, as far as it is surely above 0."""
    toxic, clean = toxic.reshape(KINDS, -1), clean.reshape(KINDS, -1)
    if not toxic.any() or not clean.any():
        return np.zeros(toxic.size)
    at_least, at_most = np.maximum(toxic - sure * np.sqrt(toxic), 0), clean + sure * np.sqrt(clean)
    sizes = [counts.sum(axis=1, keepdims=True) + counts.shape[1] for counts in (toxic, clean)]
    ratio = np.log((at_least + 1) / sizes[0]) - np.log((at_most + 1) / sizes[1])
    return np.where(at_least > 0, np.maximum(ratio, 0), 0.0).ravel()


def _cut(scores: np.ndarray, good: np.ndarray, settings: Settings) -> float:
    """The cut that rejects most bad texts, as a share, less the weighted share of good ones."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    values, labels = scores[order], good[order]
    lost = np.concatenate([[0], np.cumsum(labels)]) / good.sum()
    caught = np.concatenate([[0], np.cumsum(~labels)]) / (~good).sum()
    gain = np.where(lost <= settings.miss, caught - settings.loss_weight * lost, -1.0)
    gain[1:-1][values[1:] == values[:-1]] = -1.0  # no cut between equals
    at = int(np.argmax(gain))
    if at == 0:
        return -np.inf
    return float(values[-1] + 1) if at == len(values) else float((values[at - 1] + values[at]) / 2)


def _kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest key, by histograms that get finer around it."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    above, pieces = 0, 4096
    while True:
        width = (high - low) / pieces
        if not width > abs(high) * 1e-14:
            break
        piece = F.least(F.floor((F.col("key") - low) / width), F.lit(pieces - 1)).cast("int")
        inside = keys.where(F.col("key").between(low, high)).groupBy(piece.alias("piece"))
        counts = inside.agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        for row in sorted(counts.collect(), key=lambda row: -row["piece"]):  # at most 4096 rows
            if above + row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            above += row["n"]
        if low == high:
            break
    return low


def resample(
    documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row: doc_id, importance (mean log-ratio; null without a word), toxicity (of the worst window), key (importance
    over temperature plus Gumbel noise of the id and the text), selected.

    As many rows are selected as have an importance of at least the cut and are not toxic: of those that are not toxic the
    ones with the largest keys, and of equal keys at the last place all.  Null, empty and blank texts are never selected
    unless the model rejects nothing.  Repeated rows have equal keys.  An empty table gives an empty result; other columns
    are not looked at.
    """
    settings = model.settings
    bounded_batches(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast((model.log_ratio, model.toxicity))  # bounded by the number of bins

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means, worst = _scores(batch.column(2), *held.value, settings.toxic_window)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(means, pa.float64()), pa.array(worst, pa.float64())],
                ["doc_id", "text_hash", "importance", "toxicity"],
            )

    rows = documents.select(
        quoted(id_column).alias("doc_id"), F.xxhash64(quoted(text_column)).alias("text_hash"), quoted(text_column).alias("text")
    )
    kind = documents.schema[id_column].dataType.simpleString()
    scores = rows.mapInArrow(thrifty(scored), f"doc_id {kind}, text_hash bigint, importance double, toxicity double")
    uniform = (F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(settings.seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noise = -F.log(-F.log(uniform))
    keyed = stored(scores.withColumn("key", F.col("importance") / settings.temperature + noise), "importances")
    harmless = F.col("toxicity") < float(model.toxic_cut)
    if model.cut == -np.inf:
        return keyed.withColumn("selected", harmless)
    wanted = keyed.where(harmless & (F.col("importance") >= model.cut)).count()
    if not wanted:
        return keyed.withColumn("selected", F.lit(False))
    last = _kth_largest(keyed.where(harmless & F.col("key").isNotNull()).select("key"), wanted)
    return keyed.withColumn("selected", F.coalesce(harmless & (F.col("key") >= last), F.lit(False)))
