"""Language identification: script ranges narrow the candidates, Viterbi over words labels spans.

A word, a run of letters, scores for each language the sum of the log-probabilities of its character n-grams, hashed into
a fixed number of bins.  The script of its first letter decides which languages it may be of: those that write at
least a hundredth of their letters in it.  The best path through the words of a text pays a penalty for each change
of language; runs of one language are its spans, and the language with most letters in spans is that of the text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import quoted, slices, text_buffers
from carebundle.llm.words import mixed

# Code point ranges of scripts (first, last).
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
UNDECIDED = "und"
MIN_SCRIPT_SHARE = 0.01
SCORE_CHARS = 1 << 20
PATH_BYTES = 16 << 20


@dataclass(frozen=True)
class Settings:
    """``train_rows`` bounds the labelled texts the model is fitted on: of more rows, those with the smallest hashes of
    their ids."""

    bins: int = 1 << 16
    orders: tuple[int, ...] = (1, 2, 3, 4)
    smoothing: float = 0.5
    switch_penalty: float = 8.0
    train_rows: int = 20_000


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # bins x languages, log-probabilities
    allowed: np.ndarray  # scripts x languages
    prior: np.ndarray
    settings: Settings


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower case if it is a letter, else 0; and the number of its script, 0 for others."""
    lower = np.zeros(0x110000, np.uint32)
    for point in range(0x323B0):
        character = chr(point)
        if unicodedata.category(character)[0] == "L":
            small = character.lower()
            lower[point] = ord(small) if len(small) == 1 else point
    script = np.zeros(0x110000, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            script[first : last + 1] = number
    return lower, script


def _words(points: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters (0 for others), scripts, and starts and ends of words; none goes over a break."""
    lower, script = _characters()
    letters = lower[points]
    is_letter = letters > 0
    starts, ends = is_letter.copy(), is_letter.copy()
    starts[1:] &= ~is_letter[:-1]
    ends[:-1] &= ~is_letter[1:]
    inner = breaks[(breaks > 0) & (breaks < len(points))]
    starts[inner] = is_letter[inner]
    ends[inner - 1] = is_letter[inner - 1]
    return letters, script[points], np.flatnonzero(starts), np.flatnonzero(ends) + 1


def _bins(letters: np.ndarray, position: np.ndarray, order: int, bins: int) -> np.ndarray:
    """The bin of the n-gram that ends at each letter; an n-gram longer than the word so far is padded in front."""
    code = np.zeros(len(letters), np.uint64)
    for back in range(order - 1, -1, -1):
        shifted = np.zeros(len(letters), np.uint64)
        shifted[back:] = letters[: len(letters) - back]
        shifted[position < back] = 1
        code = code * np.uint64(0x110001) + shifted
    return (mixed(code, order) >> np.uint64(40)).astype(np.int64) % bins


def _points(text_bytes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts, and where each text begins in them."""
    data = text_bytes[offsets[0] : offsets[-1]]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    leading = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, leading[offsets - offsets[0]]


def _positions(points: int, starts: np.ndarray) -> np.ndarray:
    """The distance of each character from the start of its word (from the last start, outside of words)."""
    last = np.zeros(points, np.int64)
    last[starts] = starts
    return np.arange(points) - np.maximum.accumulate(last)


def train(labelled: DataFrame, settings: Settings = Settings()) -> Model:  # noqa: B008
    """A model from rows (id, text, lang) with no null language.  What comes to the driver is bounded by bins, scripts and
    languages.  Without rows, or without letters, the model has no language."""
    count = labelled.count()
    share = min(1.0, settings.train_rows / max(count, 1))
    limit = int(share * (1 << 30))
    sample = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < limit).select("text", "lang")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        slots = settings.bins + len(SCRIPTS) + 1
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            languages = batch.column(1).to_pylist()
            for row in range(len(languages)):
                for low in range(int(offsets[row]), max(int(offsets[row + 1]), int(offsets[row]) + 1), 4 * SCORE_CHARS):
                    high = min(low + 4 * SCORE_CHARS, int(offsets[row + 1]))
                    points, _ = _points(data, np.array([low, high]))
                    letters, scripts, starts, _ = _words(points, np.zeros(0, np.int64))
                    total = totals.setdefault(languages[row], np.zeros(slots, np.int64))
                    position, is_letter = _positions(len(points), starts), letters > 0
                    for order in settings.orders:
                        total[: settings.bins] += np.bincount(
                            _bins(letters, position, order, settings.bins)[is_letter], minlength=settings.bins
                        )
                    total[settings.bins :] += np.bincount(scripts[is_letter], minlength=len(SCRIPTS) + 1)
        for language, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(used)), pa.array(used, pa.int32()), pa.array(total[used], pa.int64())],
                ["lang", "slot", "n"],
            )

    counts = sample.mapInArrow(counted, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    rows = counts.toPandas()
    languages = tuple(sorted(rows["lang"].unique()))
    totals = np.zeros((settings.bins + len(SCRIPTS) + 1, len(languages)))
    totals[rows["slot"].to_numpy(), rows["lang"].map(languages.index).to_numpy(int)] = rows["n"].to_numpy()
    grams, scripts = totals[: settings.bins], totals[settings.bins :]
    smoothed = grams + settings.smoothing
    letters = scripts.sum(axis=0)
    return Model(
        languages,
        np.log(smoothed / smoothed.sum(axis=0, keepdims=True)).astype(np.float32),
        scripts >= MIN_SCRIPT_SHARE * letters,
        np.log((letters + 1) / (letters + 1).sum()).astype(np.float32) if len(languages) else np.zeros(0, np.float32),
        settings,
    )


def _word_scores(model: Model, points: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of words for each language, and where the words start and end."""
    letters, scripts, starts, ends = _words(points, breaks)
    if not len(starts):
        return np.zeros((0, len(model.languages)), np.float32), starts, ends
    position = _positions(len(points), starts)
    at = np.flatnonzero(letters)
    total = np.zeros((len(at), len(model.languages)), np.float32)
    for order in model.settings.orders:
        total += model.scores[_bins(letters, position, order, model.settings.bins)[at]]
    words = np.add.reduceat(total, np.searchsorted(at, starts), axis=0)
    allowed = model.allowed[scripts[starts]]
    allowed[~allowed.any(axis=1)] = True
    return np.where(allowed, words, words.min(axis=1, keepdims=True) - np.float32(50)), starts, ends


def _viterbi(scores: np.ndarray, firsts: np.ndarray, prior: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word; texts go side by side, the longest first, so a step takes all that are as long."""
    lengths = np.diff(firsts)
    order = np.argsort(-lengths, kind="stable")
    heads, sizes = firsts[:-1][order], lengths[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), "left")
    labels = np.zeros(len(scores), np.int32)
    if not longest:
        return labels
    stay = np.zeros(scores.shape, bool)
    switch = np.zeros(len(scores), np.int32)
    best = prior + scores[heads[: active[0]]]
    finals = np.zeros((len(sizes), scores.shape[1]), np.float32)
    for step in range(1, longest):
        n = active[step]
        finals[n : len(best)] = best[n:]
        best = best[:n]
        at = heads[:n] + step
        top = best.argmax(axis=1)
        changed = best[np.arange(n), top][:, None] - penalty
        kept = best >= changed
        stay[at], switch[at] = kept, top
        best = np.where(kept, best, changed) + scores[at]
    finals[: len(best)] = best
    label = finals.argmax(axis=1)
    for step in range(longest - 1, -1, -1):
        n = active[step]
        at = heads[:n] + step
        labels[at] = label[:n]
        if step:
            label[:n] = np.where(stay[at, label[:n]], label[:n], switch[at])
    return labels


def _label_texts(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[list, list, pa.Array]:
    """Language, score and spans of each text."""
    scores, word_text, starts, ends = [], [], [], []
    for low, high in slices(offsets, SCORE_CHARS):
        points, firsts = _points(data, offsets[low : high + 1])
        found, begin, end = _word_scores(model, points, firsts)
        owner = np.searchsorted(firsts, begin, "right") - 1
        scores.append(found)
        word_text.append(owner + low)
        starts.append(begin - firsts[owner])
        ends.append(end - firsts[owner])
    texts = len(offsets) - 1
    scores, owners = np.concatenate(scores), np.concatenate(word_text)
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    firsts = np.searchsorted(owners, np.arange(texts + 1))
    labels = _viterbi(scores, firsts, model.prior, np.float32(model.settings.switch_penalty))
    share = np.zeros((texts, len(model.languages)))
    np.add.at(share, (owners, labels), ends - starts)
    total = share.sum(axis=1)
    winner = share.argmax(axis=1)
    best = share[np.arange(texts), winner] / np.maximum(total, 1)
    languages = [model.languages[w] if t else UNDECIDED for w, t in zip(winner.tolist(), total.tolist(), strict=True)]
    new = np.ones(len(labels), bool)
    new[1:] = (labels[1:] != labels[:-1]) | (owners[1:] != owners[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(labels)) - 1
    names = pa.array(np.array(model.languages, object)[labels[first]] if len(first) else [], pa.string())
    spans = pa.StructArray.from_arrays(
        [pa.array(starts[first], pa.int64()), pa.array(ends[last] if len(first) else [], pa.int64()), names],
        names=["start", "end", "lang"],
    )
    bounds = np.searchsorted(owners[first], np.arange(texts + 1))
    return languages, np.where(total > 0, best, 0.0).tolist(), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)


def predict(documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row: doc_id, lang_pred, score (share of the text's letters in spans of that language) and spans
    (start and end in code points, lang).

    Null and texts without a letter are ``und`` with score 0 and no spans, and so is every text under a model without
    languages.  Of equal languages the first by name wins.  Repeated rows give repeated rows, an empty table an empty one;
    other columns are not looked at.
    """
    spark = documents.sparkSession
    held = spark.sparkContext.broadcast(model)  # bounded by bins and languages

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for low, high in slices(offsets, PATH_BYTES):
                if own.languages:
                    languages, scores, spans = _label_texts(own, data, offsets[low : high + 1])
                else:
                    languages, scores = [UNDECIDED] * (high - low), [0.0] * (high - low)
                    spans = pa.array([[]] * (high - low), pa.list_(SPAN))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(languages), pa.array(scores, pa.float64()), spans],
                    ["doc_id", "lang_pred", "score", "spans"],
                )

    rows = documents.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    kind = documents.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(
        predicted,
        f"doc_id {kind}, lang_pred string, score double, spans array<struct<start:bigint,`end`:bigint,lang:string>>",
    )


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])


def fold(id_column: Column, folds: int) -> Column:
    """The fold of a row by the CRC of its id as text."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds
