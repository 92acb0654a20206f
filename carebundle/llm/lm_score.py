"""Language-model scores by deleted interpolation of bigrams, unigrams and a uniform distribution.

Tokens are the words of a text and one end; the first word's context is the start.  The probability of a token mixes its
maximum-likelihood estimates given the word before and alone with a uniform share, by weights that depend on how often
the context was seen (a bucket for each power of two).  The weights are learned by expectation-maximisation on the counts
of training texts that are held out of the counts the estimates come from; scores then use the counts of all
training texts.

Texts are dealt into batches of some megabytes by a hash.  A batch sends its distinct n-grams, sorted and packed, to
blocks of the hash range; a block adds up what all batches sent and replies to each with the corpus counts of its n-grams.
A batch then scores its texts with the counts that came back.  So every n-gram of the corpus is counted, a frequent one
travels once for each batch, and neither a block nor a batch grows with the corpus.  Words are told apart by 64-bit
hashes, pairs of words by 56 bits, which sorted and as differences pack into less than five bytes each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import quoted, slices, stored, text_buffers
from carebundle.llm.words import mixed, word_hashes

SLICE = 1 << 19
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
BUCKETS = 24
# Steps in which ratios are rounded for the weights: quarters of a power of two.
STEPS, MOST = 4, 160


@dataclass(frozen=True)
class Settings:
    """One in ``held_out_batches`` batches gives the held-out counts; there are at least that many batches.  A block adds up
    the n-grams that about ``block_bytes`` of text hold."""

    batch_bytes: int = 4 << 20
    block_bytes: int = 16 << 20
    held_out_batches: int = 16
    iterations: int = 40


@dataclass(frozen=True)
class Corpus:
    tokens: int
    types: int


@dataclass(frozen=True)
class NGrams:
    """The tokens of a batch and the n-grams they are in."""

    unigrams: np.ndarray  # distinct hashes, sorted
    bigrams: np.ndarray
    word: np.ndarray  # for each token its place in `unigrams`
    context: np.ndarray  # the place of the word before; that of the end stands for the start, which is as frequent
    pair: np.ndarray  # its place in `bigrams`
    owner: np.ndarray  # the text of each token


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in few bytes: those that rise as differences."""
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(item: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(item.as_buffer()), kind)


def n_grams(column: pa.Array) -> NGrams:
    data, offsets = text_buffers(column)
    hashes, counts = [], []
    for low, high in slices(offsets, SLICE):
        found, firsts = word_hashes(data, offsets[low : high + 1])
        hashes.append(found)
        counts.append(np.diff(firsts))
    words, sizes = np.concatenate(hashes), np.concatenate(counts)
    ends = np.cumsum(sizes + 1) - 1
    tokens = np.empty(len(words) + len(sizes), np.uint64)
    inside = np.ones(len(tokens), bool)
    inside[ends] = False
    tokens[inside], tokens[ends] = words, END
    before = np.empty(len(tokens), np.uint64)
    before[1:] = tokens[:-1]
    starts = np.concatenate([[0], ends[:-1] + 1])
    before[starts] = START
    pairs, pair = np.unique(mixed(before * np.uint64(0xD1342543DE82EF95) + tokens, 1) & ~np.uint64(0xFF), return_inverse=True)
    unigrams, word = np.unique(tokens, return_inverse=True)
    context = np.empty(len(tokens), np.int64)
    context[1:] = word[:-1]
    context[starts] = np.searchsorted(unigrams, END)
    return NGrams(unigrams, pairs, word, context, pair, np.repeat(np.arange(len(sizes)), sizes + 1))


def _column(rows: pa.Table, name: str) -> pa.Array:
    column = rows.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _flags(rows: pa.Table, name: str) -> np.ndarray:
    return _column(rows, name).to_numpy(zero_copy_only=False).astype(bool)


def _cuts(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """Where the blocks of the hash range begin and end in sorted hashes."""
    edges = np.array([(block << 64) // blocks for block in range(1, blocks)], np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


_MESSAGE = "batch bigint, size int, block int, hashes binary, training binary, held_out binary"


def _messages(blocks: int):
    def sent(rows: pa.Table) -> pa.Table:
        found = n_grams(_column(rows, "text"))
        training = _flags(rows, "training")[found.owner]
        held_out = training & _flags(rows, "fold")[found.owner]
        batch, columns = rows.column("batch")[0].as_py(), [[], [], [], [], [], []]
        for size, hashes, place in ((1, found.unigrams, found.word), (2, found.bigrams, found.pair)):
            counts = np.bincount(place[training], minlength=len(hashes))
            held = np.bincount(place[held_out], minlength=len(hashes)) if held_out.any() else None
            cuts = _cuts(hashes, blocks)
            for block in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[block], cuts[block + 1])
                steps = np.diff(hashes[part], prepend=np.uint64(0)) >> np.uint64(0 if size == 1 else 8)
                values = (
                    batch, size, block, _packed(steps), _packed(counts[part]), None if held is None else _packed(held[part])
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        names = ["batch", "size", "block", "hashes", "training", "held_out"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return sent


_REPLY = "batch bigint, size int, block int, training binary, held_out binary, tokens bigint, types bigint"


def _replies(held_out_batches: int):
    def replied(rows: pa.Table) -> pa.Table:
        """The sums of one block and size, for each batch that asked; one row (batch -1) has the block's totals."""
        asked = [np.cumsum(_unpacked(item, np.uint64), dtype=np.uint64) for item in _column(rows, "hashes")]
        bounds = np.concatenate([[0], np.cumsum([len(item) for item in asked])])
        hashes, place = np.unique(np.concatenate(asked), return_inverse=True)
        sums = []
        for name in ("training", "held_out"):
            total = np.zeros(len(hashes), np.int64)
            for k, item in enumerate(_column(rows, name)):
                if item.is_valid:  # a batch asks for an n-gram once
                    total[place[bounds[k] : bounds[k + 1]]] += _unpacked(item, np.int64)
            sums.append(total)
        batches = rows.column("batch").to_pylist()
        size, block = rows.column("size")[0].as_py(), rows.column("block")[0].as_py()
        packed: list[list[bytes | None]] = [[], []]
        for k, batch in enumerate(batches):
            own = place[bounds[k] : bounds[k + 1]]
            packed[0].append(_packed(sums[0][own]))
            packed[1].append(_packed(sums[1][own]) if batch % held_out_batches == 0 else None)
        count = len(batches)
        totals = (int(sums[0].sum()), int((sums[0] > 0).sum())) if size == 1 else (0, 0)
        return pa.Table.from_arrays(
            [
                pa.array([*batches, -1], pa.int64()),
                pa.array([size] * (count + 1), pa.int32()),
                pa.array([block] * (count + 1), pa.int32()),
                pa.array([*packed[0], None], pa.binary()),
                pa.array([*packed[1], None], pa.binary()),
                pa.array([0] * count + [totals[0]], pa.int64()),
                pa.array([0] * count + [totals[1]], pa.int64()),
            ],
            names=["batch", "size", "block", "training", "held_out", "tokens", "types"],
        )

    return replied


def _counts(replies: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Unigram and bigram counts of a batch, in the order of its sorted hashes."""
    both = []
    for size in (1, 2):
        own = [
            (block, item)
            for block, kind, item in zip(
                replies.column("block").to_pylist(), replies.column("size").to_pylist(), _column(replies, name), strict=True
            )
            if kind == size and item.is_valid
        ]
        own.sort(key=lambda pair: pair[0])
        both.append(np.concatenate([_unpacked(item, np.int64) for _, item in own]) if own else np.zeros(0, np.int64))
    return both[0], both[1]


def _bucket(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(counts.astype(float))[1], BUCKETS - 1)


def _ratios(found: NGrams, unigrams: np.ndarray, bigrams: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token the bucket of its context and its two maximum-likelihood estimates."""
    contexts = unigrams[found.context]
    second = bigrams[found.pair] / np.maximum(contexts, 1)
    return _bucket(contexts), second, unigrams[found.word] / max(tokens, 1)


def _step(ratio: np.ndarray) -> np.ndarray:
    """A ratio in rounded steps; the last one is zero."""
    with np.errstate(divide="ignore"):
        steps = np.rint(-STEPS * np.log2(ratio))
    return np.where(ratio > 0, np.minimum(steps, MOST - 1), MOST).astype(np.int64)


def _held_out_cells(corpus: Corpus, held_out_tokens: int):
    def cells(rows: pa.Table, replies: pa.Table) -> pa.Table:
        code = np.zeros(0, np.int64)
        if rows.num_rows and replies.num_rows:
            found = n_grams(_column(rows, "text"))
            wanted = _flags(rows, "fold")[found.owner]
            counts = [a - b for a, b in zip(_counts(replies, "training"), _counts(replies, "held_out"), strict=True)]
            bucket, second, first = _ratios(found, counts[0], counts[1], corpus.tokens - held_out_tokens)
            code = ((bucket * (MOST + 1) + _step(second)) * (MOST + 1) + _step(first))[wanted]
        values, n = np.unique(code, return_counts=True)
        return pa.Table.from_arrays([pa.array(values, pa.int64()), pa.array(n, pa.int64())], names=["cell", "n"])

    return cells


def learn_weights(cells: np.ndarray, counts: np.ndarray, corpus: Corpus, iterations: int) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) of each bucket by expectation-maximisation on held-out counts."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    bucket, rest = np.divmod(cells, (MOST + 1) ** 2)
    steps = np.divmod(rest, MOST + 1)
    second, first = (np.where(step < MOST, 2.0 ** (-step / STEPS), 0.0) for step in steps)
    parts = np.stack([second, first, np.full(len(cells), 1 / (corpus.types + 1))], axis=1)
    for _ in range(iterations):
        joint = weights[bucket] * parts
        share = joint / joint.sum(axis=1, keepdims=True) * counts[:, None]
        total = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], axis=1) + 1e-3
        weights = total / total.sum(axis=1, keepdims=True)
    weights[0] = [0, *(weights[0][1:] / weights[0][1:].sum())]  # an unseen context says nothing
    return weights


def _scorer(corpus: Corpus, weights: np.ndarray):
    def scored(rows: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        found = n_grams(_column(rows, "text")) if rows.num_rows else None
        if found is None:
            kinds = [rows.schema.field("id").type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            return pa.Table.from_arrays([pa.array([], kind) for kind in kinds], names=names)
        unigrams, bigrams = _counts(replies, "training")
        known = unigrams[found.word]
        base = np.log10((known + 0.5) / (corpus.tokens + 0.5 * (corpus.types + 1)))
        bucket, second, first = _ratios(found, unigrams, bigrams, corpus.tokens)
        mix = weights[bucket]
        model = np.log10(mix[:, 0] * second + mix[:, 1] * first + mix[:, 2] / (corpus.types + 1))
        count = rows.num_rows
        sums = [np.bincount(found.owner, values, count) for values in (known > 0, base, model)]
        tokens = np.bincount(found.owner, minlength=count)
        return pa.Table.from_arrays(
            [
                _column(rows, "id"),
                pa.array(~_flags(rows, "training")),
                pa.array(tokens, pa.int64()),
                pa.array(sums[0].astype(np.int64)),
                pa.array(sums[1]),
                pa.array(sums[2]),
            ],
            names=names,
        )

    return scored


def lm_scores(
    documents: DataFrame, training: Column, settings: Settings = Settings(),  # noqa: B008
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per row: doc_id, held_out (not ``training``; null counts as held out), n_tokens, n_known (tokens that
    training texts hold), train_tokens, base_score (unigrams with add-half smoothing) and score, both log10.

    Null and empty texts are one end.  Without training texts every probability is uniform over an empty vocabulary.
    Repeated rows give repeated rows and count as often; an empty table gives an empty result; other columns are not
    looked at.
    """
    text = quoted(text_column)
    size = documents.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) + F.count(F.lit(1))).first()[0]
    every = settings.held_out_batches
    batches = max(every, -(-size // settings.batch_bytes))
    blocks = max(1, -(-size // settings.block_bytes))
    rows = documents.select(
        quoted(id_column).alias("id"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.coalesce(training, F.lit(False)).alias("training"),
        F.pmod(F.xxhash64(quoted(id_column), text), F.lit(batches)).alias("batch"),
    ).withColumn("fold", F.col("training") & (F.col("batch") % every == 0))
    messages = rows.groupBy("batch").applyInArrow(_messages(int(blocks)), _MESSAGE)
    replies = stored(messages.groupBy("size", "block").applyInArrow(_replies(every), _REPLY), "n-gram-counts")
    totals = replies.where("batch = -1").agg(F.sum("tokens"), F.sum("types")).first()
    corpus = Corpus(totals[0] or 0, totals[1] or 0)
    replies = replies.where("batch >= 0").select("batch", "size", "block", "training", "held_out")
    fold_rows, fold_replies = rows.where(F.col("batch") % every == 0), replies.where(F.col("batch") % every == 0)
    fold_tokens = fold_rows.where("fold").select(
        F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")) + 1
    )
    held_out_tokens = fold_tokens.groupBy().sum().first()[0] or 0
    cells = fold_rows.groupBy("batch").cogroup(fold_replies.groupBy("batch")).applyInArrow(
        _held_out_cells(corpus, held_out_tokens), "cell bigint, n bigint"
    )
    # At most one row for each bucket and pair of rounded ratios.
    found = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    weights = learn_weights(found["cell"].to_numpy(np.int64), found["n"].to_numpy(float), corpus, settings.iterations)
    kind = documents.schema[id_column].dataType.simpleString()
    scores = rows.groupBy("batch").cogroup(replies.select("batch", "size", "block", "training").groupBy("batch")).applyInArrow(
        _scorer(corpus, weights),
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return scores.withColumn("train_tokens", F.lit(corpus.tokens).cast("bigint"))
