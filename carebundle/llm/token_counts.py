"""Token counts of a unigram model by dynamic programming that pre-tokens share in a trie.

A text is cut at spaces; each part, with the word mark in front, is a pre-token.  The best segmentation of a pre-token has
the highest sum of piece scores, and of equal sums the fewest pieces.  Its forward score at a prefix depends on that
prefix alone, so it is computed once and every pre-token that begins with it goes on from there: the different pre-tokens
of many texts go through the trie in order, branch by branch.  Where a pre-token ends, its count is kept.

A piece that may still go on is followed through a trie of the pieces, so a character costs as many steps as pieces are
open there, not as the longest piece has characters.  Only the space cuts a text; tabs and line feeds belong to words, as
the vocabulary has it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from carebundle.llm.common import bounded_batches, quoted, slices, text_buffers

MARK = "▁"
# Bounds of what a process keeps; none changes a count.
TRIE_NODES = 300_000
SHARED_DEPTH = 64
TEXT_BATCH = 2 << 20
WORD_BLOCK = 100_000


class Trie:
    """Token counts of pre-tokens, with forward scores computed once for each prefix that pre-tokens share.

    Pre-tokens are put in by their order, which is that of a walk through their trie, so only the branch at hand is held and
    a prefix is met once for all that begin with it.  A node is (score, tokens, open): the best segmentation up to it, and
    the pieces that begin somewhere on the branch and may go on, each with the score and tokens before it.  ``counts``
    are the ends of the pre-tokens.
    """

    def __init__(self, scores: dict[str, float], byte_score: float) -> None:
        self.byte_score = byte_score
        self.pieces: dict = {}
        for piece, score in scores.items():
            place = self.pieces
            for character in piece:
                place = place.setdefault(character, {})
            place[""] = score
        self.clear()

    def clear(self) -> None:
        self.branch: list[tuple[float, int, list]] = [(0.0, 0, [])]
        self.word = ""
        self.size = 1
        self.counts: dict[str, int] = {}

    def _next(self, node: tuple[float, int, list], character: str) -> tuple[float, int, list]:
        """The node one character further on: of equal scores the segmentation with the fewest tokens."""
        score, tokens, begun = node
        first = self.pieces.get(character)
        best, count, going = -math.inf, 0, []
        if first is None or "" not in first:  # its bytes stand for it
            size = len(character.encode("utf-8", "replace"))
            best, count = score + size * self.byte_score, tokens + size
        for place, before, number in begun:
            place = place.get(character)
            if place is not None:
                going.append((place, before, number))
                own = place.get("")
                if own is not None:
                    own += before
                    if own > best or own == best and number + 1 < count:
                        best, count = own, number + 1
        if first is not None:
            going.append((first, score, tokens))
            own = first.get("")
            if own is not None:
                own += score
                if own > best or own == best and tokens + 1 < count:
                    best, count = own, tokens + 1
        self.size += 1
        return best, count, going

    def count(self, text: str) -> int:
        """The number of tokens of a pre-token.  What it shares with the one before is not computed again."""
        shared, most = 0, min(len(text), len(self.word), SHARED_DEPTH)
        while shared < most and text[shared] == self.word[shared]:
            shared += 1
        branch = self.branch
        del branch[shared + 1 :]
        node = branch[shared]
        for character in text[shared:SHARED_DEPTH]:
            node = self._next(node, character)
            branch.append(node)
        for character in text[SHARED_DEPTH:]:
            node = self._next(node, character)
        self.word = text[:SHARED_DEPTH]
        return node[1]

    def total(self, words: Sequence[str]) -> int:
        """The number of tokens of all these pre-tokens, block by block."""
        tokens = 0
        for at in range(0, len(words), WORD_BLOCK):
            block = words[at : at + WORD_BLOCK]
            self.learn(set(block))
            tokens += sum(map(self.counts.__getitem__, block))
        return tokens

    def learn(self, words: set[str]) -> None:
        """Count the pre-tokens that are about to be asked for; each different one is looked at once."""
        if len(self.counts) > TRIE_NODES:
            self.clear()
        for word in sorted(words.difference(self.counts)):
            self.counts[word] = self.count(word)


def pretokens(text: str) -> list[str]:
    return (MARK + text.replace(" ", f" {MARK}")).split(" ") if text else []


def zipf_scores(pieces: Sequence[str]) -> list[float]:
    """Log-probabilities of pieces listed by falling frequency: the probability of rank r is 1 / (r * H)."""
    total = math.log(sum(1 / rank for rank in range(1, len(pieces) + 1)))
    return [-math.log(rank) - total for rank in range(1, len(pieces) + 1)]


def read_pieces(model_path: str) -> list[str]:
    """The plain pieces of a sentencepiece model in the order of the file: tens of thousands, whatever the corpus."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = range(model.get_piece_size())
    return [
        model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))
    ]


_TRIES: dict[bytes, Trie] = {}


def _trie(pieces: tuple[str, ...], scores: tuple[float, ...], byte_score: float) -> Trie:
    """One trie per process and vocabulary, so that it outlives a task."""
    key = hashlib.sha256(repr((pieces, scores, byte_score)).encode()).digest()
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = Trie(dict(zip(pieces, scores, strict=True)), byte_score)
    return _TRIES[key]


def token_counts(
    documents: DataFrame,
    pieces: Sequence[str],
    scores: Sequence[float],
    byte_score: float | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row: doc_id, n_tokens, n_pretokens.

    A character that is no piece counts as its UTF-8 bytes, each at ``byte_score`` (the lowest score if not given).
    Null and the empty text have no tokens.  Repeated rows give repeated rows, an empty table an empty one; other
    columns are not looked at.
    """
    bounded_batches(documents.sparkSession)
    own_pieces, own_scores = tuple(pieces), tuple(scores)
    lowest = min(own_scores, default=0.0) if byte_score is None else byte_score

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(own_pieces, own_scores, lowest)
        for batch in batches:
            column = batch.column(1)
            _, offsets = text_buffers(column)
            for low, high in slices(offsets, TEXT_BATCH):
                parts = [pretokens(text or "") for text in column.slice(low, high - low).to_pylist()]
                # The words of all short texts together, those of a long one block by block.
                trie.learn(set().union(*(words for words in parts if len(words) <= WORD_BLOCK)))
                known = trie.counts.__getitem__
                short = [sum(map(known, words)) if len(words) <= WORD_BLOCK else None for words in parts]
                counts = [trie.total(words) if count is None else count for words, count in zip(parts, short, strict=True)]
                sizes = [len(words) for words in parts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                    ["doc_id", "n_tokens", "n_pretokens"],
                )

    rows = documents.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    kind = documents.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(counted, f"doc_id {kind}, n_tokens bigint, n_pretokens bigint")
