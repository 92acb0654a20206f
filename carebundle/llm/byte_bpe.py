"""Byte-level BPE by a hierarchical-bitmap rank queue.

Every adjacent pair of parts that is a token waits in the bucket of its rank, as the position of its first byte.  Three
levels of 64-bit words say which buckets hold something; find-first-set on each level gives the lowest rank.  A position
whose pair has changed meanwhile is stale and skipped.  Parts form a linked list, so a merge touches two neighbours
however long the pre-token is: the cost is O(n log n) for n bytes.

One queue serves many short pre-tokens at once: they lie behind each other with barriers between them, and all positions
of a rank are merged in one vectorised step.  A long pre-token has a queue of its own, and so has a pre-token where a
merge made a pair of a lower rank than the one at hand, because there the order within the pre-token matters.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import quoted, slices, text_buffers, thrifty

# White space of the pattern in the sense of Unicode, which `regex` alone would widen by \x1c-\x1f.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Where this is found, a space may belong to more white space and not to the word behind it.
_ODD = re.compile(r"\s | \s|\A\s|\s\Z")
CACHE_ENTRIES = 250_000
LONG_BYTES = 256
BLOCK = 1 << 16
TEXT_BATCH = 2 << 20


class BitmapQueue:
    """Buckets by rank under three levels of bitmaps."""

    def __init__(self, ranks: int) -> None:
        words = (ranks + 63) // 64 + 1
        self.low, self.middle, self.top = [0] * words, [0] * (words // 64 + 1), 0
        self.buckets: dict[int, list] = {}

    def bucket(self, rank: int) -> list:
        """The bucket of a rank, marked as holding something."""
        if rank not in self.buckets:
            self.buckets[rank] = []
            word = rank >> 6
            self.low[word] |= 1 << (rank & 63)
            self.middle[word >> 6] |= 1 << (word & 63)
            self.top |= 1 << (word >> 6)
        return self.buckets[rank]

    def first(self) -> int:
        """The lowest rank that holds something, found by the lowest set bit of each level."""
        high = (self.top & -self.top).bit_length() - 1
        bits = self.middle[high]
        word = high << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def drop(self, rank: int) -> list:
        """Take out a bucket and clear its bits."""
        word = rank >> 6
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.middle[word >> 6] &= ~(1 << (word & 63))
            if not self.middle[word >> 6]:
                self.top &= ~(1 << (word >> 6))
        return self.buckets.pop(rank)


def cuts_at_spaces(pattern: str) -> bool:
    """Whether a space between two characters that are no white space always begins a match of a pattern: each of its
    alternatives has a space at most in front, as one that may be left out, or is white space only.  Patterns of any other
    form count as not having this property."""
    own = re.compile(r"(?: \?)?(?:'\w+|\\p\{\w+\}\+|\[\^\\s(?:\\p\{\w+\})*\]\+)")
    return all(part in (r"\s+(?!\S)", r"\s+") or own.fullmatch(part) for part in pattern.split("|"))


class Encoder:
    """Encodes and decodes by the ranks of tokens; keeps the ids of words it has met, up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.size = max(ranks.values(), default=-1) + 1
        self.tokens = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        explicit = pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"\s", f"[{_WHITE}]").replace(r"\S", f"[^{_WHITE}]")
        self.pattern = regex.compile(explicit)
        self.by_words = cuts_at_spaces(pattern)
        self.byte_ids = np.array([ranks[bytes([byte])] for byte in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[key] for key in self.pair_keys.tolist()], np.int64)
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; -1 where the pair is no token or one side is not an id."""
        keys = left * self.size + right
        keys[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def merged(self, data: bytes) -> list[int]:
        """The ids of one pre-token, by a queue of its own."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, rank_of, queue = len(data), self.ranks.get, BitmapQueue(self.size)
        after, before, current = list(range(1, n + 2)), list(range(-1, n)), [-1] * (n + 1)
        fresh = [(i, data[i : i + 2]) for i in range(n - 1)]
        while True:
            for i, pair in fresh:
                current[i] = rank_of(pair, -1)
                if current[i] >= 0:
                    heappush(queue.bucket(current[i]), i)
            fresh = []
            if not queue.top:
                break
            rank = queue.first()
            i = heappop(queue.buckets[rank])
            if not queue.buckets[rank]:
                queue.drop(rank)
            if current[i] != rank:
                continue
            gone = after[i]
            after[i] = end = after[gone]
            current[gone] = current[i] = -1
            if end < n:
                before[end] = i
                fresh.append((i, data[i : after[end]]))
            if i:
                fresh.append((before[i], data[before[i] : end]))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[data[i : after[i]]])
            i = after[i]
        return ids

    def merged_together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One queue for many pre-tokens: all ids, where those of each pre-token end, and the pre-tokens to repeat alone."""
        data = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)
        barriers = np.concatenate([[0], np.cumsum([len(piece) + 1 for piece in pieces])])
        ids = self.byte_ids[data]
        ids[barriers] = -1
        after, before = np.arange(1, len(ids) + 1), np.arange(-1, len(ids) - 1)
        current = np.append(self._pairs(ids[:-1], ids[1:]), -1)
        queue, again = BitmapQueue(self.size), []

        def push(positions: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist(), len(ranks)]
            for rank, low, high in zip(ranks[starts[:-1]].tolist(), starts, starts[1:], strict=False):
                queue.bucket(rank).append(positions[low:high])

        waiting = np.flatnonzero(current >= 0)
        if len(waiting):
            push(waiting, current[waiting])
        while queue.top:
            rank = queue.first()
            held = queue.drop(rank)
            at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            at = at[current[at] == rank]
            if not len(at):
                continue
            gone = after[at]
            overlaps = np.flatnonzero(gone[:-1] == at[1:]) + 1
            if len(overlaps):  # as in "aaa": the left one of two goes first
                keep = np.ones(len(at), bool)
                for j in overlaps.tolist():
                    keep[j] = not keep[j - 1]
                at, gone = at[keep], gone[keep]
            end = after[gone]
            ids[at], ids[gone], current[gone] = rank, -2, -1
            after[at], before[end] = end, at
            left = before[at]
            right_ranks = self._pairs(ids[at], ids[end])
            left_ranks = self._pairs(ids[left], ids[at])
            current[at], current[left] = right_ranks, left_ranks
            positions = np.concatenate([at[right_ranks >= 0], left[left_ranks >= 0]])
            if len(positions):
                ranks = current[positions]
                if ranks.min() < rank:
                    again.append(positions[ranks < rank])
                push(positions, ranks)
        alive = np.flatnonzero(ids >= 0)
        repeat = np.unique(np.searchsorted(barriers, np.concatenate(again)) - 1) if again else np.zeros(0, np.int64)
        return ids[alive].astype("<u4"), np.searchsorted(alive, barriers[1:]), repeat

    def _learn_pieces(self, pieces: Iterable[str]) -> None:
        short = []
        for piece in pieces:
            data = piece.encode("utf-8", "replace")
            whole = self.ranks.get(data)
            if whole is not None:
                self.pieces[piece] = whole.to_bytes(4, "little")
            elif len(data) < LONG_BYTES:
                short.append((piece, data))
            else:
                self.pieces[piece] = np.array(self.merged(data), "<u4").tobytes()
        if not short:
            return
        ids, ends, repeat = self.merged_together([data for _, data in short])
        packed, low = ids.tobytes(), 0
        for (piece, _), high in zip(short, (ends * 4).tolist(), strict=True):
            self.pieces[piece] = packed[low:high]
            low = high
        for k in repeat.tolist():
            self.pieces[short[k][0]] = np.array(self.merged(short[k][1]), "<u4").tobytes()

    def _long(self, text: str) -> bytes:
        """The ids of a text in blocks of pre-tokens."""
        pieces, blocks = (match.group() for match in self.pattern.finditer(text)), []
        while block := list(islice(pieces, BLOCK)):
            self._learn_pieces(set(block) - self.pieces.keys())
            blocks.append(b"".join(map(self.pieces.__getitem__, block)))
        return b"".join(blocks)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian 32-bit.

        Before a space with no white space on either side always begins a pre-token, so what lies between such spaces is
        looked up as one word.  Texts with other spaces, and those of a pattern for which this may not be so, are cut by the
        pattern alone."""
        if len(self.words) + len(self.pieces) > CACHE_ENTRIES:
            self.words.clear()
            self.pieces.clear()
        plain = [None if not self.by_words or _ODD.search(text) else text.split(" ") for text in texts]
        unknown: set[str] = set()
        for words in plain:
            if words is not None:
                unknown.update(words[1:])
        unknown -= self.words.keys()
        cut = {word: self.pattern.findall(" " + word) for word in unknown}
        heads = [[] if words is None else self.pattern.findall(words[0]) for words in plain]
        pieces = {piece for found in cut.values() for piece in found}
        pieces.update(piece for found in heads for piece in found)
        self._learn_pieces(pieces - self.pieces.keys())
        piece, word = self.pieces.__getitem__, self.words.__getitem__
        for text, found in cut.items():
            self.words[text] = b"".join(map(piece, found))
        return [
            self._long(text) if words is None else b"".join([*map(piece, head), *map(word, islice(words, 1, None))])
            for text, words, head in zip(texts, plain, heads, strict=True)
        ]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[tuple[bytes, str], Encoder] = {}


def encoder(raw: bytes, pattern: str) -> Encoder:
    """One encoder per process for the content of a rank file, so that what it has met outlives a task."""
    key = (hashlib.sha256(raw).digest(), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}
        _ENCODERS[key] = Encoder(ranks, pattern)
    return _ENCODERS[key]


def read_ranks(path: str) -> bytes:
    """A rank file: under a megabyte, whatever the size of the corpus."""
    with open(path, "rb") as file:
        return file.read()


def _coder(raw: bytes, pattern: str, decode: bool, batch_bytes: int):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(raw, pattern)
        for batch in batches:
            column = batch.column(1)
            _, offsets = text_buffers(column)
            for low, high in slices(offsets, batch_bytes):
                ids = own.encode([text or "" for text in column.slice(low, high - low).to_pylist()])
                columns = [batch.column(0).slice(low, high - low), pa.array(ids, pa.binary())]
                if decode:
                    columns.append(pa.array(map(own.decode, ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    return coded


def encode(
    documents: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
    decode: bool = False, batch_bytes: int = TEXT_BATCH,
) -> DataFrame:
    """One row per row: its id, ``ids`` (the token ids as little-endian unsigned 32-bit integers) and, with ``decode``,
    ``decoded`` (the bytes those ids stand for).

    Every match of the pattern is encoded by itself, without special tokens.  About ``batch_bytes`` of texts are encoded
    together: more take less time, fewer less memory.  Null and the empty text have no ids.
    Repeated rows give repeated rows, an empty table an empty one; other columns are not looked at.
    """
    rows = documents.select(quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"))
    kind = documents.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary" + ", decoded binary" * decode
    return rows.mapInArrow(thrifty(_coder(read_ranks(ranks_path), pattern, decode, batch_bytes)), schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """One row per row: its id and ``decoded``, the bytes of its ``ids``; null ids decode to nothing.  An id that the
    rank file does not have is an error."""
    raw = read_ranks(ranks_path)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(raw, pattern)
        for batch in batches:
            back = [own.decode(ids.as_py() or b"") for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(back, pa.binary())], ["doc_id", "decoded"])

    kind = encoded.schema[id_column].dataType.simpleString()
    rows = encoded.select(quoted(id_column).alias("doc_id"), F.col("ids"))
    return rows.mapInArrow(thrifty(decoded), f"doc_id {kind}, decoded binary")


def digests(coded: DataFrame) -> DataFrame:
    """Counts and digests of what :func:`encode` with ``decode`` returns."""
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
