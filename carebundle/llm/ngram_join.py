"""Similarity join on word shingles by prefix filters under several global orders.

Two sets with a Jaccard similarity of at least t share a token among the first ``n - ceil(t n) + 1`` of each, under any
order of all tokens.  The first order puts rare tokens, by their hashes, before those that many sets have, so that a passage
or line which very many documents share is in almost no prefix.  Sets that meet there are candidates only if their
prefixes under two further, independent orders meet as well, and if a bitmap of the parities of all their tokens does not
show more differences than a link allows; what is left is verified on the whole sets.

A token with many sets is not expanded into all its pairs.  Each set is compared with the leader of the token, the set
with the fewest tokens before it; what the leader links is one component.  Then only pairs of different components are
compared, and neither of them is the leader.  No link between components is lost this way, and copies of one set
count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carebundle.llm.common import bounded_batches, filter_rows, filtered, quoted, slices, stored, text_buffers, thrifty
from carebundle.llm.components import components
from carebundle.llm.words import mixed, shingle_sets, word_hashes

SLICE = 1 << 19
FILTER_BITS = 1 << 26
LEAST_MARKS = 64


@dataclass(frozen=True)
class Settings:
    """Shingles of ``width`` words; a link is a similarity of at least ``percent`` hundredths.  A token in at least
    ``common`` of the windows that are counted goes to the end of the first order; this decides about effort only."""

    width: int = 5
    percent: int = 80
    common: int = 32


def _prefix(n, percent: int):
    return n - (n * percent + 99) // 100 + 1


def _head(n, percent: int):
    """Tokens by hash that are looked at first: half as many again as the prefix."""
    return _prefix(n, percent) + _prefix(n, percent) // 2



def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """The overlap that sets of these sizes need for a link."""
    return F.ceil((a + b) * percent / (100 + percent))


def _list_array(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(values) for values in arrays])])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, kind))


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Runs of rows with the sorted tokens, 63-bit hashes, of each."""
    data, offsets = text_buffers(column)
    for low, high in slices(offsets, SLICE):
        hashes, firsts = word_hashes(data, offsets[low : high + 1])
        yield low, high, [np.unique(values >> np.uint64(1)) for values in shingle_sets(hashes, firsts, width)]


def _nodes(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit signature of each set: sets are told apart by it."""
    return np.array([int(mixed(values, 3).sum(dtype=np.uint64)) ^ len(values) for values in sets], np.uint64).view(np.int64)


def signatures(documents: DataFrame, settings: Settings, id_column: str, text_column: str) -> DataFrame:
    """One row per row: id, text_hash, node (the set's signature), n (its size)."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, sets in _sets(batch.column(2), settings.width):
                own = [batch.column(k).slice(low, high - low) for k in (0, 1)]
                sizes = pa.array([len(values) for values in sets], pa.int32())
                yield pa.RecordBatch.from_arrays([*own, pa.array(_nodes(sets)), sizes], ["id", "text_hash", "node", "n"])

    text = quoted(text_column)
    rows = documents.select(quoted(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    kind = documents.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(thrifty(signed), f"id {kind}, text_hash bigint, node bigint, n int")


def _marks(values: np.ndarray) -> bytes:
    """A bitmap of as many bits as the set has tokens or up to twice as many, a power of two: each token turns one bit over.
    Two sets differ in at least as many tokens as their bitmaps, folded to one length, in bits."""
    bits = max(LEAST_MARKS, 1 << (len(values) - 1).bit_length())
    places = mixed(values, 23) & np.uint64(bits - 1)
    marks = np.zeros(bits >> 3, np.uint8)
    np.bitwise_xor.at(marks, (places >> np.uint64(3)).astype(np.int64), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
    return marks.tobytes()


def _differences(x: bytes, y: bytes) -> int:
    """The least number of tokens that two sets with these marks differ in."""
    one, other = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(other) > len(one):
        half = len(other) >> 1
        other = other[:half] ^ other[half:]
    return int(np.bitwise_count(one ^ other).sum())


def sketches(documents: DataFrame, settings: Settings, text_column: str) -> DataFrame:
    """One row per set: node, n, head (its first tokens by hash), the prefixes under the two further orders, shortened to
    32 bits, and its marks.  A task passes a set on once however many copies it reads."""
    percent = settings.percent

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, sets in _sets(batch.column(0), settings.width):
                nodes, own = _first_seen(sets, seen)
                orders = []
                for seed in (21, 22):
                    keys = [np.sort(mixed(values, seed))[: _prefix(len(values), percent)] for values in own]
                    orders.append([(key >> np.uint64(33)).astype(np.int32) for key in keys])
                yield pa.RecordBatch.from_arrays(
                    [
                        nodes,
                        pa.array([len(values) for values in own], pa.int32()),
                        _list_array([values[: _head(len(values), percent)].view(np.int64) for values in own], pa.int64()),
                        *(_list_array(order, pa.int32()) for order in orders),
                        pa.array([_marks(values) for values in own], pa.binary()),
                    ],
                    ["node", "n", "head", "second", "third", "marks"],
                )

    found = documents.select(quoted(text_column).alias("text")).mapInArrow(
        thrifty(sketched), "node bigint, n int, head array<bigint>, second array<int>, third array<int>, marks binary"
    )
    return found.dropDuplicates(["node"])


def _first_seen(sets: list[np.ndarray], seen: set[int], wanted: np.ndarray | None = None) -> tuple[pa.Array, list[np.ndarray]]:
    """The sets that have tokens, may be wanted and were not seen before, with their nodes."""
    nodes = _nodes(sets)
    ask = np.ones(len(sets), bool) if wanted is None else _held(wanted, nodes)
    keep = []
    for k, node in enumerate(nodes.tolist()):
        if ask[k] and len(sets[k]) and node not in seen:
            seen.add(node)
            keep.append(k)
    return pa.array(nodes[keep], pa.int64()), [sets[k] for k in keep]


def _bitmap(frame: DataFrame, column: str) -> np.ndarray:
    """A bitmap of hashes of 8 MB, whatever their number: a hash that it does not hold is not among them."""
    bit = F.pmod(F.col(column), F.lit(FILTER_BITS)) + 1  # these functions count from 1
    parts = frame.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )
    bitmap = np.zeros(FILTER_BITS >> 3, np.uint8)
    for row in parts.collect():  # 2048 rows at most, of 4 KB; one job, not one for each partition
        start = (row["bucket"] - 1) << 12
        bitmap[start : start + (1 << 12)] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bitmap


def _held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes % FILTER_BITS
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) == 1


def whole_sets(documents: DataFrame, nodes: DataFrame, settings: Settings, text_column: str) -> DataFrame:
    """(node, tokens) of some nodes, once each, read from the texts again.  A task passes a set on once however many
    copies it reads."""
    held = documents.sparkSession.sparkContext.broadcast(_bitmap(nodes, "node"))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, sets in _sets(batch.column(0), settings.width):
                own, tokens = _first_seen(sets, seen, held.value)
                lists = _list_array([values.view(np.int64) for values in tokens], pa.int64())
                yield pa.RecordBatch.from_arrays([own, lists], ["node", "tokens"])

    found = documents.select(quoted(text_column).alias("text")).mapInArrow(thrifty(wanted), "node bigint, tokens array<bigint>")
    return stored(found.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "whole-sets")


def _common_tokens(lists: DataFrame, column: str, settings: Settings) -> DataFrame:
    tokens = lists.select(F.explode(column).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("sets"))
    return tokens.where(F.col("sets") >= settings.common).select("token")


def _placed(lists: DataFrame, column: str, common: np.ndarray, settings: Settings, only_short: bool = False) -> DataFrame:
    """(node, n, rank, token): the prefix of each set under the first order.  A set whose list is not whole and has too few
    tokens that are not common is short: it has one row of rank -1."""
    held = lists.sparkSession.sparkContext.broadcast(common)
    percent = settings.percent

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            tokens = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            late = _held(held.value, tokens)
            early = np.bincount(owner[~late], minlength=len(sizes))
            length = _prefix(n.astype(np.int64), percent)
            short = (early < length) & (sizes < n)
            order = np.argsort(owner * 2 + late, kind="stable")  # within a list by hash, as it comes
            rank = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = (rank < length[owner]) & ~short[owner]
            if only_short:
                keep[:] = False
            lone = np.flatnonzero(short)
            row = np.concatenate([owner[keep], lone])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node[row], pa.int64()),
                    pa.array(n[row], pa.int32()),
                    pa.array(np.concatenate([rank[keep], np.full(len(lone), -1)]), pa.int32()),
                    pa.array(np.concatenate([tokens[order][keep], np.zeros(len(lone), np.int64)]), pa.int64()),
                ],
                ["node", "n", "rank", "token"],
            )

    return lists.select("node", "n", column).mapInArrow(thrifty(placed), "node bigint, n int, rank int, token bigint")


def prefixes(documents: DataFrame, nodes: DataFrame, settings: Settings, text_column: str) -> DataFrame:
    """(node, n, rank, token): the prefixes under the first order.

    The order is the same for all sets, whatever was counted: first the tokens that a bitmap of common ones does not hold,
    then those that it holds, by hash.  Common are tokens of many heads, and tokens of many whole sets among the sets
    whose heads hold too few others.
    """
    common = stored(_common_tokens(nodes, "head", settings), "common-tokens")
    first = _bitmap(common, "token")
    dense = stored(_placed(nodes, "head", first, settings, only_short=True).select("node"), "dense-sets")
    if not dense.isEmpty():
        more = _common_tokens(whole_sets(documents, dense, settings, text_column), "tokens", settings)
        first |= _bitmap(more, "token")
    placed = _placed(nodes, "head", first, settings).where("rank >= 0")
    dense = stored(_placed(nodes, "head", first, settings, only_short=True).select("node"), "short-sets")
    if dense.isEmpty():
        return placed
    lists = whole_sets(documents, dense, settings, text_column)
    lists = lists.withColumn("n", F.size("tokens"))
    return placed.unionByName(stored(_placed(lists, "tokens", first, settings), "dense-prefixes"))


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether two sets, known by size and rank of a common token, can still be linked by it: their sizes are close, and
    what stands from the token on in each suffices."""
    n_a, n_b, i, j = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.rank"), F.col(f"{b}.rank")
    enough = F.least(n_a - i, n_b - j) >= least_overlap(n_a, n_b, percent)
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent) & enough


def _links(documents: DataFrame, pairs: DataFrame, nodes: DataFrame, settings: Settings, text_column: str) -> DataFrame:
    """The pairs (a, b) that are links: both further orders and the marks first, then the whole sets."""
    # A filter that the JVM looks up lets few rows of sets without pairs through.
    bits = filter_rows(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), "node")
    orders = filtered(nodes.select("node", "n", "second", "third", "marks"), bits, F.col("node"))
    left = orders.toDF("a", "a_n", "a2", "a3", "a_marks")
    right = orders.toDF("b", "b_n", "b2", "b3", "b_marks")
    met = pairs.join(left, "a").join(right, "b").where(F.arrays_overlap("a2", "b2") & F.arrays_overlap("a3", "b3"))
    allowed = F.col("a_n") + F.col("b_n") - 2 * least_overlap(F.col("a_n"), F.col("b_n"), settings.percent)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most, x, y = (batch.column(k) for k in ("most", "a_marks", "b_marks"))
            keep = [_differences(x[row].as_py(), y[row].as_py()) <= most[row].as_py() for row in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = met.select("a", "b", allowed.alias("most"), "a_marks", "b_marks").mapInArrow(thrifty(close), "a bigint, b bigint")
    met = stored(near, "candidate-pairs")
    needed = stored(met.select(F.col("a").alias("node")).union(met.select("b")).distinct(), "candidate-nodes")
    if needed.isEmpty():
        return met
    lists = whole_sets(documents, needed, settings, text_column)
    percent = settings.percent

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = batch.column("own"), batch.column("other")
            keep = []
            for row in range(batch.num_rows):
                x, y = own[row].values.to_numpy(), other[row].values.to_numpy()
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Each leader's set meets those of all its sets: the side with the leaders is the one with the fewer rows.
    first = met.join(lists.select(F.col("node").alias("a"), F.col("tokens").alias("own")), "a")
    rows = first.join(lists.select(F.col("node").alias("b"), F.col("tokens").alias("other")), "b")
    return stored(rows.select("a", "b", "own", "other").mapInArrow(thrifty(verified), "a bigint, b bigint"), "links")


def similar_components(
    documents: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text"  # noqa: B008
) -> DataFrame:
    """One row per row: doc_id, n_shingles (size of the set of distinct shingles), component_id (the smallest id reachable
    by links, its own included), text_hash (which tells rows with the same id apart) and component (a name that no two
    components share, as they may share their smallest id; null for an empty set).

    A text with fewer words than a shingle has all its words as one.  Null, empty and blank texts have an empty set, link
    with nothing and are their own component.  Null ids are larger than any other.  Repeated rows, and rows with equal
    sets, are in one component.  An empty table gives an empty result; other columns are not looked at.
    """
    bounded_batches(documents.sparkSession)
    percent = settings.percent
    rows = stored(signatures(documents, settings, id_column, text_column), "signatures")
    nodes = stored(sketches(documents, settings, text_column), "nodes")
    placed = prefixes(documents, nodes.select("node", "n", "head"), settings, text_column)
    # Tokens of one set only link nothing.
    several = placed.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("token")
    several = stored(several, "shared-tokens")
    # A filter that the JVM looks up lets few rows of other tokens through.
    maybe = filtered(placed.select("node", "n", "rank", "token"), filter_rows(several, "token"), F.col("token"))
    rows_of = stored(maybe.join(several, "token", "left_semi"), "shared-prefixes")
    best = F.min(F.struct("rank", "node", "n")).alias("leader")
    leaders = stored(rows_of.groupBy("token").agg(best), "leaders")
    shared = rows_of.join(leaders, "token")
    own = shared.select("token", "rank", "node", "n", F.col("leader.node").alias("leader"), F.col("leader.n").alias("leader_n"), F.col("leader.rank").alias("leader_rank"))
    star = own.where("node <> leader").select(
        F.col("node").alias("a"), F.col("leader").alias("b"),
        F.struct("n", "rank").alias("x"), F.struct(F.col("leader_n").alias("n"), F.col("leader_rank").alias("rank")).alias("y"),
    ).where(_possible("x", "y", percent))
    star = stored(star.select("a", "b").distinct(), "leader-pairs")
    links = _links(documents, star, nodes, settings, text_column)
    known = stored(components(links), "first-components")
    named = own.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = known.withColumnsRenamed({"node": "leader", "component": "leader_component"})
    named = named.join(heads, "leader", "left").withColumn("leader_component", F.coalesce("leader_component", "leader"))
    named = stored(named.where("node <> leader").select("token", "rank", "node", "n", "component", "leader_component"), "named")
    apart = named.where("component <> leader_component").alias("p")
    both = apart.join(named.alias("q"), "token").where(
        (F.col("p.component") != F.col("q.component"))
        & ((F.col("q.component") == F.col("q.leader_component")) | (F.col("p.node") < F.col("q.node")))
        & _possible("p", "q", percent)
    )
    rest = stored(both.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct(), "further-pairs")
    links = links.select("a", "b").union(_links(documents, rest, nodes, settings, text_column).select("a", "b"))
    whole = components(links)
    ids = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least"))
    grouped = ids.join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = stored(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "component-names")
    by_node = stored(grouped.join(names, "component").select(F.col("node").alias("own"), "component", "component_id"), "node-components")
    joined = rows.select("id", "text_hash", "node", "n").join(by_node, (F.col("node") == F.col("own")) & (F.col("n") > 0), "left")
    return joined.select(
        F.col("id").alias("doc_id"),
        F.col("n").cast("bigint").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        "text_hash",
        "component",
    )
