import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from carebundle.llm import exact_dedup, ngram_join
from carebundle.llm.components import components

WHITE = re.compile(r"[\x20\x09-\x0D]")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _plain_duplicates(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[WHITE.sub("", text or "")].append((i, len(text or "")))
    found = []
    for bare, members in groups.items():
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        digest, seen = hashlib.sha256(bare.encode()).hexdigest(), False
        for member in members:
            kept = member == best and not seen
            seen |= kept
            found.append((member[0], best[0], len(members), kept, digest))
    return Counter(found)


@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (3, 5)])
def test_exact_duplicates(documents, odd, primes):
    """Weak fingerprints collide; the chunkwise comparison keeps different texts apart."""
    table = documents(odd)
    found = exact_dedup.exact_duplicates(table, chunk_bytes=16 if primes[0] == 3 else 1 << 20, primes=primes)
    rows = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect())
    assert rows == _plain_duplicates(odd)


def test_deduplicated_rows_keep_their_columns(documents, odd):
    table = documents(odd)
    kept = exact_dedup.deduplicated(table, exact_dedup.exact_duplicates(table))
    assert kept.columns == table.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    expected = _plain_duplicates(odd)
    assert len(rows) == sum(n for row, n in expected.items() if row[3]) and (6, odd[6][1]) not in rows
    assert Counter(i for i, _ in rows) == Counter(row[0] for row, n in expected.items() for _ in range(n) if row[3])


def test_fingerprints_compose():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 1000).astype(object)
    p, b = exact_dedup.PRIMES[0], exact_dedup.BASES[0]
    whole = 0
    for byte in data:
        whole = (whole * b + int(byte)) % p
    h = 0
    for low in range(0, 1000, 64):
        part, own = data[low : low + 64], 0
        for byte in part:
            own = (own * b + int(byte)) % p
        h = (h * pow(b, len(part), p) + own) % p
    assert h == whole


def test_empty_tables(documents):
    empty = documents([])
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert ngram_join.similar_components(empty).count() == 0


def _sets(rows, width):
    for i, text in rows:
        words = [w for w in WHITE.split((text or "").translate(LOWER)) if w]
        if len(words) >= width:
            yield i, frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))
        else:
            yield i, frozenset([tuple(words)]) if words else frozenset()


def _plain_components(rows, width, percent):
    """Every pair of texts is compared."""
    sets = list(_sets(rows, width))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    names = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            names[find(k)] = min(names.get(find(k), i), i)
    return Counter((i, len(s), names.get(find(k)) if s else i) for k, (i, s) in enumerate(sets))


def _edited(text, edits, rng):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.random():.6f}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(prose):
    """A large group of near copies, small groups around the threshold, a passage that all texts share."""
    rng = random.Random(5)
    passage, base = prose(100, 60), prose(101, 90)
    rows = [(i, _edited(base, rng.randint(0, 8), rng)) for i in range(60)]
    rows += [(100 + i, f"{prose(200 + i, 40)} {passage} {prose(300 + i, 40)}") for i in range(60)]
    for k in range(15):
        own = prose(400 + k, rng.choice([10, 30, 60]))
        rows += [(1000 + 10 * k + j, _edited(own, j, rng)) for j in range(4)]
    return rows


@pytest.mark.parametrize("settings", [ngram_join.Settings(3, 90, 8), ngram_join.Settings(5, 80, 4)])
def test_similar_components(documents, corpus, odd, settings):
    rows = corpus + odd
    found = ngram_join.similar_components(documents(rows), settings)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == _plain_components(
        rows, settings.width, settings.percent
    )


def test_whole_sets_of_unlike_texts_are_not_read(documents, prose, monkeypatch):
    """Texts a little below the threshold share tokens of all prefixes; their marks tell them apart before their sets are moved."""
    rng, base = random.Random(8), prose(800, 300)
    rows = [(0, base), (1, _edited(base, 2, rng)), *((10 + k, _edited(base, 10, rng)) for k in range(12))]
    read, whole_sets = [], ngram_join.whole_sets

    def watched(documents, nodes, *rest):
        read.append(nodes.count())
        return whole_sets(documents, nodes, *rest)

    monkeypatch.setattr(ngram_join, "whole_sets", watched)
    found = ngram_join.similar_components(documents(rows), ngram_join.Settings(3, 90)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: 0 if i == 1 else i for i, _ in rows}
    assert sum(read) == 2


@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 500, 20_000])
def test_marks_never_show_more_differences_than_there_are(size):
    rng = np.random.default_rng(size)
    for changed, added in [(0.0, 0.0), (0.05, 0.0), (0.1, 0.2), (0.5, 0.1), (1.0, 3.0)]:
        x = np.unique(rng.integers(0, 1 << 63, size, np.uint64))
        fresh = rng.integers(0, 1 << 63, int(size * (changed + added)), np.uint64)
        y = np.unique(np.concatenate([x[int(size * changed) :], fresh]))
        shown = ngram_join._differences(ngram_join._marks(x), ngram_join._marks(y))
        assert shown <= len(np.setxor1d(x, y))
        assert shown == ngram_join._differences(ngram_join._marks(y), ngram_join._marks(x))


def test_a_bitmap_is_one_job(spark):
    """However many partitions it has: the driver writes the tasks of each job."""
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    values = [k * 32_768 * 31 for k in range(60)]
    frame = spark.createDataFrame([(v,) for v in values], "h bigint")
    tracker = spark.sparkContext.statusTracker()
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        spark.sparkContext.setJobGroup("one bitmap", "")
        bitmap = ngram_join._bitmap(frame, "h")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for name, value in before.items():
            spark.conf.set(name, value)
    assert ngram_join._held(bitmap, np.array(values)).all() and int(np.bitwise_count(bitmap).sum()) == 60
    assert len(tracker.getJobIdsForGroup("one bitmap")) <= 3


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[k] for k in range(100, 160)} == {100} and found[201] == 200
