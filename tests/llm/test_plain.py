"""Operators that SQL does not express, against plain versions that look at everything."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from carebundle.llm import decontaminate, exact_dedup, language_id, ngram_join, quality
from tests.conftest import SMALL

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


# --- language: all ways to label some words ----------------------------------------------------------------------


def test_viterbi_finds_the_best_of_all_labelings():
    rng = np.random.default_rng(5)
    for _ in range(30):
        lengths = rng.integers(0, 6, 4)
        firsts = np.concatenate([[0], np.cumsum(lengths)])
        scores = rng.integers(-9, 0, (firsts[-1], 3)).astype(np.float32)
        prior, penalty = rng.integers(-3, 0, 3).astype(np.float32), np.float32(rng.integers(0, 6))

        def value(labels, own, prior=prior, penalty=penalty):
            switches = sum(a != b for a, b in zip(labels, labels[1:]))
            return prior[labels[0]] + sum(own[k][label] for k, label in enumerate(labels)) - penalty * switches

        labels = language_id._viterbi(scores, firsts, prior, penalty)
        for low, high in zip(firsts[:-1], firsts[1:]):
            if high > low:
                own = scores[low:high]
                best = max(value(path, own) for path in itertools.product(range(3), repeat=high - low))
                assert value(labels[low:high].tolist(), own) == best


# --- quality -----------------------------------------------------------------------------------------------------


def test_importances_and_selection(spark, documents, prose):
    """Counts over all texts, log-ratios and means by hand; as many texts as pass the cut, those with the largest keys."""
    rng = random.Random(2)
    rows = [(k, prose(k, 5 + k % 40)) for k in range(120)]
    rows += [(200 + k, " ".join(f"{w}#" for w in prose(k, 30).split())) for k in range(40)] + [(300, None), (301, " "), (3, rows[3][1])]
    labels = [(k, int(k < 200), int(k % 17 == 0)) for k in rng.sample([*range(120), *range(200, 240)], 90)]
    table = documents(rows)
    settings = quality.Settings(bins=1 << 12)
    model = quality.fit(table, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), settings)

    def bins(text):
        data = (text or "").encode()
        return quality.features(np.frombuffer(data, np.uint8), np.array([0, len(data)]), settings.bins)[0].tolist() if data else []

    good = {i for i, q, toxic in labels if q == 1 and not toxic}
    raw, target = Counter(), Counter()
    for i, text in rows:
        raw.update(bins(text))
        if i in good:
            target.update(bins(text))
    size = lambda counts: sum(counts.values()) + settings.bins
    ratio = lambda b: math.log((target[b] + 1) / size(target)) - math.log((raw[b] + 1) / size(raw))
    found = quality.resample(table, model).collect()
    assert len(found) == len(rows)
    plain = {}
    for i, text in rows:
        own = bins(text)
        plain[i] = sum(map(ratio, own)) / len(own) if own else None
    for r in found:
        assert (r.importance is None) == (plain[r.doc_id] is None)
        assert r.importance is None or math.isclose(r.importance, plain[r.doc_id], abs_tol=1e-9)
    open_to = [r for r in found if r.toxicity < model.toxic_cut and r.key is not None]
    wanted = sum(r.importance >= model.cut for r in open_to)
    last = sorted((r.key for r in open_to), reverse=True)[wanted - 1]
    assert {id(r) for r in found if r.selected} == {id(r) for r in open_to if r.key >= last}


def test_worst_windows():
    rng = np.random.default_rng(3)
    for window in (1, 3, 50):
        sizes = rng.integers(0, 12, 6)
        owner = np.repeat(np.arange(6), sizes)
        weights = rng.random(len(owner)).round(3)
        worst = quality._worst(weights, owner, 6, window)
        for text in range(6):
            own = weights[owner == text]
            best = max((own[max(0, k - window + 1) : k + 1].sum() for k in range(len(own))), default=0.0)
            assert math.isclose(worst[text], best, abs_tol=1e-9)


# --- decontamination ---------------------------------------------------------------------------------------------


def _tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    return docs, bench


def test_every_verbatim_passage_is_found_and_nothing_without_a_common_window(small):
    docs, bench = small
    judged = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    items = {r.item_id: _tokens(r.text) for r in bench.collect()}
    shape = lambda words: tuple("#" if w[0].isdigit() else w for w in words)
    windows = {shape(w[k : k + 8]) for w in items.values() for k in range(max(len(w) - 7, 1))}
    found = 0
    for row in docs.collect():
        words = _tokens(row.text)
        line = f" {' '.join(words)} "
        whole = [i for i, w in items.items() if len(w) >= 3 and f" {' '.join(w)} " in line]
        if whole:
            found += 1
            assert judged[row.doc_id].contaminated and judged[row.doc_id].coverage == 1.0, row.doc_id
        sizes = {min(len(w), 8) for w in items.values()}
        common = any(shape(words[k : k + n]) in windows for n in sizes for k in range(len(words) - n + 1))
        names = re.search(r"[A-Z][a-z]", row.text or "")  # other names may stand there
        if not common and not names:
            assert not judged[row.doc_id].contaminated, row.doc_id
    assert found


# --- the first stages of the pipeline ------------------------------------------------------------------------------


def _linked(a, b, percent):
    return len(a | b) > 0 and 100 * len(a & b) >= percent * len(a | b)


def _shingles(text, width):
    words = SPACED.findall((text or "").translate(LOWER))
    if len(words) >= width:
        return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def test_duplicate_stages_by_hand(spark, small):
    """Exact and near duplicates of the small table: what stays, by comparing all texts with all others."""
    docs, _ = small
    kept = exact_dedup.deduplicated(docs, exact_dedup.exact_duplicates(docs))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i))
    exact = {min(members)[1] for members in groups.values()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(exact)
    rest = [(i, _shingles(text, corpus_pipeline.NEAR.width)) for i, text in rows if i in exact]
    least = {i: i for i, _ in rest}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    for (a, x), (b, y) in itertools.combinations(rest, 2):
        if x and y and min(len(x), len(y)) * 100 >= corpus_pipeline.NEAR.percent * max(len(x), len(y)) and _linked(x, y, corpus_pipeline.NEAR.percent):
            p, q = sorted((top(a), top(b)))
            least[q] = p
    near = corpus_pipeline.near_duplicates(spark, kept, "")
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i, _ in rest if top(i) == i)
    assert ngram_join.similar_components(kept, corpus_pipeline.NEAR).count() == len(rest)
