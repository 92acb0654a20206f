"""Licence scan, periodic runs and target sampling against plain versions."""

import hashlib
import math
import random
import re
import time
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest

from carebundle.llm import decontaminate, license_scan, periodic_runs, queries, target_sampling
from tests.conftest import SMALL

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SIMPLE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def simple_words(text):
    return SIMPLE.findall((text or "").translate(LOWER))


# --- periodic runs ---------------------------------------------------------------------------------------------------


def plain_runs(words, least):
    """Every lag word by word; a stretch belongs to its smallest period."""
    found, n = {}, len(words)
    for period in range(1, n // 2 + 1):
        start = None
        for i in range(period, n + 1):
            if i < n and words[i] == words[i - period]:
                start = i if start is None else start
            elif start is not None:
                first, length = start - period, i - start + period
                if length >= max(least, 2 * period):
                    found.setdefault((first, length), period)
                start = None
    return sorted((s, length, p) for (s, length), p in found.items())


@pytest.mark.parametrize("least", [1, 2, 5, 12])
def test_runs_of_random_sequences(least):
    rng = random.Random(least)
    for size in [*range(0, 14), *(rng.randint(14, 120) for _ in range(150))]:
        letters = rng.choice([1, 2, 3])
        words = [rng.randrange(letters) for _ in range(size)]
        if rng.random() < 0.5 and size:
            period = rng.randint(1, size)
            words = [words[i % period] for i in range(size)]
            words[rng.randrange(size)] = 7
        rows = periodic_runs.runs_of(np.array(words, np.int64), least)
        assert [tuple(row) for row in rows.tolist()] == plain_runs(words, least)


def test_runs_across_blocks(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BLOCK", 16)
    rng = random.Random(5)
    for _ in range(60):
        words = [rng.randrange(2) for _ in range(rng.randint(20, 200))] * rng.randint(1, 4)
        rows = periodic_runs.runs_of(np.array(words, np.int64), 12)
        assert [tuple(row) for row in rows.tolist()] == plain_runs(words, 12)


def test_words_of_thue_and_morse():
    """Sequences whose polynomials agree modulo powers of two are told apart."""
    words = [bin(k).count("1") % 2 for k in range(4096)]
    rows = periodic_runs.runs_of(np.array(words, np.int64), 12)
    assert [tuple(row) for row in rows.tolist()] == plain_runs(words, 12)


def test_one_word_repeated_a_million_times():
    began = time.process_time()
    assert periodic_runs.runs_of(np.zeros(1_000_000, np.int64)).tolist() == [[0, 1_000_000, 1]]
    assert time.process_time() - began < 60


def plain_summary(rows):
    found = []
    for i, text in rows:
        words = SPACED.findall(text or "")
        n, h = len(words), crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(words, 12)
        repeated = {k for s, length, p in runs for k in range(s + p, s + length)}
        best = min(((-length, s, p) for s, length, p in runs), default=None)
        numbers = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        kept = " ".join(word for k, word in enumerate(words) if k not in repeated)
        found.append((i, len(runs), *numbers, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))))
    return Counter(found)


def test_periodic_runs_of_documents(documents, odd, prose):
    rows = [(i, text) for i, text in odd if text is None or len(text) < 100_000]
    rows += [(100 + k, prose(k, 50 + 7 * k)) for k in range(40)]
    rows += [(200, "a b " * 40), (201, "x " + "left right\n" * 9 + "y" + " left right" * 8), (202, "é é\t" * 30), (10, "a " * 500)]
    table = periodic_runs.with_planted_periods(documents(rows))
    found = periodic_runs.summary(periodic_runs.periodic_runs(table))
    assert Counter(tuple(row) for row in found.collect()) == plain_summary(rows)


def test_very_long_text_of_periodic_words(documents):
    line = "the same line stands here again and again\n"
    rows = [(1, line * 500_000)]  # 20 MB
    found = periodic_runs.periodic_runs(documents(rows)).collect()
    assert [tuple(run) for run in found[0].runs] == [(0, 4_000_000, 8)] and found[0].collapsed == line.strip()


# --- target sampling -------------------------------------------------------------------------------------------------


def plain_sample(rows, target, settings):
    def features(text):
        words = simple_words(text)
        return [" ".join(words[i : i + n]) for n in range(1, settings.longest + 1) for i in range(len(words) - n + 1)]

    bucket = lambda feature: crc32(feature.encode()) % settings.buckets
    raw, wanted = (Counter(bucket(f) for t in texts for f in features(t)) for texts in ([t for _, t in rows], target))
    n_raw, n_wanted = sum(raw.values()), sum(wanted.values())
    gain = lambda b: math.floor(settings.scale * math.log((wanted[b] + 1) * (n_raw + settings.buckets) / ((raw[b] + 1) * (n_wanted + settings.buckets))))
    found = []
    for i, text in rows:
        own = [gain(bucket(f)) for f in features(text)]
        h = int(hashlib.sha256(f"{settings.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(own) // len(own) if own else 0
        score = weight + math.floor(-settings.scale * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([i, len(own), weight, score, len(simple_words(text)) >= settings.least_words])
    order = sorted((r for r in found if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = len(order) * settings.percent // 100
    ranked = Counter((*r[:4], rank) for rank, r in enumerate(order[:drawn], 1))
    return ranked + Counter((*r[:4], None) for r in order[drawn:]) + Counter((*r[:4], None) for r in found if not r[4])


@pytest.mark.parametrize(
    "settings",
    [
        target_sampling.Settings(),
        target_sampling.Settings(longest=3, buckets=50, percent=60, least_words=2),
        target_sampling.Settings(percent=100, least_words=0, scale=1),
    ],
)
def test_target_sampling(spark, documents, odd, prose, settings):
    rows = odd + [(k, prose(k, 10 + k)) for k in range(50, 120)] + [(77, prose(77, 87))] * 5 + [(None, prose(9, 40))] * 30
    target = [prose(k, 60) for k in (60, 61)] + [None, ""]
    bench = spark.createDataFrame([(k, text, 0) for k, text in enumerate(target)], "item_id bigint, text string, score bigint")
    found = target_sampling.resample_to_target(documents(rows), bench, settings)
    assert Counter(map(tuple, found.collect())) == plain_sample(rows, target, settings)


def test_a_hot_row_is_numbered_and_cut(spark, documents, prose):
    """A third of all rows are one row: exactly the wanted number of its copies is drawn."""
    rows = [(5, prose(3, 40))] * 400 + [(k, prose(k, 30)) for k in range(1000, 1800)]
    settings = target_sampling.Settings(percent=50)
    found = target_sampling.resample_to_target(documents(rows), documents([(0, prose(3, 40))]), settings)
    ranks = sorted(row["rank"] for row in found.collect() if row["rank"] is not None)
    assert ranks == list(range(1, 601))


def test_target_sampling_without_rows(spark, documents, prose):
    empty, some = documents([]), documents([(1, prose(1, 40)), (2, None)])
    assert target_sampling.resample_to_target(empty, some).count() == 0
    rows = target_sampling.resample_to_target(some, empty).collect()
    assert len(rows) == 2 and all(row["rank"] is None for row in rows)  # a tenth of one row is none


# --- licences --------------------------------------------------------------------------------------------------------


def plain_bases(text):
    words = simple_words(text)
    return len(words), [(i, label) for phrase, label in license_scan.BASE_PHRASES
                        for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]


LICENCES = [
    (1, "Words. Released under the MIT License. More words", "mit", "mit"),
    (2, "the MIT\n License, an MIT-License and the Apache License", "apache,mit", "apache,mit"),
    (3, "licensed under the apache license, version 2.0", "apache", "apache,apache-2.0"),
    (4, "This work is licensed under the GNU General Public License, version 3.", "gpl", "gpl,gpl-3.0"),
    (5, "Licensed under CC BY-NC 4.0.", "", "cc-by-nc-4.0"),
    (6, "the license of the general public, mit and apache", "", ""),
    (7, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that some"
        " following conditions are met:", "", "bsd"),
    (8, "Redistribution of binary forms without modification of the source is permitted on conditions", "", ""),
    (9, "Permission is hereby granted, free of charge, to any person who wants to obtain a copy of this software and associated"
        " documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy,"
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "", "mit"),
]


def test_licences(documents, odd, prose):
    extra = [(20, f"{prose(1, 3000)} licensed under the MIT License. {prose(2, 3000)}"), (21, "License " * 50), (22, "MIT LICENSE" * 3)]
    rows = odd + [(i, text) for i, text, _, _ in LICENCES] + extra + [(30, LICENCES[4][1])] * 40
    found = license_scan.scan(documents(rows)).collect()
    assert len(found) == len(rows)
    by_text = Counter()
    for i, text in rows:
        n, bases = plain_bases(text)
        starts = [at for at, _ in bases]
        by_text[i, n, len(bases), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in bases}))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found) == by_text
    for i, _, base, labels in LICENCES:
        assert {(r.base_labels, r.labels) for r in found if r.doc_id == i and r.labels} <= {(base, labels)} or i in {r[0] for r in odd}
    assert {r.labels for r in found if r.doc_id == 30} == {"cc-by-nc-4.0"}
    assert {(r.labels, r.places[0].at) for r in found if r.doc_id == 20} == {("mit", 2999)} or plain_bases(extra[0][1])[1]
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in found)


@pytest.mark.parametrize("case", LICENCES, ids=lambda case: str(case[0]))
def test_labels_of_one_licence(documents, case):
    """Alone in a table the rare words are others; the labels are not."""
    i, text, base, labels = case
    row = license_scan.scan(documents([(i, text)])).first()
    assert (row.base_labels, row.labels) == (base, labels)


def test_licences_without_rows_or_templates(documents):
    assert license_scan.scan(documents([])).count() == 0
    row = license_scan.scan(documents([(1, "the MIT license")]), templates=()).first()
    assert (row.labels, row.score) == ("mit", 0.5)


def test_no_python_in_the_licence_scan(documents):
    plan = license_scan.scan(documents([(1, LICENCES[0][1])]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


@pytest.mark.parametrize("name", ["op4_ngram_join", "op11_license_scan", "op13_target_sampling"])
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    cursor = connection.execute(queries.SQL[name])
    names = [column[0] for column in cursor.description]
    result = queries.QUERIES[name](spark, SMALL)
    assert sorted(result.columns) == sorted(names)
    assert sorted(map(repr, cursor.fetchall())) == sorted(repr(tuple(r[n] for n in names)) for r in result.collect())


def test_marks_are_taken_off_without_looking_up_letters(spark):
    """A mark in the text itself is no name's; no text goes through ``translate``, which looks up each of its letters."""
    frame = spark.createDataFrame([("Ann \x01paid 3 km to Bob",)], "text string")
    words = decontaminate._with_words(frame, "text")
    row = words.first()
    assert row.words == ["ann", "paid", "3", "km", "to", "bob"]
    assert row.templates == ["<name>", "paid", "<number>", "<unit>", "to", "<name>"]
    assert "translate" not in words._jdf.queryExecution().executedPlan().toString().lower()
