import pytest

import corpus_pipeline
from carebundle.llm import queries
from tests.conftest import SMALL


@pytest.fixture
def folder(spark, tmp_path, prose):
    """Good texts, one of each kind that has to go, and an odd few."""
    bench = prose(9000, 25)
    good = [(k, prose(k, 80)) for k in range(60)]
    words = good[7][1].split()
    near = " ".join([*words[:40], "changed", *words[41:]])
    rows = [
        *good,
        (100, good[3][1]), (101, good[3][1].replace(" ", "\n")), (102, near),
        (103, f"{prose(5000, 40)} {bench} {prose(5001, 40)}"),
        *((200 + k, " ".join(f"{w}###" for w in prose(k, 40).split())) for k in range(20)),
        (300, None), (301, ""), (4, good[4][1]),
    ]
    spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 1, 0) for k in range(30)] + [(200 + k, 0, 0) for k in range(10)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, bench)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), f"test-{name}")
        assert docs.columns == columns
        counts.append(docs.count())
    kept = sorted(r.doc_id for r in docs.collect())
    assert set(kept) == (set(range(60)) | {101}) - {3} or set(kept) == set(range(60))
    assert len(kept) == len(set(kept)) == 60 and counts == sorted(counts, reverse=True)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert sorted(r.doc_id for r in last.collect()) == kept


def test_one_of_each_similar_group(spark, prose):
    """Rows with one id, null ids only, repeated rows, and two groups that share their smallest id."""
    first, second, third = (prose(k, 60).split() for k in (1, 2, 3))
    near = lambda words, k: " ".join([*words[:30], f"changed{k}", *words[31:]])
    rows = [(1, near(first, 1)), (1, near(first, 2)), (1, near(second, 1)), (7, near(second, 2)),
            (None, near(third, 1)), (None, near(third, 2)), (None, near(third, 2)), (9, prose(9, 60)), (9, None), (9, ""), (9, None)]
    schema = "doc_id bigint, text string, `key 0` string, n bigint, component bigint, text_hash bigint"
    docs = spark.createDataFrame([(*row, "x", 1, 2, 3) for row in rows], schema)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    found = kept.collect()
    words = lambda r: (r.text or "").split()[0] if r.text else r.text
    assert sorted(map(words, found), key=str) == sorted([first[0], second[0], third[0], prose(9, 60).split()[0], None, None, ""], key=str)
    assert all(r["key 0"] == "x" and r.component == 2 for r in found)


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_of_empty_and_odd_tables(spark, folder, stage):
    """No rows, null ids, repeated rows, clashing columns."""
    function = dict(corpus_pipeline.STAGES)[stage]
    schema = "doc_id bigint, text string, lang string, `key 0` string, copies bigint, kept boolean, part string, labelled bigint, id string"
    extra = ("en", "x", 1, True, "p", 5, "i")
    odd = spark.createDataFrame([(i, t, *extra) for i, t in [(None, None), (None, ""), (None, "one two"), (1, "one two"), (1, "one two"), (2, None)]], schema)
    assert function(spark, odd.limit(0), folder).count() == 0
    kept = function(spark, odd, folder)
    rows = kept.collect()
    if stage == "byte_level_bpe":
        assert len(rows) == 6
    else:
        assert kept.columns == odd.columns and all(tuple(r)[2:] == extra for r in rows)
    if stage == "exact_duplicates":
        assert [(r.doc_id, r.text) for r in rows if r.text] == [(1, "one two")] and len(rows) == 2
    if stage == "near_duplicates":
        assert [(r.doc_id, r.text) for r in rows if r.text] == [(1, "one two")] and len(rows) == 4


def test_toxic_texts_go(spark, tmp_path, prose):
    """Texts that are good but for a few words, which only toxic labelled texts hold."""
    insult = lambda k: " ".join(w if n % 9 else ("zorbo", "quapp", "mift")[k % 3] for n, w in enumerate(prose(k, 60).split()))
    rows = [(k, prose(k, 60)) for k in range(300)] + [(1000 + k, insult(k)) for k in range(120)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = [(k, 1, 0) for k in range(200)] + [(1000 + k, 1, 1) for k in range(60)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, str(tmp_path)).collect()}
    assert kept == set(range(300))


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_duplicates", "near_duplicates", "benchmark_decontamination", "byte_level_bpe"
    ]
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_exact_duplicates_against_sql(spark):
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    cursor = connection.execute(queries.SQL["op2_exact_dedup"])
    names = [column[0] for column in cursor.description]
    result = queries.QUERIES["op2_exact_dedup"](spark, SMALL)
    assert sorted(result.columns) == sorted(names)
    assert sorted(map(repr, cursor.fetchall())) == sorted(repr(tuple(r[n] for n in names)) for r in result.collect())
