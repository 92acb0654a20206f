import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from carebundle.llm import decontaminate, quality, tool_calls


# --- tool calls --------------------------------------------------------------------------------------------


@pytest.fixture
def linked(spark):
    def link(calls, results=(), schemas=()):
        rows = tool_calls.link_tool_calls(
            spark.createDataFrame([(*row, "x") for row in calls], tool_calls.CALL_COLUMNS + ", level string"),
            spark.createDataFrame([(*row, "x") for row in results], tool_calls.RESULT_COLUMNS + ", errors string"),
            spark.createDataFrame(list(schemas), "name string, parameter string, type string, required boolean"),
        ).collect()
        return sorted(rows, key=lambda r: (r.conv_id is None, r.conv_id or 0, r.level is None, r.level or 0, r.position or 0))

    return link


SCHEMAS = [("add", "a", "integer", True), ("add", "b", "number", False), ("add", "o", "object", False)]


def test_calls_and_results_are_linked(linked):
    calls = [
        (1, 0, "c1", "add", '{"b": 1.5, "a": 2}', []),
        (1, 2, "c2", "add", '{"a": 1, "o": {"z": [1, null], "k": "é"}}', ["c1", "none"]),
        (2, 0, "c1", "add", '{"a": 1}', None),
    ]
    results = [(1, 3, "c2", '{"y": 1, "x": 2}'), (1, 1, "c1", "plain \"text\""), (1, 5, "c1", "late"), (3, 1, "c1", "other")]
    first, second, other = linked(calls, results, SCHEMAS)
    assert first.json == '{"arguments":{"a":2,"b":1.5},"id":"c1","name":"add","result":"plain \\"text\\""}'
    assert second.json == '{"arguments":{"a":1,"o":{"k":"é","z":[1,null]}},"id":"c2","name":"add","result":{"x":2,"y":1}}'
    assert (first.answered, first.result_position, other.answered) == (True, 1, False)
    assert all(r.errors == [] and r.ordered and r.level == 0 for r in (first, second, other))
    assert all(json.loads(r.json) for r in (first, second, other))


def test_arguments_are_validated(linked):
    texts = ['{"b": "x", "c": 1}', "[1]", "no", None, '{"a": 1.5}', '{"a": 1, "a": 2}', '{"a": null}']
    rows = linked([(1, k, f"c{k}", "add", text, None) for k, text in enumerate(texts)], (), SCHEMAS)
    assert [r.errors for r in rows] == [
        ["missing a", "not number: b", "unknown c"], ["not an object"], ["not JSON"], ["not JSON"], ["not integer: a"],
        ["not JSON"], ["not integer: a"],
    ]
    assert rows[2].json == '{"arguments":"no","id":"c2","name":"add"}' and '"arguments":null' in rows[3].json
    (unknown,) = linked([(1, 0, "c", "mul", "{}", None)], (), SCHEMAS)
    assert unknown.errors == ["unknown tool"]


def test_topological_order(linked):
    calls = [(1, 0, "a", "f", "{}", ["c"]), (1, 1, "b", "f", "{}", ["a"]), (1, 2, "c", "f", "{}", []), (1, 3, "d", "f", "{}", ["b", "a"])]
    calls += [(2, 0, "x", "f", "{}", ["y"]), (2, 1, "y", "f", "{}", ["x"]), (2, 2, "z", "f", "{}", ["y"]), (2, 3, "w", "f", "{}", None)]
    calls += [(3, k, f"n{k}", "f", "{}", [f"n{k - 1}"]) for k in range(30)]
    rows = linked(calls)
    assert [(r.call_id, r.level) for r in rows if r.conv_id == 1] == [("c", 0), ("a", 1), ("b", 2), ("d", 3)]
    assert {r.call_id: r.ordered for r in rows if r.conv_id == 2} == {"w": True, "x": False, "y": False, "z": False}
    assert [r.position for r in rows if r.conv_id == 3] == list(range(30))


def test_odd_calls(linked):
    rows = linked(
        [(1, 5, "c", "f", "{}", None), (1, 2, "c", "g", "{}", None), (1, 2, "c", "g", "{}", None), (None, 0, "c", None, None, None),
         (None, None, None, None, None, None), (1, 0, None, "f", "x" * 100_000, ["c"])],
        [(1, 9, "c", None), (None, 1, "c", ""), (None, 1, None, "r")],
    )
    assert len(rows) == 6 and sum(r.repeated for r in rows) == 2 and sum(r.answered for r in rows) == 2
    (first,) = [r for r in rows if r.answered and r.conv_id == 1]
    assert (first.position, first.name) == (2, "g") and first.json.endswith('"result":null}')
    assert linked([]) == []


def test_turns_as_calls(spark):
    message = json.dumps({"tool_calls": [{"id": "t1", "name": "ask", "arguments": '{"turn":1,"text":"x"}', "depends_on": []}]})
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hé\n"), (1, 2, "assistant", None), (2, 0, "assistant", message),
            (2, 1, "tool", '{"tool_call_id": "t1", "content": "42"}'), (3, None, "user", "x"), (3, 1, None, "x"), (None, 0, "user", "")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    calls, results = tool_calls.calls_of_conversations(turns)
    found = {(r.conv_id, r.call_id): r for r in tool_calls.link_tool_calls(calls, results, tool_calls.turn_tools(spark)).collect()}
    assert found[1, "1:1"].json == '{"arguments":{"text":"hé\\n","turn":1},"id":"1:1","name":"ask","result":null}'
    assert found[2, "t1"].answered and found[2, "t1"].json.endswith('"result":42}') and not found[2, "t1"].errors
    assert set(found) == {(1, "1:0"), (1, "1:1"), (2, "t1"), (None, "0")}


def test_no_result_is_lost(spark):
    calls = spark.createDataFrame([(1, 0, "c1", "add", "{}", None), (1, 4, "c2", "add", "{}", None), (None, 0, "c1", "add", "{}", None)], tool_calls.CALL_COLUMNS)
    rows = [
        (1, 1, "c1", "a"), (1, 1, "c1", "a"), (1, 2, "c1", "b"), (1, 1, "c9", '{"y":1, "x":2}'), (1, 3, None, "n"),
        (2, 1, "c1", "c"), (2, 1, "c1", "c"), (None, 1, "c1", "d"), (None, 1, "c1", None), (1, 5, "c2", None),
    ]
    results = spark.createDataFrame(rows, tool_calls.RESULT_COLUMNS)
    alone = Counter((r.conv_id, r.position, r.call_id, r.content, r.repeated) for r in tool_calls.unlinked_results(calls, results).collect())
    assert alone == Counter([
        (1, 1, "c1", "a", True), (1, 2, "c1", "b", True), (1, 1, "c9", '{"y":1, "x":2}', False), (1, 3, None, "n", False),
        (2, 1, "c1", "c", False), (2, 1, "c1", "c", False), (None, 1, "c1", "d", True),
    ])
    found = tool_calls.transcript(calls, results, spark.createDataFrame([], "name string, parameter string, type string, required boolean")).collect()
    assert Counter(r.kind for r in found) == {"call": 3, "result": 7}
    assert sum(r.kind == "result" or r.answered for r in found) == len(rows)
    assert {r.json for r in found if r.call_id == "c9"} == {'{"id":"c9","result":{"x":2,"y":1}}'}
    assert tool_calls.unlinked_results(calls, results.limit(0)).count() == 0


def test_built_in_functions_only(spark):
    turns = spark.createDataFrame([(1, 0, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    calls, results = tool_calls.calls_of_conversations(turns)
    plan = tool_calls.link_tool_calls(calls, results, tool_calls.turn_tools(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Cartesian" not in plan


# --- quality -----------------------------------------------------------------------------------------------


def test_quality(spark, documents, prose, odd):
    junk = [
        lambda k: " ".join(f"{w}###" for w in prose(k, 40).split()),
        lambda k: " ".join(f"{w}!!" for w in prose(k, 40).upper().split()),
        lambda k: " ".join(w for w in prose(k, 8).split() for _ in range(7)),
        lambda k: " | ".join(prose(k, 30).split()),
    ]
    good = [(k, prose(k, 60)) for k in range(200)]
    bad = [(1000 + k, junk[k % 4](k)) for k in range(60)]
    rows = [(i, 1, 0) for i, _ in good[:100]] + [(i, 0, 0) for i, _ in bad[:30]] + [(None, 1, 0), (5, 1, 0), (5000, 0, None)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    table = documents(good + bad)
    model = quality.fit(table, labels)
    found = {r.doc_id: r for r in quality.resample(table, model).collect()}
    assert sum(found[i].selected for i, _ in good) >= 198 and sum(found[i].selected for i, _ in bad) <= 2
    assert {r.selected for r in quality.resample(documents(odd), model).collect() if r.importance is None} <= {False}
    assert quality.resample(documents(odd), model).count() == len(odd) and quality.resample(documents([]), model).count() == 0
    open_model = quality.fit(table, labels.limit(0))
    assert all(r.selected for r in quality.resample(table, open_model).collect())


def test_sampling_follows_the_weights(spark, documents):
    """With the temperature of plain importance resampling, a text of twice the weight is taken more often."""
    table = documents([(k, "good" if k % 2 else "fair") for k in range(4000)])
    ratio = np.zeros(1 << 10)
    settings = quality.Settings(bins=1 << 10, temperature=1.0)
    found, texts = quality.features(np.frombuffer(b"goodfair", np.uint8), np.array([0, 4, 8]), 1 << 10)
    ratio[found[texts == 0]] = 1.0
    model = quality.Model(ratio, 0.75, settings)
    rows = quality.resample(table, model).collect()
    taken = [r.doc_id % 2 for r in rows if r.selected]
    assert len(taken) == sum(r.importance >= 0.75 for r in rows) and 0.55 < np.mean(taken) < 0.95


def test_kth_largest(spark):
    rng = random.Random(1)
    values = [rng.choice([rng.gauss(0, 1e6), 1.5, -2.0]) for _ in range(3000)]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 7, 1500, 3000):
        assert quality._kth_largest(keys, k) == sorted(values, reverse=True)[k - 1]


# --- decontamination ---------------------------------------------------------------------------------------


@pytest.fixture
def judge(spark, documents):
    def run(texts, items, **settings):
        bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
        found = decontaminate.contamination(documents(texts), bench, **settings)
        return {r.doc_id: r for r in found.collect()} if len({i for i, _ in texts}) == len(texts) else found.collect()

    return run


QUESTION = "A train leaves the old station with Anna at 9 and travels 120 km in 3 hours, so how fast does Anna go on average today?"


def test_leaks(judge, prose):
    other = QUESTION.replace("120", "450").replace("Anna", "Bob").replace("9", "7")
    mixed = QUESTION.replace("with Anna", "with Bob")  # one value of the item has become two
    texts = [
        (1, f"{prose(1, 50)} {QUESTION} {prose(2, 50)}"), (2, f"{prose(3, 50)}. {other}"), (3, f"{prose(4, 50)}. {mixed}"),
        (4, prose(5, 300)), (5, None), (6, ""), (7, QUESTION.upper().replace(",", ";")), (8, " ".join(QUESTION.split()[:9])),
        (9, "one two three"), (10, f"{prose(6, 9)} four five six {prose(7, 30_000)}"),
    ]
    rows = judge(texts, [QUESTION, None, "", "one two", "four five six", QUESTION])
    assert {i for i, r in rows.items() if r.contaminated} >= {1, 2, 10}
    assert not any(rows[i].contaminated for i in (3, 4, 5, 6, 8, 9))
    assert (rows[1].item_id, rows[1].coverage, rows[1].changed_slots) == (0, 1.0, 0)
    assert (rows[2].item_id, rows[2].changed_slots) == (0, 3) and rows[10].item_id == 4
    assert rows[4].item_id is None and rows[4].coverage == 0.0


def test_leaks_with_edits(judge, prose):
    """Words put in, left out or replaced, and parts: the runs beside an edit count together."""
    item = prose(20, 32)
    words = item.split()
    edited = [
        [*words[:16], "zzq", *words[16:]], [*words[:16], "zzq", "qqz", "zqz", *words[16:]], [*words[:16], *words[17:]],
        [*words[:16], "zzq", *words[17:]], words[:20], words[:16], words[16:], [*words[:10], "zzq", *words[10:20], "zzq", *words[20:]],
    ]
    other = QUESTION.replace("with Anna", "with Mary Ann").replace("does Anna", "does Mary Ann").replace("120", "450")
    texts = [(k, f"{prose(30 + k, 40)} {' '.join(part)} {prose(60 + k, 40)}") for k, part in enumerate(edited)]
    rows = judge([*texts, (100, other), (101, " ".join(words[:12])), (102, f"{QUESTION} {QUESTION.replace('Anna', 'Bob')}")], [item, QUESTION])
    assert [k for k in range(len(edited)) if not rows[k].contaminated] == []
    assert {rows[k].item_id for k in range(len(edited))} == {0} and rows[100].item_id == 1
    assert not rows[101].contaminated and (rows[102].coverage, rows[102].changed_slots) == (1.0, 0)


def test_leaks_in_other_case_and_punctuation(judge, prose):
    item = f"Anna has 3 old apples on the table. Then Carl takes 2 of them away and {prose(70, 6)}. How many do Anna and Carl have now in all?"
    other = item.replace("Anna", "Paula").replace("Carl", "Eric").replace("3", "17")
    named = f"Wilma {prose(71, 7)}. Wilma {prose(72, 7)}. Wilma {prose(73, 7)}"  # a name only where sentences begin
    short = "Who wrote the book about a whale"
    texts = [
        item.upper(), item.lower(), item.replace(".", "").replace("?", ""), other, other.replace(".", ""), item.lower().replace("3", "17"),
        named.replace("Wilma", "Berta"), f"foo {short} bar", short.upper(),
    ]
    rows = judge([(k, f"{prose(80 + k, 20)} {text}") for k, text in enumerate(texts)], [item, named, short])
    assert [rows[k].item_id for k in range(len(texts))] == [0, 0, 0, 0, 0, 0, 1, 2, 2]
    assert [rows[k].coverage for k in range(len(texts))] == [1.0] * len(texts)
    assert (rows[2].changed_slots, rows[3].changed_slots, rows[6].changed_slots) == (0, 3, 1)


def test_word_for_word_but_one_value(judge, prose):
    """One of two occurrences of a value is changed, the rest stands word for word."""
    item = f"{prose(90, 9)} Anna {prose(91, 12)} Anna {prose(92, 9)}"
    changed = item.replace("Anna", "Bob", 1)
    other = f"{prose(90, 9)} Bob {prose(93, 12)} Carl {prose(92, 9)}"  # less than most of it
    rows = judge([(1, f"so {changed} it"), (2, f"so {other} it"), (3, QUESTION.replace("with Anna", "with Bob"))], [item, QUESTION])
    assert (rows[1].contaminated, rows[1].item_id) == (True, 0)
    assert not rows[2].contaminated and not rows[3].contaminated


def test_what_follows_a_part_is_not_looked_at(judge):
    part = QUESTION[: QUESTION.index("does")]
    rows = judge([(1, f"{part} it go? No, see Carl at once."), (2, f"{part} he with Bob")], [QUESTION])
    assert rows[1].contaminated and rows[2].contaminated and rows[2].changed_slots == 0


def test_items_of_one_or_two_words(judge):
    texts = [(1, "Two WORDS!"), (2, "two words more"), (3, "  single "), (4, "two"), (5, None), (6, "so two words")]
    rows = judge(texts, ["two words", "Single", "", "?!", "two words"])
    assert {i: r.item_id for i, r in rows.items() if r.contaminated} == {1: 0, 3: 1}
    assert (rows[1].coverage, rows[1].changed_slots) == (1.0, 0)


def test_odd_tables(judge, odd):
    assert len(judge(odd, [QUESTION])) == len(odd)
    assert not any(r.contaminated for r in judge(odd, []))
    assert judge([], [QUESTION]) == {}
    same = [(1, QUESTION), (1, QUESTION), (1, "clean"), (None, QUESTION)]
    assert sorted(r.contaminated for r in judge(same, [QUESTION])) == [False, True, True, True]


def test_windows_natively(documents, spark):
    bench = spark.createDataFrame([(0, QUESTION)], "item_id bigint, text string")
    plan = decontaminate.contamination(documents([(1, "x")]), bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Cartesian" not in plan


def test_windows_of_placeholders_stay_literal(spark):
    frame = spark.createDataFrame([("1 2 3 4 5 6 7 8 9",), ("9 8 7 6 5 4 3 2 1",)], "text string")
    words = decontaminate._with_words(frame, "text")
    hashes = words.select(decontaminate.window_hashes(F.col("words"), F.col("templates"), 8).alias("h")).collect()
    assert not set(hashes[0].h) & set(hashes[1].h)
