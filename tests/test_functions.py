import datetime as dt
import re
from uuid import UUID, uuid4

import pytest
from pyspark.sql import functions as F

from carebundle.functions import codes, keys, parse


def _values(frame, column):
    return [row[0] for row in frame.select(column).collect()]


def test_uuid_id_is_the_absolute_low_half(frame):
    uuids = [str(uuid4()) for _ in range(50)] + [str(uuid4()).upper() for _ in range(10)]
    uuids += ["9cfe98a6-269c-486f-9d1d-4942df1603a4", "ffffffff-ffff-ffff-ffff-ffffffffffff"]

    def low(text):
        value = UUID(text).int & (2**64 - 1)
        return abs(value - 2**64 if value >= 2**63 else value)

    assert _values(frame([(u,) for u in uuids], "u string"), keys.uuid_id("u")) == [low(u) for u in uuids]
    assert low("9cfe98a6-269c-486f-9d1d-4942df1603a4") == 7125458483870825564


def test_uuid_id_keeps_the_value_without_an_absolute(frame):
    lowest = "00000000-0000-0000-8000-000000000000"
    assert _values(frame([(lowest,)], "u string"), keys.uuid_id("u")) == [-(2**63)]


@pytest.mark.parametrize(
    "text", [None, "", "x", "9cfe98a6269c486f9d1d4942df1603a4", "9cfe98a6-269c-486f-9d1d-4942df1603ag",
             "9cfe98a6-269c-486f-9d1d-4942df1603a4\n", " 9cfe98a6-269c-486f-9d1d-4942df1603a4"]
)
def test_malformed_uuid_is_null(frame, text):
    assert _values(frame([(text,)], "u string"), keys.uuid_id("u")) == [None]


def test_surrogate_key_tells_rows_and_tables_apart(frame):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("~", "c"), ("", "c"), ("c", None), (None, None)]
    table = frame(rows, "x string, y string")
    one, two = (_values(table, keys.surrogate_key(name, ["x", "y"])) for name in ("one", "two"))
    assert len(set(one + two)) == 2 * len(rows)
    assert all(0 <= key < 2**63 for key in one + two)


def test_surrogate_key_does_not_depend_on_partitions(spark):
    numbers = spark.range(1000)
    key = keys.surrogate_key("t", ["id"]).alias("k")
    left = {row.id: row.k for row in numbers.select("id", key).collect()}
    right = {row.id: row.k for row in numbers.repartition(7).select("id", key).collect()}
    assert left == right and len(set(left.values())) == 1000


def test_random_hex(spark):
    values = _values(spark.range(500), keys.random_hex(7))
    assert all(re.fullmatch(r"([0-9A-F]{2}){1,3}", value) for value in values)
    assert values != _values(spark.range(500), keys.random_hex(8))


def test_hex_bytes_are_signed_whole_bytes(frame):
    numbers = [(0,), (127,), (128,), (255,), (32767,), (32768,), (999_999,)]
    assert _values(frame(numbers, "n bigint"), keys.hex_bytes("n")) == [
        "00", "7F", "0080", "00FF", "7FFF", "008000", "0F423F"
    ]


def test_row_hash_sees_the_position_of_nulls(frame):
    table = frame([(None, 1), (1, None), (1, 1), (None, None)], "a int, b int")
    assert len(set(_values(table, keys.row_hash(["a", "b"])))) == 4


def test_datetimes(frame):
    texts = [("2010-12-10T22:23Z",), (None,), ("2010-12-10",), ("2010-02-30T10:00Z",), ("2010-12-10T25:00Z",),
             ("2010-12-10T22:23",), ("soon",), (" 2010-12-10T22:23Z",)]
    values = _values(frame(texts, "t string"), parse.parse_datetime("t"))
    assert values == [dt.datetime(2010, 12, 10, 22, 23)] + [None] * 7


def test_dates(frame):
    table = frame([("2010-12-10",), (None,), ("2010-12-10T22:23Z",), ("2010-02-30",), ("2010",)], "t string")
    assert _values(table, parse.parse_date("t")) == [dt.date(2010, 12, 10)] + [None] * 4
    assert _values(table, parse.parse_date_as_timestamp("t")) == [dt.datetime(2010, 12, 10)] + [None] * 4
    day = dt.date(2010, 12, 10)
    assert _values(table, parse.parse_day("t")) == [day, None, day, None, None]


def test_doubles(frame):
    assert _values(frame([("1.5",), ("x",), (None,)], "t string"), parse.parse_double("t")) == [1.5, None, None]


def test_codes(frame):
    genders = frame([("M",), ("F",), ("U",), (None,)], "g string")
    concept = codes.gender_concept("g")
    assert _values(genders, concept) == [8507, 8532, None, None]
    assert _values(genders, codes.gender_source_concept(concept)) == [1001, 1002, None, None]
    assert _values(genders, codes.gender_source_concept(concept, {8507: 1002})) == [1002, None, None, None]
    classes = frame([(c,) for c in ("inpatient", "wellness", "urgentcare", "hospice")], "c string")
    visits = classes.select(codes.visit_concept("c").alias("v"))
    assert visits.schema["v"].dataType.simpleString() == "bigint"
    assert [row.v for row in visits.collect()] == [9201, 9202, 9203, None]
    assert _values(genders, codes.map_codes("g", {})) == [None] * 4


def test_expressions_hold_no_python(spark):
    table = spark.range(1).select(F.lit("x").alias("u"))
    plan = table.select(keys.uuid_id("u"), keys.surrogate_key("t", ["u"]), keys.random_hex(), parse.parse_day("u"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "UDF" not in text
