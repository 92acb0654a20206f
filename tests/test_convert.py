import datetime as dt

from pyspark.sql import functions as F

from carebundle.plans import convert
from carebundle.plans.convert import BUILTIN_CONCEPTS, CONCEPT_COLUMNS
from carebundle.schema import TARGET_TABLES


def _rows(frame, *order):
    return [row.asDict() for row in frame.orderBy(*order).collect()]


def test_all_tables_are_valid(source):
    target = convert.convert(source)
    assert tuple(sorted(target)) == tuple(sorted(TARGET_TABLES))
    assert target.validate(allow_missing_fields=True).errors == ()
    assert target.add_missing_columns().validate().errors == ()
    counts = {row.table_name: row.n for row in target.counts().collect()}
    same = {
        "person": "patients",
        "location": "patients",
        "visit_occurrence": "encounters",
        "note": "encounters",
        "care_site": "organizations",
        "condition_occurrence": "conditions",
        "procedure_occurrence": "procedures",
        "cost": "procedures",
        "provider": "providers",
    }
    assert {name: counts[name] for name in same} == {name: source[table].count() for name, table in same.items()}
    assert counts["observation"] == 6 and counts["concept_fhir"] == 12
    assert all(counts[name] == 0 for name in set(TARGET_TABLES) - set(same) - {"observation", "concept_fhir"})


def test_concepts(source):
    concepts = convert.to_concepts(source["conditions"], source["procedures"])
    assert concepts.columns == list(CONCEPT_COLUMNS)
    by_code = {row.concept_code: row for row in concepts.where("vocabulary_reference = 'SNOMED'").collect()}
    assert by_code["C1"].concept_name == by_code["C1"].fhir_concept_name == "ache"
    assert by_code["P1"].concept_name == "scan" and set(by_code) == {"C1", "P1", "182992009"}
    builtin = convert.builtin_concepts(concepts.sparkSession)
    assert [tuple(row) for row in builtin.collect()] == list(BUILTIN_CONCEPTS)
    assert concepts.select("concept_id").distinct().count() == 12


def test_code_without_description(frame):
    table = frame([("A", None), ("A", "b"), (None, "x"), ("B", None)], "code string, description string")
    concepts = convert.to_concepts(table, table.limit(0))
    rows = {row.concept_code: row.concept_name for row in concepts.collect() if row.concept_code in ("A", "B", None)}
    assert rows == {"A": "b", "B": None, None: "x"}


def test_persons(source):
    persons = _rows(convert.to_persons(source["patients"]), "person_id")
    assert persons[0] == {
        "person_id": 1,
        "gender_concept_id": 8532,
        "birth_datetime": dt.datetime(1950, 1, 2),
        "death_datetime": None,
        "gender_source_concept_id": 1002,
        "row_status_source_concept_id": 2008111363,
    }
    assert persons[1]["birth_datetime"] is None and persons[1]["gender_source_concept_id"] == 1001
    assert persons[2]["gender_concept_id"] is None and persons[2]["gender_source_concept_id"] is None
    swapped = convert.to_persons(source["patients"], {8507: 1002, 8532: 1001}).where("person_id = 1").first()
    assert swapped.gender_source_concept_id == 1001


def test_observations_need_a_first_name(source):
    observations = convert.to_observations(source["patients"])
    assert observations.columns == [
        "value_as_string", "observation_concept_id", "observation_source_concept_id", "person_id"
    ]
    rows = {tuple(row) for row in observations.collect()}
    assert rows == {
        ("Ann", 3042942, 2002861901, 1), ("Lee", 3046810, 2002861897, 1), ("999-1", 398093005, 2002861900, 1),
        ("Zoe", 3042942, 2002861901, 3), (None, 3046810, 2002861897, 3), (None, 398093005, 2002861900, 3),
    }


def test_locations(source):
    rows = _rows(convert.to_locations(source["patients"]), "latitude")
    assert {row["latitude"] for row in rows} == {48.5, None} and {row["longitude"] for row in rows} == {2.5, None}
    assert len({row["location_id"] for row in rows}) == 3


def test_visits(source):
    visits = _rows(convert.to_visit_occurrences(source["encounters"]), "visit_occurrence_id")
    assert visits[0] == {
        "visit_occurrence_id": 10,
        "person_id": 1,
        "provider_id": 30,
        "care_site_id": 20,
        "visit_start_datetime": dt.datetime(2010, 12, 10, 22, 23),
        "visit_end_datetime": dt.datetime(2010, 12, 11, 1, 0),
        "visit_concept_id": 9201,
        "visit_type_concept_id": 44818517,
    }
    broken = visits[1]
    assert broken["provider_id"] is None and broken["care_site_id"] is None
    assert broken["visit_start_datetime"] is None and broken["visit_concept_id"] is None


def test_notes(source):
    notes = convert.to_notes(source["encounters"])
    assert notes.columns == [
        "note_id", "care_site_id", "note_class_concept_id", "note_class_source_value", "note_datetime",
        "note_event_field_concept_id", "note_title", "note_type_concept_id", "note_type_source_value", "person_id",
        "provider_id", "visit_detail_id", "visit_occurrence_id", "note_text", "delete_datetime",
        "encoding_concept_id", "insert_datetime", "is_pdf_available", "language_concept_id", "note_event_id",
        "update_datetime", "row_status_source_concept_id",
    ]
    note = notes.orderBy("visit_occurrence_id").first()
    assert note.visit_detail_id == note.visit_occurrence_id == note.note_event_id
    assert note.note_datetime == note.insert_datetime == note.update_datetime == dt.datetime(2010, 12, 10, 22, 23)
    assert note.note_text.split("\n")[1].startswith(" " * 40 + "sed do") and note.delete_datetime is None


def test_repeated_conditions_get_their_own_keys(source):
    rows = convert.to_condition_occurrences(source["conditions"])
    assert rows.count() == 4 and rows.select("condition_occurrence_id").distinct().count() == 4
    shuffled = convert.to_condition_occurrences(source["conditions"].repartition(3))
    assert {tuple(row) for row in rows.collect()} == {tuple(row) for row in shuffled.collect()}


def test_row_id_makes_the_key_without_a_shuffle(source):
    numbered = source["conditions"].withColumn("nr", F.monotonically_increasing_id().cast("string"))
    rows = convert.to_condition_occurrences(numbered, ["nr"])
    assert rows.select("condition_occurrence_id").distinct().count() == 4
    assert "nr" not in rows.columns
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_procedure_dates_with_and_without_time(source):
    procedures = convert.to_procedure_occurrences(source["procedures"])
    assert {row.procedure_datetime for row in procedures.collect()} == {dt.datetime(2010, 12, 10, 22, 23), None}
    costs = convert.to_costs(source["procedures"])
    assert [row.incurred_datetime for row in costs.collect()] == [dt.date(2010, 12, 10)] * 2


def test_keys_differ_between_tables(source):
    procedures = convert.to_procedure_occurrences(source["procedures"]).select("procedure_occurrence_id")
    assert procedures.intersect(convert.to_costs(source["procedures"]).select("cost_id")).count() == 0


def test_providers(source):
    row = convert.to_providers(source["providers"]).first()
    assert row.provider_source_value == row.npi == row.dea == "00000000-0000-0000-0000-00000000001e"
    assert row.is_active is True and row.gender_concept_id == 8532 and row.provider_name == "Dr"


def test_upper_case_headers(source):
    upper = source["patients"].toDF(*(name.upper() for name in source["patients"].columns))
    assert convert.to_locations(upper).columns == convert.to_locations(source["patients"]).columns
    encounters = source["encounters"].toDF(*(name.upper() for name in source["encounters"].columns))
    assert convert.to_visit_occurrences(encounters).count() == 2
    conditions = source["conditions"].toDF(*(name.upper() for name in source["conditions"].columns))
    assert convert.to_condition_occurrences(conditions).count() == 4


def test_one_scan_for_observations(source, tmp_path):
    source["patients"].write.parquet(str(tmp_path / "patients"))
    stored = source["patients"].sparkSession.read.parquet(str(tmp_path / "patients"))
    plan = convert.to_observations(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "IsNotNull(first)" in plan
    assert "ReadSchema: struct<id:string,ssn:string,first:string,last:string>" in plan
