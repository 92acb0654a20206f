"""From the six source tables to the seventeen target tables.

Every conversion but :func:`to_concepts` is one projection over one table.  Tables of events without an id of
their own (conditions, procedures) need a key per row: pass ``row_id``, the columns that tell source rows apart,
to compute it without a shuffle; without it equal rows are numbered by :func:`number_copies`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.functions.codes import gender_concept, gender_source_concept, visit_concept
from carebundle.functions.keys import surrogate_key, uuid_id
from carebundle.functions.parse import parse_date_as_timestamp, parse_datetime, parse_day, parse_double
from carebundle.operators.copies import number_copies
from carebundle.plans.concepts import one_per_code
from carebundle.sources.literal import empty_table, literal_frame

# Constants of the target model.
ROW_ACTIVE = 2008111363
NOTE_FINAL = 1003
CLAIM_ACTIVE = 1004
CLAIM_DIAGNOSIS = 1005
PROCEDURE_COMPLETED = 4082735
VISIT_TYPE = 44818517
NOTE_TYPE = 44814639
NOTE_EVENT_FIELD = 1147332
COST_EVENT_FIELD = 1147624
LANGUAGE = 4180186
VOCABULARY = "SNOMED"
# Title and text of the placeholder note.
NOTE_TITLE = "A simple lorem ipsum"
NOTE_TEXT = (
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit,\n"
    "                                        sed do eiusmod tempor incididunt ut labore et dolore magna aliqua."
)
# Patient column, observation concept, observation source concept.
NAME_OBSERVATIONS = (
    ("first", 3042942, 2002861901),
    ("last", 3046810, 2002861897),
    ("ssn", 398093005, 2002861900),
)

# Columns of the concept table.
CONCEPT_COLUMNS = (
    "concept_id",
    "concept_code",
    "concept_name",
    "vocabulary_reference",
    "fhir_concept_code",
    "fhir_concept_name",
    "fhir_vocabulary_reference",
)
# Concepts that are part of every converted bundle.
BUILTIN_CONCEPTS = (
    (1001, "8532", "female", "administrative-gender", "female", "female", "http://hl7.org/fhir/administrative-gender"),
    (1002, "8507", "male", "administrative-gender", "male", "male", "http://hl7.org/fhir/administrative-gender"),
    (4082735, "182992009", "Treatment completed", "SNOMED", "completed", "completed",
     "http://hl7.org/fhir/procedure-status"),
    (1003, "XXX", "XXX", "referred-document-status", "final", "final",
     "http://hl7.org/fhir/referred-document-status"),
    (1004, "XXX", "XXX", "referred-document-status", "active", "active", "http://hl7.org/fhir/claim-status"),
    (1005, "XXX", "XXX", "FIXME", "FIXME", "FIXME", "FIXME"),
    (2008111363, "Actif", "actif", "name", "not used", "not used", "not used"),
    (2002861901, "3042942", "first", "name", "not used", "not used", "not used"),
    (2002861897, "3046810", "last", "name", "not used", "not used", "not used"),
    (2002861900, "398093005", "last", "name", "not used", "not used", "not used"),
)


def _long(value: int, name: str):
    return F.lit(value).cast("bigint").alias(name)


def builtin_concepts(spark) -> DataFrame:
    types = [T.LongType()] + [T.StringType()] * (len(CONCEPT_COLUMNS) - 1)
    fields = [T.StructField(name, kind) for name, kind in zip(CONCEPT_COLUMNS, types, strict=True)]
    return literal_frame(spark, BUILTIN_CONCEPTS, T.StructType(fields))


def to_concepts(conditions: DataFrame, procedures: DataFrame) -> DataFrame:
    """One concept per code, and the built-in ones.  :func:`one_per_code` takes distinct pairs first, partly before the
    shuffle, so one exchange of pairs serves both tables."""
    pairs = [frame.select("code", "description") for frame in (conditions, procedures)]
    concepts = one_per_code(pairs[0].unionByName(pairs[1]), "code", "description").select(
        surrogate_key("concept_fhir", ["code"]).alias("concept_id"),
        F.col("code").alias("concept_code"),
        F.col("description").alias("concept_name"),
        F.lit(VOCABULARY).alias("vocabulary_reference"),
        F.col("code").alias("fhir_concept_code"),
        F.col("description").alias("fhir_concept_name"),
        F.lit(VOCABULARY).alias("fhir_vocabulary_reference"),
    )
    return concepts.unionByName(builtin_concepts(conditions.sparkSession))


def to_persons(
    patients: DataFrame,
    gender_sources: Mapping[int, int] | None = None,
) -> DataFrame:
    gender = gender_concept("gender")
    source = gender_source_concept(gender) if gender_sources is None else gender_source_concept(gender, gender_sources)
    return patients.select(
        uuid_id("id").alias("person_id"),
        gender.alias("gender_concept_id"),
        parse_date_as_timestamp("birthdate").alias("birth_datetime"),
        parse_date_as_timestamp("deathdate").alias("death_datetime"),
        source.alias("gender_source_concept_id"),
        _long(ROW_ACTIVE, "row_status_source_concept_id"),
    )


def to_observations(patients: DataFrame) -> DataFrame:
    """First name, last name and social security number, for patients with a first name; one scan for all three."""
    families = ", ".join(f"`{column}`, {concept}L, {source}L" for column, concept, source in NAME_OBSERVATIONS)
    named = patients.where(F.col("first").isNotNull())
    return named.select(uuid_id("id").alias("person_id"), *(column for column, _, _ in NAME_OBSERVATIONS)).selectExpr(
        f"stack({len(NAME_OBSERVATIONS)}, {families})"
        " as (value_as_string, observation_concept_id, observation_source_concept_id)",
        "person_id",
    )


def to_locations(patients: DataFrame) -> DataFrame:
    """One location per patient; its key holds the patient's id, since two patients may share an address."""
    return patients.select(
        *(F.col(name).alias(name) for name in ("address", "city", "state")),
        parse_double("lat").alias("latitude"),
        parse_double("lon").alias("longitude"),
        surrogate_key("location", ["id"]).alias("location_id"),
    )


def to_visit_occurrences(encounters: DataFrame) -> DataFrame:
    return encounters.select(
        uuid_id("id").alias("visit_occurrence_id"),
        uuid_id("patient").alias("person_id"),
        uuid_id("provider").alias("provider_id"),
        uuid_id("organization").alias("care_site_id"),
        parse_datetime("start").alias("visit_start_datetime"),
        parse_datetime("stop").alias("visit_end_datetime"),
        visit_concept("encounterClass").alias("visit_concept_id"),
        _long(VISIT_TYPE, "visit_type_concept_id"),
    )


def to_notes(encounters: DataFrame) -> DataFrame:
    """One placeholder note per encounter.  Ids and times are computed once and then used several times."""
    parsed = encounters.select(
        surrogate_key("note", ["id"]).alias("note_id"),
        uuid_id("id").alias("visit"),
        uuid_id("patient").alias("person_id"),
        uuid_id("provider").alias("provider_id"),
        uuid_id("organization").alias("care_site_id"),
        parse_datetime("start").alias("start"),
    )
    visit, start = F.col("visit"), F.col("start")
    return parsed.select(
        "note_id",
        "care_site_id",
        _long(NOTE_TYPE, "note_class_concept_id"),
        F.lit("").alias("note_class_source_value"),
        start.alias("note_datetime"),
        _long(NOTE_EVENT_FIELD, "note_event_field_concept_id"),
        F.lit(NOTE_TITLE).alias("note_title"),
        _long(NOTE_TYPE, "note_type_concept_id"),
        F.lit("").alias("note_type_source_value"),
        "person_id",
        "provider_id",
        visit.alias("visit_detail_id"),
        visit.alias("visit_occurrence_id"),
        F.lit(NOTE_TEXT).alias("note_text"),
        F.lit(None).cast("timestamp").alias("delete_datetime"),
        _long(0, "encoding_concept_id"),
        start.alias("insert_datetime"),
        F.lit(False).alias("is_pdf_available"),
        _long(LANGUAGE, "language_concept_id"),
        visit.alias("note_event_id"),
        start.alias("update_datetime"),
        _long(NOTE_FINAL, "row_status_source_concept_id"),
    )


def to_care_sites(organizations: DataFrame) -> DataFrame:
    return organizations.select(uuid_id("id").alias("care_site_id"), F.col("name").alias("care_site_name"))


def _events(frame: DataFrame, texts: Sequence[str], row_id: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The columns of an event and those that together tell it from all others.

    UUIDs become numbers first, which keeps the rows that have to be counted short.
    """
    extra = [column for column in row_id if column not in texts]
    rows = frame.select(
        *(F.col(column).alias(column) for column in (*texts, *extra)),
        uuid_id("patient").alias("person_id"),
        uuid_id("encounter").alias("visit_occurrence_id"),
    )
    if row_id:
        return rows, rows.columns
    return number_copies(rows), [*rows.columns, "copy"]


def to_condition_occurrences(conditions: DataFrame, row_id: Sequence[str] = ()) -> DataFrame:
    rows, identity = _events(conditions, ["start", "stop", "code"], row_id)
    return rows.select(
        F.col("code").alias("condition_source_value"),
        surrogate_key("condition_occurrence", identity).alias("condition_occurrence_id"),
        parse_date_as_timestamp("start").alias("condition_start_datetime"),
        parse_date_as_timestamp("stop").alias("condition_end_datetime"),
        "visit_occurrence_id",
        "person_id",
        F.lit(VOCABULARY).alias("condition_type_source_value"),
    )


def to_procedure_occurrences(procedures: DataFrame, row_id: Sequence[str] = ()) -> DataFrame:
    rows, identity = _events(procedures, ["code", "date"], row_id)
    return rows.select(
        F.col("code").alias("procedure_source_value"),
        surrogate_key("procedure_occurrence", identity).alias("procedure_occurrence_id"),
        F.lit(VOCABULARY).alias("procedure_type_source_value"),
        parse_datetime("date").alias("procedure_datetime"),
        "person_id",
        "visit_occurrence_id",
        _long(PROCEDURE_COMPLETED, "row_status_source_concept_id"),
    )


def to_costs(procedures: DataFrame, row_id: Sequence[str] = ()) -> DataFrame:
    """One cost row per procedure; the date may be written with or without a time."""
    rows, identity = _events(procedures, ["date"], row_id)
    return rows.select(
        surrogate_key("cost", identity).alias("cost_id"),
        parse_day("date").alias("incurred_datetime"),
        "person_id",
        _long(CLAIM_DIAGNOSIS, "drg_source_concept_id"),
        _long(CLAIM_ACTIVE, "row_status_source_concept_id"),
        _long(COST_EVENT_FIELD, "cost_event_field_concept_id"),
        F.col("visit_occurrence_id").alias("cost_event_id"),
    )


def to_providers(providers: DataFrame) -> DataFrame:
    return providers.select(
        F.col("name").alias("provider_name"),
        uuid_id("id").alias("provider_id"),
        F.col("id").alias("provider_source_value"),
        F.col("id").alias("npi"),
        F.col("id").alias("dea"),
        uuid_id("organization").alias("care_site_id"),
        F.lit(True).alias("is_active"),
        gender_concept("gender").alias("gender_concept_id"),
    )


def convert(source: Bundle, row_ids: Mapping[str, Sequence[str]] | None = None) -> Bundle:
    """All seventeen target tables, lazily; six of them are empty.

    ``row_ids`` may name, for ``conditions`` and ``procedures``, the columns that tell source rows apart.  When more
    than one target table is written, keep the source on storage first (``SupplyCache.bundle``): conditions and
    procedures feed two and three target tables.
    """
    source.as_source()
    row_ids = row_ids or {}
    condition_id, procedure_id = row_ids.get("conditions", ()), row_ids.get("procedures", ())
    spark = source["patients"].sparkSession
    empty = ("visit_detail", "cohort_definition", "cohort", "role", "care_site_history", "fact_relationship")
    return Bundle(
        {
            "concept_fhir": to_concepts(source["conditions"], source["procedures"]),
            "person": to_persons(source["patients"]),
            "observation": to_observations(source["patients"]),
            "visit_occurrence": to_visit_occurrences(source["encounters"]),
            "note": to_notes(source["encounters"]),
            "care_site": to_care_sites(source["organizations"]),
            "condition_occurrence": to_condition_occurrences(source["conditions"], condition_id),
            "procedure_occurrence": to_procedure_occurrences(source["procedures"], procedure_id),
            "provider": to_providers(source["providers"]),
            "cost": to_costs(source["procedures"], procedure_id),
            "location": to_locations(source["patients"]),
            **{table: empty_table(spark, table) for table in empty},
        }
    ).as_target()
