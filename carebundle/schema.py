"""The seventeen target tables in the column order of their contract, and the Avro form of a schema."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

SOURCE_TABLES = ("patients", "encounters", "organizations", "conditions", "procedures", "providers")

# The columns of the target tables in the order of their contract, with their types.
_COLUMNS = {
    "concept_fhir": """
        concept_id bigint, concept_code string, concept_name string, fhir_concept_code string,
        fhir_concept_name string, fhir_vocabulary_reference string, key string, hash bigint,
        insert_datetime timestamp, update_datetime timestamp, delete_datetime timestamp, change_datetime timestamp,
        vocabulary_reference string, row_id bigint
    """,
    "person": """
        person_id bigint, delete_datetime timestamp, gender_source_concept_id bigint, hash bigint,
        insert_datetime timestamp, key string, birth_datetime timestamp, death_datetime timestamp,
        update_datetime timestamp, change_datetime timestamp, person_source_value string, location_id bigint,
        provider_id bigint, care_site_id bigint, year_of_birth bigint, month_of_birth bigint, day_of_birth bigint,
        race_concept_id bigint, race_source_value string, race_source_concept_id bigint, ethnicity_concept_id bigint,
        ethnicity_source_value string, ethnicity_source_concept_id bigint, gender_concept_id bigint,
        gender_source_value string, row_status_concept_id bigint, row_status_source_value string,
        row_status_source_concept_id bigint, row_id bigint
    """,
    "observation": """
        observation_id bigint, observation_datetime timestamp, update_datetime timestamp, value_as_string string,
        observation_type_concept_id bigint, hash bigint, key string, obs_event_field_concept_id bigint,
        observation_source_concept_id bigint, visit_detail_id bigint, visit_occurrence_id bigint,
        insert_datetime timestamp, delete_datetime timestamp, change_datetime timestamp, person_id bigint,
        provider_id bigint, observation_date date, observation_concept_id bigint, observation_source_value string,
        observation_type_source_value string, observation_type_source_concept_id bigint, value_as_number double,
        value_source_as_number double, value_as_concept_id bigint, value_source_as_concept_id bigint,
        value_as_datetime timestamp, value_source_value string, qualifier_concept_id bigint,
        qualifier_source_value string, unit_concept_id bigint, unit_source_value string,
        unit_source_concept_id bigint, observation_event_id bigint, row_status_concept_id bigint,
        row_status_source_value string, row_status_source_concept_id bigint, row_id bigint
    """,
    "visit_occurrence": """
        visit_occurrence_id bigint, admitted_from_source_value string, delete_datetime timestamp,
        discharge_to_source_value string, hash bigint, insert_datetime timestamp, key string, person_id bigint,
        preceding_visit_occurrence_id bigint, update_datetime timestamp, visit_end_datetime timestamp,
        visit_source_value string, visit_start_datetime timestamp, visit_type_source_value string,
        admitted_from_source_concept_id bigint, care_site_id bigint, discharge_to_source_concept_id bigint,
        provider_id bigint, row_status_source_concept_id bigint, visit_source_concept_id bigint,
        change_datetime timestamp, visit_occurrence_source_value string, visit_start_date date, visit_end_date date,
        visit_concept_id bigint, visit_type_concept_id bigint, visit_type_source_concept_id bigint,
        admitted_from_concept_id bigint, discharge_to_concept_id bigint, row_status_concept_id bigint,
        row_status_source_value string, row_id bigint
    """,
    "visit_detail": """
        visit_detail_id bigint, admitted_from_source_value string, delete_datetime timestamp,
        discharge_to_source_value string, hash bigint, insert_datetime timestamp, key string, person_id bigint,
        preceding_visit_detail_id bigint, update_datetime timestamp, visit_detail_end_datetime timestamp,
        visit_detail_source_value string, visit_detail_start_datetime timestamp,
        visit_detail_type_source_value string, visit_occurrence_id bigint, visit_detail_parent_id bigint,
        admitted_from_source_concept_id bigint, care_site_id bigint, discharge_to_source_concept_id bigint,
        provider_id bigint, row_status_source_concept_id bigint, visit_detail_source_concept_id bigint,
        change_datetime timestamp, visit_detail_start_date date, visit_detail_end_date date,
        visit_detail_concept_id bigint, visit_detail_type_concept_id bigint,
        visit_detail_type_source_concept_id bigint, admitted_from_concept_id bigint, discharge_to_concept_id bigint,
        row_status_concept_id bigint, row_status_source_value string, row_id bigint
    """,
    "note": """
        note_id bigint, care_site_id bigint, note_class_concept_id bigint, note_class_source_value string,
        note_datetime timestamp, note_event_field_concept_id bigint, note_title string, note_type_concept_id bigint,
        note_type_source_value string, person_id bigint, provider_id bigint, visit_detail_id bigint,
        visit_occurrence_id bigint, note_text string, delete_datetime timestamp, encoding_concept_id bigint,
        insert_datetime timestamp, is_pdf_available boolean, language_concept_id bigint, note_event_id bigint,
        update_datetime timestamp, note_class_source_concept_id bigint, row_status_source_concept_id bigint,
        row_id bigint, key string, hash bigint, change_datetime timestamp, note_source_value string, note_date date,
        note_type_source_concept_id bigint, row_status_concept_id bigint, row_status_source_value string
    """,
    "care_site": """
        care_site_id bigint, care_site_name string, care_site_short_name string, care_site_source_value string,
        place_of_service_concept_id bigint, place_of_service_source_value string, location_id bigint,
        place_of_service_source_concept_id string, key string, hash bigint, insert_datetime timestamp,
        update_datetime timestamp, delete_datetime timestamp, change_datetime timestamp, valid_start_date date,
        valid_end_date date, care_site_type_concept_id bigint, care_site_type_source_value string,
        care_site_type_source_concept_id bigint, row_id bigint
    """,
    "condition_occurrence": """
        condition_occurrence_id bigint, condition_end_datetime timestamp, condition_start_datetime timestamp,
        person_id bigint, visit_occurrence_id bigint, condition_source_concept_id bigint,
        condition_status_source_concept_id bigint, condition_type_source_concept_id bigint, key string, hash bigint,
        insert_datetime timestamp, update_datetime timestamp, delete_datetime timestamp, change_datetime timestamp,
        visit_detail_id bigint, provider_id bigint, condition_start_date date, condition_end_date date,
        condition_concept_id bigint, condition_source_value string, condition_type_concept_id bigint,
        condition_type_source_value string, condition_status_concept_id bigint, condition_status_source_value string,
        stop_reason string, row_status_concept_id bigint, row_status_source_value string,
        row_status_source_concept_id bigint, row_id bigint
    """,
    "procedure_occurrence": """
        procedure_occurrence_id bigint, delete_datetime timestamp, hash bigint, insert_datetime timestamp, key string,
        person_id bigint, procedure_datetime timestamp, provider_id bigint, update_datetime timestamp,
        visit_detail_id bigint, visit_occurrence_id bigint, procedure_concept_id bigint,
        procedure_source_concept_id bigint, change_datetime timestamp, procedure_date date,
        procedure_source_value string, procedure_type_concept_id bigint, procedure_type_source_value string,
        procedure_type_source_concept_id bigint, modifier_concept_id bigint, modifier_source_value string,
        quantity bigint, row_status_concept_id bigint, row_status_source_value string,
        row_status_source_concept_id bigint, row_id bigint
    """,
    "provider": """
        provider_id bigint, auth_type string, care_site_id bigint, creation_datetime timestamp, birth_date timestamp,
        dea string, delete_datetime timestamp, email string, firstname string, hash bigint, insert_datetime timestamp,
        invalid_reason string, is_active boolean, key string, last_login_datetime timestamp, lastname string,
        modified_datetime timestamp, npi string, password string, provider_name string, provider_source_value string,
        update_datetime timestamp, valid_end_datetime timestamp, valid_start_datetime timestamp, year_of_birth bigint,
        gender_source_concept_id bigint, change_datetime timestamp, gender_concept_id bigint,
        gender_source_value string, specialty_concept_id bigint, specialty_source_value string,
        specialty_source_concept_id bigint, row_id bigint
    """,
    "cost": """
        cost_id bigint, incurred_datetime date, person_id bigint, drg_source_concept_id bigint,
        row_status_source_concept_id bigint, key string, hash bigint, insert_datetime timestamp,
        update_datetime timestamp, delete_datetime timestamp, change_datetime timestamp, cost_event_id bigint,
        cost_event_field_concept_id bigint, cost_concept_id bigint, cost_source_value string,
        cost_source_concept_id bigint, cost_type_concept_id bigint, cost_type_source_value string,
        cost_type_source_concept_id bigint, currency_concept_id bigint, cost double, incurred_date date,
        billed_date date, paid_date date, revenue_code_concept_id bigint, drg_concept_id bigint,
        drg_source_value string, revenue_code_source_value string, payer_plan_period_id bigint,
        row_status_concept_id bigint, row_status_source_value string, row_id bigint
    """,
    "location": """
        location_id bigint, address string, address_1 string, address_2 string, city string, country string,
        delete_datetime timestamp, insert_datetime timestamp, latitude double, longitude double, state string,
        update_datetime timestamp, key string, hash bigint, change_datetime timestamp, zip string, county string,
        location_source_value string, row_id bigint
    """,
    "cohort_definition": """
        cohort_definition_id bigint, owner_entity_id bigint, cohort_definition_description string,
        cohort_definition_name string, cohort_definition_syntax string, cohort_initiation_datetime timestamp,
        cohort_size bigint, owner_domain_id string, invalid_reason string, subject_concept_id bigint,
        valid_end_datetime timestamp, valid_start_datetime timestamp, key string, hash bigint,
        insert_datetime timestamp, update_datetime timestamp, delete_datetime timestamp, change_datetime timestamp,
        cohort_definition_source_value string, definition_type_concept_id bigint, subject_source_concept_id bigint,
        row_id bigint
    """,
    "cohort": """
        cohort_id bigint, delete_datetime timestamp, cohort_end_datetime timestamp, invalid_reason string,
        cohort_start_datetime timestamp, key string, hash bigint, insert_datetime timestamp,
        update_datetime timestamp, change_datetime timestamp, cohort_definition_id bigint, subject_id bigint,
        row_id bigint
    """,
    "role": """
        role_id bigint, delete_datetime timestamp, hash bigint, insert_datetime timestamp, key string, name string,
        update_datetime timestamp, change_datetime timestamp, right_read_data_nominative boolean,
        right_read_data_pseudo_anonymised boolean, right_write_data boolean, right_read_users boolean,
        right_write_users boolean, valid_start_date timestamp, valid_end_date timestamp, invalid_reason string
    """,
    "care_site_history": """
        care_site_history_id bigint, care_site_id bigint, delete_datetime timestamp, end_date date, hash bigint,
        insert_datetime timestamp, key string, start_date date, update_datetime timestamp, entity_id bigint,
        change_datetime timestamp, role_id bigint, relationship_type_concept_id bigint, domain_id string,
        row_id bigint
    """,
    "fact_relationship": """
        hash bigint, delete_datetime timestamp, insert_datetime timestamp, key string, update_datetime timestamp,
        fact_id_1 bigint, fact_id_2 bigint, domain_concept_id_1 bigint, domain_concept_id_2 bigint,
        change_datetime timestamp, fact_relationship_id bigint, relationship_concept_id bigint, row_id bigint
    """,
}

_TYPES = {
    "bigint": T.LongType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}
_FIELDS = {
    table: {name: _TYPES[kind] for name, kind in (column.split() for column in columns.split(","))}
    for table, columns in _COLUMNS.items()
}

TARGET_TABLES = tuple(_FIELDS)


def primary_key(table: str) -> str:
    return "concept_id" if table == "concept_fhir" else f"{table}_id"


def column_type(table: str, column: str) -> T.DataType:
    return _FIELDS[table][column]


def target_schema(table: str) -> T.StructType:
    """The columns of a target table in the order of its contract; all may be null."""
    if table not in _FIELDS:
        raise KeyError(f"unknown target table {table!r}")
    return T.StructType([T.StructField(name, kind) for name, kind in _FIELDS[table].items()])


def target_schemas() -> dict[str, T.StructType]:
    return {table: target_schema(table) for table in TARGET_TABLES}


# --- Avro form ---------------------------------------------------------------------------------------------

_TO_AVRO = {
    T.BooleanType: "boolean",
    T.ByteType: "int",
    T.ShortType: "int",
    T.IntegerType: "int",
    T.LongType: "long",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.StringType: "string",
    T.BinaryType: "bytes",
    T.DateType: {"type": "int", "logicalType": "date"},
    T.TimestampType: {"type": "long", "logicalType": "timestamp-micros"},
    T.TimestampNTZType: {"type": "long", "logicalType": "local-timestamp-micros"},
}
_FROM_AVRO = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
    "date": T.DateType(),
    "timestamp-millis": T.TimestampType(),
    "timestamp-micros": T.TimestampType(),
    "local-timestamp-millis": T.TimestampNTZType(),
    "local-timestamp-micros": T.TimestampNTZType(),
}


def _avro_type(data_type: T.DataType, name: str):
    if isinstance(data_type, T.StructType):
        fields = []
        for field in data_type.fields:
            inner = _avro_type(field.dataType, f"{name}_{field.name}")
            fields.append({"name": field.name, "type": [inner, "null"] if field.nullable else inner})
        return {"type": "record", "name": name, "fields": fields}
    if isinstance(data_type, T.ArrayType):
        inner = _avro_type(data_type.elementType, name)
        return {"type": "array", "items": [inner, "null"] if data_type.containsNull else inner}
    if isinstance(data_type, T.MapType) and isinstance(data_type.keyType, T.StringType):
        inner = _avro_type(data_type.valueType, name)
        return {"type": "map", "values": [inner, "null"] if data_type.valueContainsNull else inner}
    if isinstance(data_type, T.DecimalType):
        return {
            "type": "bytes",
            "logicalType": "decimal",
            "precision": data_type.precision,
            "scale": data_type.scale,
        }
    if type(data_type) not in _TO_AVRO:
        raise TypeError(f"no Avro type for {data_type.simpleString()}")
    return _TO_AVRO[type(data_type)]


def _spark_type(avro) -> tuple[T.DataType, bool]:
    """Spark type and nullability of an Avro type."""
    if isinstance(avro, list):
        members = [member for member in avro if member != "null"]
        if len(members) != 1:
            raise TypeError(f"only unions of one type with null are supported: {avro}")
        return _spark_type(members[0])[0], len(members) < len(avro)
    if isinstance(avro, str):
        if avro not in _FROM_AVRO:
            raise TypeError(f"unsupported Avro type {avro!r}")
        return _FROM_AVRO[avro], False
    kind, logical = avro["type"], avro.get("logicalType")
    if kind == "record":
        fields = [T.StructField(field["name"], *_spark_type(field["type"])) for field in avro["fields"]]
        return T.StructType(fields), False
    if kind == "array":
        return T.ArrayType(*_spark_type(avro["items"])), False
    if kind == "map":
        return T.MapType(T.StringType(), *_spark_type(avro["values"])), False
    if logical == "decimal":
        return T.DecimalType(avro["precision"], avro.get("scale", 0)), False
    return _spark_type(logical if logical in _FROM_AVRO else kind)


def to_avro_json(schema: T.StructType, name: str = "topLevelRecord") -> str:
    return json.dumps(_avro_type(schema, name), indent=2)


def from_avro_json(text: str) -> T.StructType:
    schema, _ = _spark_type(json.loads(text))
    if not isinstance(schema, T.StructType):
        raise TypeError("the Avro schema is not a record")
    return schema


def read_avro_schemas(spark: SparkSession, directory: str, tables: Iterable[str]) -> dict[str, T.StructType]:
    """Schemas from ``<directory>/<table>.avro`` files that hold Avro schema JSON."""
    from carebundle.sources.storage import read_text

    return {table: from_avro_json(read_text(spark, f"{directory.rstrip('/')}/{table}.avro")) for table in tables}
