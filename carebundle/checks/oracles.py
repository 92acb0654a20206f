"""The results of the queries as SQL for DuckDB, written without looking at the plans."""

from __future__ import annotations

import re
from pathlib import Path

# The documented schemas are the list to compare with, not those of the package.
_FIXTURES = Path(__file__).resolve().parents[2] / "FIXTURES.md"
_KINDS = {"L": "bigint", "S": "string", "F": "double", "B": "boolean", "T": "timestamp", "D": "date"}
_SQL_TYPES = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def documented_schemas() -> dict[str, list[tuple[str, str]]]:
    """(name, type) of the columns of every target table in order, from FIXTURES.md."""
    tables = {}
    for line in _FIXTURES.read_text().splitlines():
        row = re.match(r"\| `(\w+)` *\| \d+ \| ([^|]*:[LSFBTD]\b[^|]*) \|", line)
        if row:
            tables[row[1]] = [(name, _KINDS[kind]) for name, kind in (item.split(":") for item in row[2].split())]
    return tables


UUID_SHAPE = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
CLOCK = "'%Y-%m-%dT%H:%MZ'"


def _uuid(kind: str, key: str) -> str:
    shape = r"'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5'"
    return f"regexp_replace(md5('{kind}|' || ({key})::varchar), {shape})"


def _id(uuid: str) -> str:
    value = f"try_cast('0x' || right(replace({uuid}, '-', ''), 16) as ubigint)::hugeint"
    absolute = f"case when {value} >= 9223372036854775808 then 18446744073709551616 - {value} else {value} end"
    return f"(case when regexp_full_match({uuid}, '{UUID_SHAPE}') then ({absolute})::bigint end)"


def _key(table: str, *columns: str) -> str:
    parts = [
        f"coalesce(length(({column})::varchar)::varchar || ':' || ({column})::varchar, '~')" for column in columns
    ]
    digest = f"md5('{table}|' || {" || '|' || ".join(parts)})"
    return f"(('0x' || substr({digest}, 1, 16))::ubigint & 9223372036854775807::ubigint)::bigint"


def _datetime(text: str) -> str:
    return f"try_strptime({text}, {CLOCK})"


def _date(text: str) -> str:
    return f"try_strptime({text}, '%Y-%m-%d')::date"


def _midnight(text: str) -> str:
    return f"try_strptime({text}, '%Y-%m-%d')"


def _gender(code: str) -> str:
    return f"(case {code} when 'M' then 8507::bigint when 'F' then 8532::bigint end)"


def _day_text(date: str) -> str:
    return f"strftime({date}, '%Y-%m-%d')"


_BIRTH = "(date '1930-01-01' + (c_custkey % 30000)::int)"

SOURCES = {
    "patients": f"""
select {_uuid("patient", "c_custkey")} as id,
       {_day_text(_BIRTH)} as birthdate,
       case when c_custkey % 10 = 0 then {_day_text(f"({_BIRTH} + 20000)")} end as deathdate,
       '999-' || lpad((c_custkey % 100)::varchar, 2, '0') || '-' || lpad((c_custkey % 10000)::varchar, 4, '0') as ssn,
       case when c_custkey % 17 <> 0 then 'Given' || (c_custkey % 1000)::varchar end as first,
       c_name as last,
       case when c_custkey % 23 = 0 then 'U' when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
       (c_custkey % 997)::varchar || ' Main Street' as address,
       n_name as city,
       r_name as state,
       case when c_custkey % 31 = 0 then 'unknown'
            else (c_custkey % 90)::varchar || '.' || lpad((c_custkey % 100)::varchar, 2, '0') end as lat,
       '-' || (c_custkey % 180)::varchar || '.' || lpad((c_custkey % 100)::varchar, 2, '0') as lon
from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
    "encounters": f"""
select {_uuid("encounter", "o_orderkey")} as id,
       {_uuid("patient", "o_custkey")} as patient,
       {_uuid("provider", "s_suppkey")} as provider,
       {_uuid("organization", "s_nationkey")} as organization,
       strftime(o_orderdate, {CLOCK}) as start,
       strftime(o_orderdate + to_hours((o_orderkey % 72)::int), {CLOCK}) as stop,
       case o_orderkey % 7 when 0 then 'inpatient' when 1 then 'ambulatory' when 2 then 'outpatient'
            when 3 then 'wellness' when 4 then 'emergency' when 5 then 'urgentcare' else 'hospice'
       end as "encounterClass"
from orders left join supplier on o_orderkey % (select count(*) from supplier) = s_suppkey""",
    "organizations": f"""
select {_uuid("organization", "n_nationkey")} as id, n_name as name from nation""",
    "providers": f"""
select {_uuid("provider", "s_suppkey")} as id, s_name as name, {_uuid("organization", "s_nationkey")} as organization,
       case when s_suppkey % 11 = 0 then 'U' when s_suppkey % 2 = 0 then 'F' else 'M' end as gender
from supplier""",
    "conditions": f"""
select {_day_text("l_shipdate")} as start,
       case when l_linenumber <> 3 then {_day_text("(l_shipdate::date + l_quantity::int)")} end as stop,
       {_uuid("encounter", "l_orderkey")} as encounter,
       {_uuid("patient", "o_custkey")} as patient,
       p_brand as code,
       p_type as description,
       l_linenumber::varchar || '-' || l_partkey::varchar || '-' || l_suppkey::varchar as line
from lineitem left join part on l_partkey = p_partkey left join orders on l_orderkey = o_orderkey
where l_returnflag = 'R'""",
    "procedures": f"""
select {_day_text("l_shipdate")} || 'T' || lpad(l_linenumber::varchar, 2, '0') || ':00Z' as date,
       {_uuid("encounter", "l_orderkey")} as encounter,
       {_uuid("patient", "o_custkey")} as patient,
       'P-' || p_brand as code,
       p_type as description,
       l_linenumber::varchar || '-' || l_partkey::varchar || '-' || l_suppkey::varchar as line
from lineitem left join part on l_partkey = p_partkey left join orders on l_orderkey = o_orderkey
where l_returnflag <> 'R'""",
}

# The concepts of every converted bundle.
_BUILTINS = """
select * from (values
  (1001, '8532', 'female', 'administrative-gender', 'female', 'female', 'http://hl7.org/fhir/administrative-gender'),
  (1002, '8507', 'male', 'administrative-gender', 'male', 'male', 'http://hl7.org/fhir/administrative-gender'),
  (4082735, '182992009', 'Treatment completed', 'SNOMED', 'completed', 'completed',
   'http://hl7.org/fhir/procedure-status'),
  (1003, 'XXX', 'XXX', 'referred-document-status', 'final', 'final', 'http://hl7.org/fhir/referred-document-status'),
  (1004, 'XXX', 'XXX', 'referred-document-status', 'active', 'active', 'http://hl7.org/fhir/claim-status'),
  (1005, 'XXX', 'XXX', 'FIXME', 'FIXME', 'FIXME', 'FIXME'),
  (2008111363, 'Actif', 'actif', 'name', 'not used', 'not used', 'not used'),
  (2002861901, '3042942', 'first', 'name', 'not used', 'not used', 'not used'),
  (2002861897, '3046810', 'last', 'name', 'not used', 'not used', 'not used'),
  (2002861900, '398093005', 'last', 'name', 'not used', 'not used', 'not used')
)"""

_NOTE_TEXT = (
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit,\n"
    + " " * 40
    + "sed do eiusmod tempor incididunt ut labore et dolore magna aliqua."
)


def _numbered(source: str, texts: str) -> str:
    """Events with a number among the events equal to them; any order does, since they are equal."""
    return f"""(select *, row_number() over (partition by {texts}, person, visit) as copy from {_events(source)})"""


def _events(source: str) -> str:
    return f"""(select *, {_id("patient")} as person, {_id("encounter")} as visit from {source})"""


def _conditions(rows: str, *identity: str) -> str:
    return f"""
select code as condition_source_value,
       {_key("condition_occurrence", "start", "stop", "code", *identity)} as condition_occurrence_id,
       {_midnight("start")} as condition_start_datetime,
       {_midnight("stop")} as condition_end_datetime,
       visit as visit_occurrence_id,
       person as person_id,
       'SNOMED' as condition_type_source_value
from {rows}"""


def _procedures(rows: str, *identity: str) -> str:
    return f"""
select code as procedure_source_value,
       {_key("procedure_occurrence", "code", "date", *identity)} as procedure_occurrence_id,
       'SNOMED' as procedure_type_source_value,
       {_datetime("date")} as procedure_datetime,
       person as person_id,
       visit as visit_occurrence_id,
       4082735::bigint as row_status_source_concept_id
from {rows}"""


def _costs(rows: str, *identity: str) -> str:
    return f"""
select {_key("cost", "date", *identity)} as cost_id,
       {_datetime("date")}::date as incurred_datetime,
       person as person_id,
       1005::bigint as drg_source_concept_id,
       1004::bigint as row_status_source_concept_id,
       1147624::bigint as cost_event_field_concept_id,
       visit as cost_event_id
from {rows}"""


_BY_COPY = ("person", "visit", "copy")
_BY_LINE = ("line", "person", "visit")

TARGETS = {
    "concept_fhir": f"""
select {_key("concept_fhir", "code")} as concept_id, code as concept_code, min(description) as concept_name,
       'SNOMED' as vocabulary_reference, code as fhir_concept_code, min(description) as fhir_concept_name,
       'SNOMED' as fhir_vocabulary_reference
from (select code, description from conditions union all select code, description from procedures) group by code
union all {_BUILTINS}""",
    "person": f"""
select {_id("id")} as person_id,
       {_gender("gender")} as gender_concept_id,
       {_midnight("birthdate")} as birth_datetime,
       {_midnight("deathdate")} as death_datetime,
       case gender when 'M' then 1001::bigint when 'F' then 1002::bigint end as gender_source_concept_id,
       2008111363::bigint as row_status_source_concept_id
from patients""",
    "observation": f"""
select value_as_string, observation_concept_id::bigint as observation_concept_id,
       observation_source_concept_id::bigint as observation_source_concept_id, {_id("id")} as person_id
from (select id, first as value_as_string, 3042942 as observation_concept_id,
             2002861901 as observation_source_concept_id from patients where first is not null
      union all select id, last, 3046810, 2002861897 from patients where first is not null
      union all select id, ssn, 398093005, 2002861900 from patients where first is not null)""",
    "visit_occurrence": f"""
select {_id("id")} as visit_occurrence_id, {_id("patient")} as person_id, {_id("provider")} as provider_id,
       {_id("organization")} as care_site_id,
       {_datetime("start")} as visit_start_datetime, {_datetime("stop")} as visit_end_datetime,
       case when "encounterClass" = 'inpatient' then 9201::bigint
            when "encounterClass" in ('ambulatory', 'outpatient', 'wellness') then 9202::bigint
            when "encounterClass" in ('emergency', 'urgentcare') then 9203::bigint end as visit_concept_id,
       44818517::bigint as visit_type_concept_id
from encounters""",
    "note": f"""
select {_key("note", "id")} as note_id, {_id("organization")} as care_site_id,
       44814639::bigint as note_class_concept_id, '' as note_class_source_value, {_datetime("start")} as note_datetime,
       1147332::bigint as note_event_field_concept_id, 'A simple lorem ipsum' as note_title,
       44814639::bigint as note_type_concept_id, '' as note_type_source_value, {_id("patient")} as person_id,
       {_id("provider")} as provider_id, {_id("id")} as visit_detail_id, {_id("id")} as visit_occurrence_id,
       '{_NOTE_TEXT}' as note_text, null::timestamp as delete_datetime, 0::bigint as encoding_concept_id,
       {_datetime("start")} as insert_datetime, false as is_pdf_available, 4180186::bigint as language_concept_id,
       {_id("id")} as note_event_id, {_datetime("start")} as update_datetime,
       1003::bigint as row_status_source_concept_id
from encounters""",
    "care_site": f"select {_id('id')} as care_site_id, name as care_site_name from organizations",
    "condition_occurrence": _conditions(_numbered("conditions", "start, stop, code"), *_BY_COPY),
    "procedure_occurrence": _procedures(_numbered("procedures", "code, date"), *_BY_COPY),
    "cost": _costs(_numbered("procedures", "date"), *_BY_COPY),
    "provider": f"""
select name as provider_name, {_id("id")} as provider_id, id as provider_source_value, id as npi, id as dea,
       {_id("organization")} as care_site_id, true as is_active, {_gender("gender")} as gender_concept_id
from providers""",
    "location": f"""
select address, city, state, try_cast(lat as double) as latitude, try_cast(lon as double) as longitude,
       {_key("location", "id")} as location_id
from patients""",
}

# Tables that other tables are made from.
_PARENTS = {
    "concept_fhir": ("conditions", "procedures"),
    "person": ("patients",),
    "observation": ("patients",),
    "location": ("patients",),
    "visit_occurrence": ("encounters",),
    "note": ("encounters",),
    "care_site": ("organizations",),
    "condition_occurrence": ("conditions",),
    "procedure_occurrence": ("procedures",),
    "cost": ("procedures",),
    "provider": ("providers",),
}


def _with(names: tuple[str, ...], select: str, **extra: str) -> str:
    """A query over some source and target tables, given as common table expressions."""
    needed = dict.fromkeys([parent for name in names for parent in _PARENTS.get(name, ())])
    needed |= dict.fromkeys(names)
    parts = {name: SOURCES.get(name) or TARGETS[name] for name in needed} | extra
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in parts.items()) + "\n" + select


def _target(name: str) -> str:
    return _with(_PARENTS[name], TARGETS[name])


def _nulls(columns: dict[str, str]) -> str:
    return ", ".join(f"null::{kind} as {name}" for name, kind in columns.items())


def _absent_person_columns() -> str:
    present = {
        "person_id", "gender_concept_id", "birth_datetime", "death_datetime", "gender_source_concept_id",
        "row_status_source_concept_id",
    }
    return _nulls({name: _SQL_TYPES[kind] for name, kind in documented_schemas()["person"] if name not in present})


_SIBLINGS = {
    "gender_type_source_value": "VARCHAR", "gender_type_source_concept_id": "BIGINT", "gender_type_concept_id": "BIGINT",
    "gender_source_value": "VARCHAR", "row_status_type_source_value": "VARCHAR",
    "row_status_type_source_concept_id": "BIGINT", "row_status_type_concept_id": "BIGINT",
    "row_status_source_value": "VARCHAR", "row_status_concept_id": "BIGINT",
}

_EMPTY_TARGETS = ("visit_detail", "cohort_definition", "cohort", "role", "care_site_history", "fact_relationship")


def _cohort(name: str, site: int, condition: str = "true") -> str:
    definition = _key("cohort_definition", f"'{name}'", str(site))
    return f"""
select {_key("cohort", definition, "person_id")} as cohort_id, {definition} as cohort_definition_id,
       person_id as subject_id from person where {condition}"""


def _orphans(table: str, column: str, target: str) -> str:
    return f"""
select '{table}' as table_name, '{column}' as column_name, count(*)::bigint as n from {table}
where {column} is not null and {column} not in (select {target}_id from {target}) having count(*) > 0"""


_WRONG_ERRORS = (
    ("person", 'table person: column hash is "integer" where the schema wants "long"'),
    ("provider", "table provider: the schema does not know the columns nickname"),
    ("care_site", "table care_site: lacks the columns opened"),
)
# The given table whose rows a target table is made of, if it is a single one.
_GIVEN = {
    "person": "customer", "location": "customer", "visit_occurrence": "orders", "note": "orders", "care_site": "nation",
    "provider": "supplier",
}


def _schema_columns() -> str:
    counts = " ".join(f"when '{table}' then (select count(*) from {given})" for table, given in _GIVEN.items())
    rows = [
        f"('{table}', {position}, '{name}', '{kind}')"
        for table, columns in documented_schemas().items()
        for position, (name, kind) in enumerate(columns)
    ]
    return f"""
select table_name, position::bigint as position, column_name, type, case table_name {counts} end as n_rows
from (values {", ".join(rows)}) as t(table_name, position, column_name, type)"""


_SOURCE_COLUMNS = {
    "patients": "id birthdate deathdate ssn first last gender address city state lat lon",
    "encounters": "id patient provider organization start stop encounterClass",
    "organizations": "id name",
    "conditions": "start stop encounter patient code description line",
    "procedures": "date encounter patient code description line",
    "providers": "id name organization gender",
}


def _fingerprint(table: str, columns: str) -> str:
    quoted = [f'"{name}"' for name in columns.split()]
    return f"""
select '{table}' as table_name, count(*) as n,
       (sum({_key(table, *quoted)}::hugeint) % 1000000007)::bigint as fingerprint from {table}"""


def _fingerprints(columns: dict[str, str]) -> str:
    return _with(tuple(columns), " union all ".join(_fingerprint(*item) for item in columns.items()))


_ORDER_UUID = _uuid("encounter", "o_orderkey")
_MEN, _WOMEN = ("men", 10, "gender_concept_id = 8507"), ("women", 20, "gender_concept_id = 8532")
_ROLE = "(case when gender_concept_id is null then 200::bigint else 100::bigint end)"
_GRANT = _key("care_site_history", _ROLE, "provider_id", "care_site_id")


_PROVIDER = "provider_name provider_id provider_source_value npi dea care_site_id is_active gender_concept_id"


_NEW_ROWS = "timestamp '2021-01-01'"
_OLD_ROWS = "timestamp '2020-01-01'"


def _version(change: str, condition: str, price: str, **stamps: str) -> str:
    names = ("insert_datetime", "update_datetime", "delete_datetime", "change_datetime")
    times = ", ".join(f"{stamps.get(name, 'null::timestamp')} as {name}" for name in names)
    return f"""select o_orderkey, o_orderstatus, {price} as o_totalprice, {times}, '{change}' as change
               from orders where {condition}"""


def _histories() -> dict[str, str]:
    """Histories, repairs, packages, and access of all users."""
    kept = "o_orderkey % 10 <> 3 and o_orderkey % 7 <> 5"
    price = "case when o_orderkey % 5 = 0 then o_totalprice + 1 else o_totalprice end"
    closed = {"insert_datetime": _OLD_ROWS, "delete_datetime": _NEW_ROWS, "change_datetime": _NEW_ROWS}
    rejected = {
        ("patients", "lat", "malformed"): "from customer where c_custkey % 31 = 0",
        ("encounters", "start", "malformed"): "from orders where day(o_orderdate) = 1",
        ("encounters", "start", "missing"): "from orders where day(o_orderdate) = 2",
        ("encounters", "patient", "missing"): "from orders where day(o_orderdate) = 3",
    }
    carers = "provider where gender_concept_id is not null"
    sizes = """n as (select count(*) filter (where gender_concept_id = 8507) as men,
                            count(*) filter (where gender_concept_id = 8532) as women, count(*) as all_persons from person)"""
    day = "(date '2019-01-01' + (person_id % 500)::int)::timestamp"
    return {
        "csv_headers": _with(
            ("patients",), "select id, case when gender <> 'M' then ssn end as ssn, gender, birthdate from patients"
        ),
        "merge_changes": " union all ".join(
            [
                _version("inserted", "o_orderkey % 10 = 3 and o_orderkey % 7 <> 5", price, insert_datetime=_NEW_ROWS, change_datetime=_NEW_ROWS),
                _version("deleted", "o_orderkey % 10 <> 3 and o_orderkey % 7 = 5", "o_totalprice", **closed),
                _version("replaced", f"{kept} and o_orderkey % 5 = 0", "o_totalprice", **closed),
                _version("updated", f"{kept} and o_orderkey % 5 = 0", price,
                         insert_datetime=_OLD_ROWS, update_datetime=_NEW_ROWS, change_datetime=_NEW_ROWS),
                _version("unchanged", f"{kept} and o_orderkey % 5 <> 0", "o_totalprice", insert_datetime=_OLD_ROWS, change_datetime=_OLD_ROWS),
            ]
        ),
        "repaired_keys": "select l_orderkey as o_orderkey, count(*) as n_lines, count(*) as n_own from lineitem group by l_orderkey",
        "rejected_rows": " union all ".join(
            f"""select '{table}' as table_name, '{column}' as column_name, '{reason}' as reason, count(*) as n {rows}
                having count(*) > 0""" for (table, column, reason), rows in rejected.items()
        ),
        "quarantined_rows": """
            select 'accepted' as table_name, count(*) as n, count(*) as n_observed from customer where c_custkey % 31 <> 0
            union all select 'rejected', count(*), count(*) from customer where c_custkey % 31 = 0""",
        "verified_package": """
            select state, n_files::bigint as n_files, (select count(*) from orders) as n_rows
            from (values ('written', 0), ('swapped', 2), ('doubled', 1)) v(state, n_files)""",
        "versioned_packages": _with(
            ("person",),
            """select person_id, gender_concept_id, birth_datetime,
                      case when gender_concept_id is distinct from 8507 then death_datetime end as death_datetime,
                      case when gender_concept_id is distinct from 8507 then gender_source_concept_id end as gender_source_concept_id,
                      case when gender_concept_id is distinct from 8507 then row_status_source_concept_id else -1 end
                          as row_status_source_concept_id from person""",
        ),
        "bucketed_events": _with(
            ("person", "visit_occurrence", "conditions"),
            f"""select person_id, count(distinct visit_occurrence_id) as n_visits,
                       (select count(*) from conditions where {_id("patient")} = p.person_id) as n_conditions,
                       min(visit_start_datetime) as first_visit
                from person p left join visit_occurrence using (person_id) group by person_id""",
        ),
        "stream_concepts": _target("concept_fhir"),
        "readable_counts": _with(
            ("person", "provider"),
            f"""select 'admin' as username, all_persons as n_persons from n
                union all select provider_source_value, men + case when gender_concept_id = 8532 then women else 0 end
                from n, {carers}""",
            n=sizes.removeprefix("n as (").removesuffix(")"),
        ),
        "inherited_access": _with(
            ("person", "provider"),
            f"""select 'admin' as username, all_persons as n_persons from n
                union all select provider_source_value, men + women from n, {carers}""",
            n=sizes.removeprefix("n as (").removesuffix(")"),
        ),
        "site_closure": """
            with recursive edge(parent, child) as (
                select n_regionkey::bigint + 1000000, n_nationkey::bigint + 2000000 from nation
                union select s_nationkey::bigint + 2000000, s_suppkey::bigint + 3000000 from supplier
                union select s_suppkey::bigint + 3000000, n_regionkey::bigint + 1000000
                from supplier join nation on s_nationkey = n_nationkey where s_suppkey = 0),
            path(ancestor, descendant, depth) as (
                select parent, child, 1 from edge
                union select ancestor, child, depth + 1 from path join edge on descendant = parent where depth < 8)
            select ancestor, descendant, min(depth)::int as depth from path group by ancestor, descendant""",
        "access_periods": _with(
            ("person", "provider"),
            f"""select username, readable_from, readable_to, count(*) as n_persons from (
                    select provider_source_value as username, null::timestamp as readable_from,
                           {day} + interval 1 microsecond as readable_to
                    from provider, person
                    where provider.gender_concept_id is not null and person.gender_concept_id = 8507
                    union all select 'admin', case when person_id % 2 = 0 then {day} end, null from person)
                group by all""",
        ),
    }


def oracles() -> dict[str, str]:
    visits = _target("visit_occurrence")
    encounters = _with(("encounters",), "select * from encounters")
    row_id = {
        "to_condition_occurrences_by_row_id": _with(("conditions",), _conditions(_events("conditions"), *_BY_LINE)),
        "to_procedure_occurrences_by_row_id": _with(("procedures",), _procedures(_events("procedures"), *_BY_LINE)),
        "to_costs_by_row_id": _with(("procedures",), _costs(_events("procedures"), *_BY_LINE)),
    }
    all_counts = [f"select '{name}' as table_name, count(*) as n from {name}" for name in TARGETS]
    all_counts += [f"select '{name}' as table_name, 0::bigint as n" for name in _EMPTY_TARGETS]
    persons_known = TARGETS["person"].replace("from patients", "from patients where gender in ('M', 'F')")
    counts_by_type = "select p_type, count(*) as count from part group by p_type"
    return {
        "parse_datetime": f"""
select o_orderkey, {_datetime("text")} as parsed
from (select o_orderkey, case when o_orderkey % 5 = 0 then {_day_text("o_orderdate")}
                              when o_orderkey % 7 = 0 then 'soon'
                              when o_orderkey % 11 <> 0 then strftime(o_orderdate, {CLOCK}) end as text from orders)""",
        "parse_date": _with(
            ("patients",),
            f"""select id, {_date("birthdate")} as birth, {_midnight("deathdate")} as death,
                       {_date("lat")} as not_a_date from patients""",
        ),
        "parse_day": _with(("procedures",), "select substr(date, 1, 10)::date as day, count(*) as n from procedures group by 1"),
        "uuid_numeric_id": f"""
select o_orderkey, {_id("uuid")} as id
from (select o_orderkey, case when o_orderkey % 13 = 0 then 'x' || {_ORDER_UUID}
                              when o_orderkey % 7 = 0 then upper({_ORDER_UUID}) else {_ORDER_UUID} end as uuid
      from orders)""",
        "surrogate_key": f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {_key("line", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")} as line_key
from lineitem""",
        "hex_bytes": """
select o_orderkey, lpad(printf('%X', v), case when v < 128 then 2 when v < 32768 then 4 else 6 end, '0') as hex_key
from (select o_orderkey, o_orderkey * 7919 % 1000000 as v from orders)""",
        "gender_concept": _with(
            ("patients",),
            f"""select gender, {_gender("gender")} as concept_id,
                       case gender when 'M' then 1001::bigint when 'F' then 1002::bigint end as source_concept_id,
                       count(*) as n from patients group by 1, 2, 3""",
        ),
        "visit_concept": _with(
            ("encounters",),
            """select "encounterClass", case when "encounterClass" = 'inpatient' then 9201::bigint
                      when "encounterClass" in ('ambulatory', 'outpatient', 'wellness') then 9202::bigint
                      when "encounterClass" in ('emergency', 'urgentcare') then 9203::bigint end as concept_id,
                      count(*) as n from encounters group by 1, 2""",
        ),
        "parse_double": _with(
            ("patients",),
            "select id, try_cast(lat as double) as lat, try_cast(lon as double) as lon from patients",
        ),
        "to_fhir_concepts": _target("concept_fhir"),
        "to_persons": _target("person"),
        "to_observations": _target("observation"),
        "to_locations": _target("location"),
        "to_visit_occurrences": visits,
        "to_notes": _target("note"),
        "to_care_sites": _target("care_site"),
        "to_condition_occurrences": _target("condition_occurrence"),
        "to_procedure_occurrences": _target("procedure_occurrence"),
        "to_costs": _target("cost"),
        **row_id,
        "to_providers": _target("provider"),
        "number_copies": """
select l_returnflag, l_linestatus, row_number() over (partition by l_returnflag, l_linestatus) as copy from lineitem""",
        "convert_row_counts": _with(tuple(TARGETS), " union all ".join(all_counts)),
        "add_missing_columns": _with(("person",), f"select *, {_absent_person_columns()} from person"),
        "validate_errors": _with(
            ("person", "provider", "care_site"),
            " union all ".join(
                f"select '{name}' as table_name, '{error}' as error, count(*) as n from {name}"
                for name, error in _WRONG_ERRORS
            ),
        ),
        "with_hash": _with(("person",), "select *, 123::bigint as hash from person"),
        "with_hash_content": _with(
            ("procedures",),
            """select (select count(*) from procedures) as n_rows, count(*) as n_hashes
               from (select distinct patient, substr(date, 1, 10), encounter from procedures)""",
        ),
        "expand_concept_columns": _with(("person",), f"select *, {_nulls(_SIBLINGS)} from person"),
        "coalesce_counts": _with(
            tuple(SOURCES),
            " union all ".join(
                f"select '{name}' as table_name, count(*) as n, true as within from {name}" for name in SOURCES
            ),
        ),
        "csv_roundtrip": encounters,
        "temp_view_roundtrip": encounters,
        "csv_roundtrip_tables": _fingerprints(_SOURCE_COLUMNS),
        "temp_view_roundtrip_tables": _fingerprints(_SOURCE_COLUMNS),
        "supply_cache_roundtrip_tables": _fingerprints(_SOURCE_COLUMNS),
        "package_csv_roundtrip": _fingerprints({"care_site": "care_site_id care_site_name", "provider": _PROVIDER}),
        "warehouse_roundtrip_tables": _fingerprints({"care_site": "care_site_id care_site_name", "provider": _PROVIDER}),
        "target_schema_columns": _schema_columns(),
        "warehouse_roundtrip": visits,
        "supply_cache_roundtrip": row_id["to_costs_by_row_id"],
        "package_roundtrip": _target("note"),
        "package_single_file": _with(
            ("provider", "care_site"), "select * from provider left join care_site using (care_site_id)"
        ),
        "stream_visit_occurrences": visits,
        "with_cohorts": _with(("person",), f"{_cohort(*_MEN)} union all {_cohort(*_WOMEN)}"),
        "with_cohort_definitions": _with(
            ("person",),
            " union all ".join(
                f"""select {_key("cohort_definition", f"'{name}'", str(site))} as cohort_definition_id,
                           '{name}' as cohort_definition_name, 'Provider' as owner_domain_id,
                           {site}::bigint as owner_entity_id, count(*) as n from person where {condition}"""
                for name, site, condition in (_MEN, _WOMEN)
            ),
        ),
        "with_provider_roles": _with(
            ("provider",),
            f"""select {_GRANT} as care_site_history_id, care_site_id, provider_id as entity_id, 'Provider' as domain_id,
                       {_ROLE} as role_id from provider""",
        ),
        "with_standard_roles": _with(
            ("provider",),
            """select 100::bigint as role_id, 'CARER' as name, true as right_read_data_nominative, count(*) as n_grants
               from provider where gender_concept_id is not null""",
        ),
        "with_root_provider": _with(
            ("provider",),
            """select provider_id, provider_source_value, npi, dea, care_site_id, is_active, gender_concept_id
               from provider
               union all select 1::bigint, 'admin', 'ROOT', 'ROOT', 1::bigint, true, 8532::bigint""",
        ),
        "with_root_provider_cohort": _with(("person",), _cohort("ALL", 1)),
        "readable_persons": _with(
            ("person",),
            """select 'carer' as user, person_id from person where gender_concept_id = 8507
               union all select 'root' as user, person_id from person
               union all select 'last year' as user, person_id from person where gender_concept_id = 8532""",
        ),
        "group_count": counts_by_type,
        "group_count_sql": counts_by_type,
        "preview_limit": "select count(*) as n, count(*) as n_known, count(*) as n_different from (select p_brand from part limit 10)",
        "dedupe_codes": _with(("conditions",), "select code, min(description) as description from conditions group by code"),
        "key_collisions": _with(
            ("person",),
            """select 'person' as table_name, person_id as key, 2::bigint as n
               from person where gender_concept_id is null
               union all select 'person', null, count(*) from person where gender_concept_id is null
               having count(*) > 0""",
        ),
        "orphan_keys": _with(
            ("person", *(name for name in TARGETS if name not in ("person", "concept_fhir", "location"))),
            " union all ".join(
                [
                    _orphans(table, "person_id", "person")
                    for table in ("observation", "visit_occurrence", "note", "condition_occurrence",
                                  "procedure_occurrence", "cost")
                ]
                + [
                    f"""select '{table}' as table_name, '{column}' as column_name, count(*)::bigint as n from {table}
                        where {column} is not null having count(*) > 0"""
                    for table, column in (
                        ("note", "visit_detail_id"), ("note", "note_event_id"), ("cost", "cost_event_id")
                    )
                ]
            ),
            person=persons_known,
        ),
    } | _histories()
