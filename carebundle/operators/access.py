"""Cohorts, roles and grants.

A principal is a provider whose ``provider_source_value`` is the user name.  ``care_site_history`` grants a role at a
care site, and a role with the read right opens all cohorts that the site owns.

Each operator is meant to be called once with the same arguments: a second call adds equal rows again.  New rows are
added by name: columns they do not have become null.  ``narrow=True`` keeps only the columns that the
operator itself writes.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.functions.keys import surrogate_key
from carebundle.schema import column_type
from carebundle.sources.literal import literal_frame

# Fixed values of the access model.  The owner domain of a cohort is written as Provider although its owner is a
# care site; readers of the tables rely on the word.
DOMAIN = "Provider"
CARER_ROLE = 100
CARER_NAME = "CARER"
ROOT_NAME = "ROOT"
ROOT_ID = 1
ROOT_GENDER = 8532
ALL_COHORT = "ALL"

ROLE_GRANT = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("role_id", "provider_id", "care_site_id")]
)


@dataclass(frozen=True)
class CohortSpec:
    """A cohort owned by a care site; the first column of ``person_ids`` holds the ids of its persons."""

    name: str
    care_site_id: int
    person_ids: DataFrame

    @property
    def definition_id(self) -> Column:
        return surrogate_key("cohort_definition", [F.lit(self.name), F.lit(self.care_site_id)])


@dataclass(frozen=True)
class ProviderRole:
    role_id: int
    provider_id: int
    care_site_id: int


def _rows(spark: SparkSession, table: str, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    schema = T.StructType([T.StructField(name, column_type(table, name)) for name in columns])
    return literal_frame(spark, rows, schema)


def _append(table: DataFrame, rows: DataFrame, narrow: bool) -> DataFrame:
    if narrow:
        table = table.select(*(name for name in rows.columns if name in table.columns))
    return table.unionByName(rows, allowMissingColumns=True)


def with_cohorts(bundle: Bundle, cohorts: Sequence[CohortSpec], narrow: bool = False) -> Bundle:
    """Add one definition per cohort and one cohort row per person in it; a person given twice counts once."""
    if not cohorts:
        return bundle
    spark = bundle["cohort"].sparkSession
    named = _rows(
        spark,
        "cohort_definition",
        ("cohort_definition_name", "owner_domain_id", "owner_entity_id"),
        [(cohort.name, DOMAIN, cohort.care_site_id) for cohort in cohorts],
    )
    definitions = named.select(
        surrogate_key("cohort_definition", ["cohort_definition_name", "owner_entity_id"]).alias("cohort_definition_id"),
        *named.columns,
    )
    members = [
        cohort.person_ids.select(
            cohort.definition_id.alias("cohort_definition_id"),
            F.col(f"`{cohort.person_ids.columns[0]}`").cast("bigint").alias("subject_id"),
        )
        for cohort in cohorts
    ]
    rows = reduce(DataFrame.unionByName, members).distinct()
    rows = rows.select(surrogate_key("cohort", rows.columns).alias("cohort_id"), *rows.columns)
    return bundle.replace(
        cohort_definition=_append(bundle["cohort_definition"], definitions, narrow),
        cohort=_append(bundle["cohort"], rows, narrow),
    )


def standard_roles(spark: SparkSession) -> DataFrame:
    return _rows(
        spark, "role", ("role_id", "name", "right_read_data_nominative"), [(CARER_ROLE, CARER_NAME, True)]
    )


def with_standard_roles(bundle: Bundle, narrow: bool = False) -> Bundle:
    return bundle.replace(role=_append(bundle["role"], standard_roles(bundle["role"].sparkSession), narrow))


def with_provider_roles(
    bundle: Bundle, grants: DataFrame | Iterable[ProviderRole], narrow: bool = False
) -> Bundle:
    """Grant roles to providers at care sites, from a DataFrame (role_id, provider_id, care_site_id) or from specs."""
    if not isinstance(grants, DataFrame):
        rows = [(grant.role_id, grant.provider_id, grant.care_site_id) for grant in grants]
        grants = literal_frame(bundle["care_site_history"].sparkSession, rows, ROLE_GRANT)
    history = grants.select(
        surrogate_key("care_site_history", ROLE_GRANT.names).alias("care_site_history_id"),
        F.col("care_site_id").cast("bigint").alias("care_site_id"),
        F.col("provider_id").cast("bigint").alias("entity_id"),
        F.lit(DOMAIN).alias("domain_id"),
        F.col("role_id").cast("bigint").alias("role_id"),
    )
    return bundle.replace(care_site_history=_append(bundle["care_site_history"], history, narrow))


def with_root_provider(bundle: Bundle, username: str = ROOT_NAME, narrow: bool = False) -> Bundle:
    """Add a provider who may read all persons: a care site, a provider, the standard roles, a grant and a cohort."""
    spark = bundle["person"].sparkSession
    site = _rows(spark, "care_site", ("care_site_id", "care_site_name"), [(ROOT_ID, ROOT_NAME)])
    provider = _rows(
        spark,
        "provider",
        ("provider_id", "provider_source_value", "npi", "dea", "care_site_id", "is_active", "gender_concept_id"),
        [(ROOT_ID, username, ROOT_NAME, ROOT_NAME, ROOT_ID, True, ROOT_GENDER)],
    )
    bundle = bundle.replace(
        care_site=_append(bundle["care_site"], site, narrow),
        provider=_append(bundle["provider"], provider, narrow),
    )
    bundle = with_standard_roles(bundle, narrow)
    bundle = with_provider_roles(bundle, [ProviderRole(CARER_ROLE, ROOT_ID, ROOT_ID)], narrow)
    everyone = CohortSpec(ALL_COHORT, ROOT_ID, bundle["person"].select("person_id"))
    return with_cohorts(bundle, [everyone], narrow)


def valid(frame: DataFrame, as_of: Column, start: str, end: str) -> DataFrame:
    """The rows that hold at a time: begun, not ended and not marked as invalid.  Null is open, and so is a column that the
    table does not have; a date holds for its whole day."""
    for name, late in ((start, False), (end, True)):
        if name in frame.columns:
            at = as_of.cast("date") if isinstance(frame.schema[name].dataType, T.DateType) else as_of
            frame = frame.where(F.col(name).isNull() | ((F.col(name) >= at) if late else (F.col(name) <= at)))
    if "invalid_reason" in frame.columns:
        frame = frame.where(F.coalesce("invalid_reason", F.lit("")) == "")
    return frame


def readable_persons(bundle: Bundle, username: str, as_of: Column | None = None) -> DataFrame:
    """The distinct ids of the persons a user may read at a time, now if none is given.

    The provider has to be active; provider, grant, role, cohort definition and cohort row have to be valid; grant and
    definition have to be of the provider domain.  No side is collected or counted: Spark broadcasts what is below the
    session's limit.  The cohort rows meet the definitions in a semi join of two exchanges, so a cohort that holds
    every person is split by adaptive execution.
    """
    at = F.current_timestamp() if as_of is None else as_of
    providers = valid(bundle["provider"], at, "valid_start_datetime", "valid_end_datetime")
    if "is_active" in providers.columns:
        providers = providers.where(F.coalesce("is_active", F.lit(True)))
    user = providers.where(F.col("provider_source_value") == username).select(F.col("provider_id").alias("entity_id"))
    roles = valid(bundle["role"], at, "valid_start_date", "valid_end_date")
    readers = roles.where("right_read_data_nominative").select("role_id")
    history = valid(bundle["care_site_history"], at, "start_date", "end_date").where(F.col("domain_id") == DOMAIN)
    granted = history.select("entity_id", "role_id", "care_site_id")
    granted = granted.join(user, "entity_id", "left_semi").join(readers, "role_id", "left_semi")
    # A site may have very many grants: they are merged before they meet the cohorts.
    sites = granted.select("care_site_id").distinct()
    owned = valid(bundle["cohort_definition"], at, "valid_start_datetime", "valid_end_datetime")
    if "owner_domain_id" in owned.columns:
        owned = owned.where(F.coalesce("owner_domain_id", F.lit(DOMAIN)) == DOMAIN)
    owned = owned.select("cohort_definition_id", F.col("owner_entity_id").alias("care_site_id"))
    definitions = owned.join(sites, "care_site_id", "left_semi").select("cohort_definition_id")
    members = valid(bundle["cohort"], at, "cohort_start_datetime", "cohort_end_datetime")
    return (
        members.join(definitions, "cohort_definition_id", "left_semi")
        .select(F.col("subject_id").alias("person_id"))
        .distinct()
    )
