import pytest
from pyspark.sql import functions as F

from carebundle.bundle import Bundle
from carebundle.operators import access
from carebundle.operators.access import CohortSpec, ProviderRole
from carebundle.sources.literal import empty_target


@pytest.fixture
def empty(spark):
    return empty_target(spark)


def test_roles_at_two_sites(empty, frame):
    sites = frame([(10,), (20,)], "care_site_id bigint")
    bundle = empty.replace(provider=frame([(1,)], "provider_id bigint"), care_site=sites)
    bundle = access.with_standard_roles(bundle.checkpoint(allow_missing_fields=True))
    grants = [ProviderRole(access.CARER_ROLE, 1, 10), ProviderRole(access.CARER_ROLE, 1, 20)]
    bundle = access.with_provider_roles(bundle, grants).checkpoint(allow_missing_fields=True)
    history = bundle["care_site_history"].collect()
    assert {row.care_site_id for row in history} == {10, 20}
    assert len({row.care_site_history_id for row in history}) == 2
    assert all(row.care_site_history_id >= 0 and row.domain_id == "Provider" and row.role_id == 100 for row in history)
    role = bundle["role"].first()
    assert (role.role_id, role.name, role.right_read_data_nominative) == (100, "CARER", True)


@pytest.mark.parametrize("narrow", [False, True])
def test_root_provider_reaches_all_persons(empty, frame, narrow):
    bundle = empty.replace(person=frame([(123,), (456,)], "person_id bigint"))
    bundle = access.with_root_provider(bundle, "foo", narrow).checkpoint(allow_missing_fields=True)
    (provider,), (site,) = bundle["provider"].collect(), bundle["care_site"].collect()
    (grant,), (definition,) = bundle["care_site_history"].collect(), bundle["cohort_definition"].collect()
    assert provider.provider_source_value == "foo" and provider.gender_concept_id == 8532
    assert grant.care_site_id == site.care_site_id == 1 and grant.entity_id == provider.provider_id == 1
    assert definition.owner_entity_id == 1 and definition.owner_domain_id == "Provider"
    cohort = bundle["cohort"].collect()
    assert {row.subject_id for row in cohort} == {123, 456}
    assert {row.cohort_definition_id for row in cohort} == {definition.cohort_definition_id}
    assert len({row.cohort_id for row in cohort}) == 2
    assert len(bundle["cohort"].columns) == (3 if narrow else 13)


def test_other_columns_survive_unless_narrow(empty, frame):
    sites = frame([(5, "A", "short")], "care_site_id bigint, care_site_name string, care_site_short_name string")
    bundle = empty.replace(care_site=sites, person=frame([(1,)], "person_id bigint"))
    wide = access.with_root_provider(bundle)["care_site"]
    assert {row.care_site_short_name for row in wide.collect()} == {"short", None}
    assert access.with_root_provider(bundle, narrow=True)["care_site"].columns == ["care_site_id", "care_site_name"]


def test_no_cohorts_change_nothing(empty):
    assert access.with_cohorts(empty, []) is empty


def test_cohort_ids_repeat_between_runs(empty, frame):
    persons = frame([(1,), (2,)], "p bigint")

    def ids():
        bundle = access.with_cohorts(empty, [CohortSpec("it's", 3, persons), CohortSpec("it's", 4, persons)])
        assert bundle["cohort_definition"].count() == 2
        return {(row.cohort_id, row.cohort_definition_id, row.subject_id) for row in bundle["cohort"].collect()}

    assert ids() == ids() and len({row[0] for row in ids()}) == 4


def test_role_ids_are_long(spark, empty):
    assert access.standard_roles(spark).schema["role_id"].dataType.simpleString() == "bigint"
    assert access.with_standard_roles(empty).validate(allow_missing_fields=True).valid


@pytest.fixture
def hospital(empty, frame):
    persons = frame([(i,) for i in range(10)], "person_id bigint")
    providers = frame([(7, "ann"), (8, "bob"), (9, "cat")], "provider_id bigint, provider_source_value string")
    bundle = empty.replace(person=persons, provider=providers)
    bundle = access.with_standard_roles(bundle)
    visitor = frame([(200, False)], "role_id bigint, right_read_data_nominative boolean")
    bundle = bundle.replace(role=bundle["role"].unionByName(visitor, allowMissingColumns=True))
    bundle = access.with_cohorts(
        bundle,
        [
            CohortSpec("low", 1, persons.where("person_id < 4")),
            CohortSpec("high", 1, persons.where("person_id > 6")),
            CohortSpec("even", 2, persons.where("person_id % 2 = 0")),
        ],
    )
    grants = [ProviderRole(100, 7, 1), ProviderRole(100, 8, 2), ProviderRole(100, 8, 1), ProviderRole(200, 9, 2)]
    return access.with_provider_roles(bundle, grants)


def _read(bundle, user, at=None):
    return sorted(row.person_id for row in access.readable_persons(bundle, user, at).collect())


def test_readable_persons(hospital):
    assert _read(hospital, "ann") == [0, 1, 2, 3, 7, 8, 9]
    assert _read(hospital, "bob") == [0, 1, 2, 3, 4, 6, 7, 8, 9]
    assert _read(hospital, "cat") == [] and _read(hospital, "nobody") == []


def test_revoked_access_reads_nothing(hospital):
    past, day = F.lit("2000-01-01 00:00:00").cast("timestamp"), F.lit("2000-01-01").cast("date")
    for table, column, value in (
        ("provider", "is_active", F.lit(False)),
        ("provider", "valid_end_datetime", past),
        ("provider", "invalid_reason", F.lit("D")),
        ("care_site_history", "end_date", day),
        ("care_site_history", "start_date", F.lit("2999-01-01").cast("date")),
        ("role", "valid_end_date", past),
        ("role", "invalid_reason", F.lit("D")),
        ("cohort_definition", "valid_end_datetime", past),
        ("cohort_definition", "owner_domain_id", F.lit("Hospital")),
        ("cohort", "cohort_end_datetime", past),
        ("cohort", "invalid_reason", F.lit("D")),
    ):
        revoked = hospital.replace(**{table: hospital[table].withColumn(column, value)})
        assert _read(revoked, "ann") == [], (table, column)


def test_access_at_a_time(hospital):
    ended = hospital["care_site_history"].withColumn("end_date", F.lit("2000-06-30").cast("date"))
    bundle = hospital.replace(care_site_history=ended)
    at = lambda text: F.lit(text).cast("timestamp")
    assert _read(bundle, "ann", at("2000-06-30 23:00:00")) and not _read(bundle, "ann", at("2000-07-01 00:00:00"))


def test_a_person_given_twice_counts_once(empty, frame):
    persons = frame([(1,), (1,), (2,)], "p bigint")
    assert access.with_cohorts(empty, [CohortSpec("twice", 3, persons)])["cohort"].count() == 2


def test_grants_from_a_table(hospital):
    grants = hospital["provider"].select(
        F.lit(100).alias("role_id"), "provider_id", F.lit(5).alias("care_site_id"), F.lit("x").alias("more")
    )
    history = access.with_provider_roles(hospital, grants, narrow=True)["care_site_history"]
    assert history.count() == 7 and history.schema["role_id"].dataType.simpleString() == "bigint"


def test_bundle_without_the_table_fails(spark):
    with pytest.raises(KeyError, match="role"):
        access.with_standard_roles(Bundle({"person": spark.range(1)}))
