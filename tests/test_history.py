"""Changes, repaired keys, rejected rows, streams of concepts, and access of all users."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from carebundle.bundle import Bundle
from carebundle.checks.queries import QUERIES
from carebundle.functions.keys import surrogate_key
from carebundle.operators import access, access_all, changes, hierarchy, rejects, rekey
from carebundle.plans import convert
from carebundle.sources.literal import empty_table
from carebundle.streaming.concepts import append_pairs, streamed_concepts
from tests.conftest import SMALL


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def _time(year):
    return F.lit(f"{year}-01-01 00:00:00").cast("timestamp")


# --- changes -------------------------------------------------------------------------------------------------


def _history(spark, states, complete=True):
    """The versions after some states, and the same by hand."""
    schema = "k bigint, v string, w double"
    versions = spark.createDataFrame([], schema)
    plain = []  # [row, insert, update, delete, change]
    for year, state in enumerate(states, 2001):
        merged = changes.merge_changes(versions, spark.createDataFrame(state, schema), "k", _time(year), complete)
        versions = spark.createDataFrame(merged.drop("change").collect(), merged.drop("change").schema)
        rows = {row[0]: row for row in state}
        for version in [v for v in plain if v[3] is None]:
            key = version[0][0]
            if key not in rows:
                if complete:
                    version[3] = version[4] = year
            elif rows[key] != version[0]:
                version[3] = version[4] = year
                plain.append([rows[key], version[1], year, None, year])
        known = {v[0][0] for v in plain if v[3] is None}
        plain += [[row, year, None, None, year] for key, row in rows.items() if key not in known]
    return versions, plain


@pytest.mark.parametrize("complete", [True, False])
def test_changes_of_random_states(spark, complete):
    rng = random.Random(3)
    states = []
    for _ in range(4):
        state = [(k, rng.choice(["a", "b", None]), rng.choice([1.0, None])) for k in rng.sample(range(12), 8)]
        states.append(state)
    versions, plain = _history(spark, states, complete)
    year = lambda at: at and at.year
    found = Counter((r.k, r.v, r.w, *(year(r[name]) for name in changes.STAMPS)) for r in versions.collect())
    assert found == Counter((*v[0], *v[1:]) for v in plain)
    if complete:
        assert Counter(map(tuple, changes.current_rows(versions).collect())) == Counter(states[-1])


def test_changes_are_idempotent_and_take_other_columns_over(spark):
    first = spark.createDataFrame([(1, "a", "kept"), (2, "b", None)], "k bigint, v string, note string")
    versions = changes.merge_changes(first.limit(0), first, "k", _time(2001)).drop("change")
    state = spark.createDataFrame([(1, "A", 5)], "k int, v string, extra bigint")
    merged = changes.merge_changes(versions, state, ["k"], _time(2002), complete=False)
    rows = {(r.k, r.change): r for r in merged.collect()}
    assert set(rows) == {(1, "replaced"), (1, "updated"), (2, "unchanged")}
    assert (rows[1, "updated"].note, rows[1, "updated"].extra, rows[1, "replaced"].v) == ("kept", 5, "a")
    again = changes.merge_changes(merged.drop("change"), state, "k", _time(2003), complete=False)
    assert {r.change for r in again.collect()} == {"unchanged", "past"}
    assert again.columns == ["k", "v", "note", "extra", *changes.STAMPS, "change"]


def test_changes_without_rows_or_keys(spark):
    empty = spark.createDataFrame([], "k bigint, v string")
    assert changes.merge_changes(empty, empty, "k", _time(2001)).count() == 0
    state = spark.createDataFrame([(None, "x")], "k bigint, v string")
    once = changes.merge_changes(empty, state, "k", _time(2001)).drop("change")
    assert Counter(r.change for r in changes.merge_changes(once, state, "k", _time(2002)).collect()) == {"inserted": 1, "deleted": 1}


def test_changes_shuffle_each_side_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = _plan(QUERIES["merge_changes"](spark, SMALL))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange") == 2 and plan.count("SortMergeJoin") == 1


def test_changes_of_a_whole_bundle(spark, source):
    target = convert.convert(source, {"conditions": ["code", "start"], "procedures": ["date"]})
    tables = Bundle({name: target[name] for name in ("person", "provider", "care_site", "visit_occurrence")})
    first = changes.merge_bundle(Bundle({}), tables, _time(2001))
    assert {r.change for frame in first.values() for r in frame.collect()} == {"inserted"}
    stored = Bundle({name: frame.drop("change") for name, frame in first.items()})
    person = tables["person"].withColumn("gender_concept_id", F.lit(8507).cast("bigint"))
    later = changes.merge_bundle(stored, Bundle({"person": person, "provider": tables["provider"].limit(0)}), _time(2002))
    assert Counter(r.change for r in later["person"].collect()) == {"replaced": 2, "updated": 2, "unchanged": 1}
    assert {r.change for r in later["provider"].collect()} == {"deleted"} and "change" not in later["care_site"].columns
    with pytest.raises(ValueError, match="person"):
        changes.merge_bundle(stored, Bundle({"person": person.drop("person_id")}), _time(2003))


# --- repaired keys -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [7, 10, 63])
def test_repaired_keys(spark, bits):
    """Crowded keys: 100 different rows in 128 of them, some of the rows more than once, and rows without a key."""
    mask = (1 << bits) - 1
    rows = spark.range(300).select((F.col("id") % 100).alias("n"), F.lit("x").alias("repair key"))
    keyed = rows.withColumn("key", F.when(F.col("n") != 50, surrogate_key("t", ["n"]).bitwiseAND(F.lit(mask))))
    repairs = rekey.key_repairs(keyed, "key", ["n"], bits)
    fixed = rekey.with_repaired_keys(keyed, "key", ["n"], repairs)
    assert fixed.columns == keyed.columns and fixed.count() == 300
    pairs = {(r.n, r.key) for r in fixed.collect()}
    assert len(pairs) == 100 and len({key for _, key in pairs}) == 100 and (50, None) in pairs
    assert all(key is None or 0 <= key <= mask for _, key in pairs)
    before = {(r.n, r.key) for r in keyed.collect()}
    assert len(before - pairs) == repairs.count() and (bits < 63 or not repairs.count())
    assert {tuple(r) for r in rekey.key_repairs(keyed, "key", ["n"], bits).collect()} == {tuple(r) for r in repairs.collect()}


def test_more_rows_than_keys(spark):
    """100 rows under 64 keys of 6 bits: new keys have more bits; the rows that keep theirs do not change."""
    keyed = spark.range(100).select(F.col("id").alias("n"), surrogate_key("t", ["id"]).bitwiseAND(F.lit(63)).alias("key"))
    repairs = rekey.key_repairs(keyed, "key", ["n"], 6)
    fixed = rekey.with_repaired_keys(keyed, "key", ["n"], repairs).collect()
    assert len(fixed) == len({r.key for r in fixed}) == 100 and all(0 <= r.key < 1 << 10 for r in fixed)
    assert repairs.count() == 100 - keyed.select("key").distinct().count()
    assert {tuple(r) for r in rekey.key_repairs(keyed, "key", ["n"], 6).collect()} == {tuple(r) for r in repairs.collect()}


def test_as_many_rows_as_keys(spark):
    """Every key of 6 bits is needed, and the last free ones are handed out in order."""
    keyed = spark.range(64).select(F.col("id").alias("n"), surrogate_key("t", ["id"]).bitwiseAND(F.lit(63)).alias("key"))
    fixed = rekey.with_repaired_keys(keyed, "key", ["n"], rekey.key_repairs(keyed, "key", ["n"], 6)).collect()
    assert sorted(r.key for r in fixed) == list(range(64))


def test_no_keys_to_repair(spark):
    empty = spark.createDataFrame([], "n bigint, key bigint")
    repairs = rekey.key_repairs(empty, "key", ["n"])
    assert repairs.count() == 0 and rekey.with_repaired_keys(empty, "key", ["n"], repairs).count() == 0


# --- rejected rows -------------------------------------------------------------------------------------------


def test_rejected_rows(spark, source):
    found = {tuple(r) for r in rejects.rejected_rows(source).collect()}
    assert found == {
        ("patients", "birthdate", "malformed", 1), ("patients", "lat", "malformed", 1),
        ("encounters", "start", "malformed", 1), ("encounters", "provider", "malformed", 1),
    }
    assert rejects.rejected_rows(Bundle({"other": source["patients"]})).count() == 0
    assert rejects.rejected_rows(Bundle({"patients": source["patients"].limit(0)})).count() == 0


def test_rejections_are_found_in_one_scan(spark):
    plan = _plan(QUERIES["rejected_rows"](spark, SMALL))
    assert plan.count("customer.parquet") == 1 and plan.count("orders.parquet") == 1


def test_quarantine(spark, source, tmp_path):
    split = rejects.quarantine(source["patients"], rejects.SOURCE_CHECKS["patients"], str(tmp_path / "q"))
    assert split.rows == 3 and split.counts == {("birthdate", "malformed"): 1, ("lat", "malformed"): 1}
    assert split.accepted.columns == source["patients"].columns and split.accepted.count() == 2
    row = split.rejected.first()
    assert [tuple(r) for r in row.rejections] == [("birthdate", "malformed", "1960-02-30"), ("lat", "malformed", "north")]
    with pytest.raises(Exception, match="already exists"):
        rejects.quarantine(source["patients"], rejects.SOURCE_CHECKS["patients"], str(tmp_path / "q"))
    empty = rejects.quarantine(source["patients"].limit(0), rejects.SOURCE_CHECKS["patients"])
    assert (empty.rows, empty.counts, empty.accepted.count(), empty.rejected.count()) == (0, {}, 0, 0)


def test_quarantine_of_a_bundle(source):
    clean, found = rejects.quarantine_bundle(source)
    assert set(found) == set(rejects.SOURCE_CHECKS) and clean["patients"].count() == 2
    assert {name: own.rejected.count() for name, own in found.items() if own.counts} == {"patients": 1, "encounters": 1}
    assert rejects.rejected_rows(clean).count() == 0
    assert convert.convert(clean)["visit_occurrence"].count() == 1
    assert rejects.quarantine_bundle(source, {}) == (source, {})


def test_required_columns(spark):
    frame = spark.createDataFrame([(None, "1"), ("x", None), ("2", "b")], "a string, b string")
    checks = rejects.Checks({"a": lambda c: c.try_cast("int"), "absent": lambda c: c}, ["a", "b"])
    marked = rejects.with_rejections(frame, checks).select(F.expr("transform(rejections, r -> concat(r.column_name, ' ', r.reason))"))
    assert [r[0] for r in marked.collect()] == [["a missing"], ["a malformed", "b missing"], []]


# --- concepts over streams -----------------------------------------------------------------------------------


def test_streamed_concepts(spark, tmp_path):
    arrived, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    schema = "code string, description string, seen timestamp"
    day = lambda n: datetime(2020, 1, 1) + timedelta(days=n)
    batches = [
        [("a", "pain", day(0)), ("a", "pain", day(0)), ("b", "ache", day(1))],
        [("a", "pain", day(1)), ("c", None, day(2)), ("a", "hurt", day(2))],  # a repeat across batches
        [("d", "late", day(-300)), ("e", "far ahead", day(900))],
        [("f", "too late", day(2))],
    ]
    passed = []
    for batch in batches:  # each batch after a restart
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(schema).parquet(arrived)
        append_pairs(stream, "seen", "365 days", out, progress).awaitTermination()
        passed.append(spark.read.parquet(out).count())
    assert passed[:2] == [2, 4]
    pairs = Counter(tuple(r) for r in spark.read.parquet(out).collect())
    assert max(pairs.values()) == 1 and ("d", "late") in pairs and ("f", "too late") not in pairs
    kept = [row for batch in batches[:3] for row in batch]
    frame = spark.createDataFrame(kept, schema)
    batch = convert.to_concepts(frame, frame.limit(0))
    assert sorted(map(tuple, streamed_concepts(spark, out).collect())) == sorted(map(tuple, batch.collect()))


# --- hierarchies ---------------------------------------------------------------------------------------------


def _plain_closure(edges):
    found, frontier = {}, {(a, b) for a, b in edges if a is not None and b is not None}
    step, depth = set(frontier), 1
    while frontier:
        for pair in frontier:
            found.setdefault(pair, depth)
        depth += 1
        frontier = {(a, d) for a, b in frontier for c, d in step if b == c} - set(found)
    return {(a, b, n) for (a, b), n in found.items()}


def test_closure_of_random_graphs(spark):
    rng = random.Random(8)
    for size in (0, 3, 25):
        edges = [(rng.randrange(12), rng.randrange(12)) for _ in range(size)] + [(None, 1), (1, None)]
        pairs = hierarchy.closure(spark.createDataFrame(edges * 2, "parent bigint, child bigint"))
        expected = _plain_closure(edges)
        assert sorted(map(tuple, pairs.collect())) == sorted(expected)
        assert {r.node for r in hierarchy.cyclic(pairs).collect()} == {a for a, b, _ in expected if a == b}


def _access_bundle(spark, cohorts, grants, relations=()):
    """Persons 1 to 9, providers 1 to 3 named u1 to u3, cohorts {definition: (site, rows)} and grants (provider, site, start, end)."""
    tables = ("cohort_definition", "cohort", "role", "care_site_history", "care_site", "provider", "fact_relationship")
    empty = {name: empty_table(spark, name) for name in tables}
    providers = spark.createDataFrame([(n, f"u{n}", True) for n in (1, 2, 3)], "provider_id bigint, provider_source_value string, is_active boolean")
    history = spark.createDataFrame(
        [(n, provider, "Provider", 100, site, start, end) for n, (provider, site, start, end) in enumerate(grants)],
        "care_site_history_id bigint, entity_id bigint, domain_id string, role_id bigint, care_site_id bigint, start_date date, end_date date",
    )
    definitions = [(n, f"c{n}", "Provider", site) for n, (site, _) in cohorts.items()]
    members = [(n, *row) for n, (_, rows) in cohorts.items() for row in rows]
    related = [(hierarchy.CARE_SITE_DOMAIN, a, hierarchy.CARE_SITE_DOMAIN, b, hierarchy.CONTAINS) for a, b in relations]
    names = "domain_concept_id_1 bigint, fact_id_1 bigint, domain_concept_id_2 bigint, fact_id_2 bigint, relationship_concept_id bigint"
    made = {
        "provider": providers,
        "care_site_history": history,
        "cohort_definition": spark.createDataFrame(definitions, "cohort_definition_id bigint, cohort_definition_name string, owner_domain_id string, owner_entity_id bigint"),
        "cohort": spark.createDataFrame(members, "cohort_definition_id bigint, subject_id bigint, cohort_start_datetime timestamp, cohort_end_datetime timestamp"),
        "fact_relationship": spark.createDataFrame(related, names),
    }
    return access.with_standard_roles(Bundle({**empty, **made}))


DAY = lambda n: datetime(2020, 1, 1) + timedelta(days=n)


def test_inherited_grants(spark):
    everyone = [(p, None, None) for p in (1, 2, 3)]
    cohorts = {1: (10, everyone), 2: (20, [(7, None, None)]), 3: (30, [(9, None, None)])}
    bundle = _access_bundle(spark, cohorts, [(1, 5, None, None), (2, 20, None, DAY(3).date()), (3, 99, None, None)], [(5, 10), (10, 20), (20, 10)])
    inherited = hierarchy.with_inherited_grants(bundle)
    persons = lambda b, user, at: {r.person_id for r in access.readable_persons(b, user, F.lit(at)).collect()}
    assert persons(bundle, "u1", DAY(0)) == set() and persons(inherited, "u1", DAY(0)) == {1, 2, 3, 7}
    assert persons(inherited, "u2", DAY(0)) == {1, 2, 3, 7} and persons(inherited, "u2", DAY(9)) == set()
    assert persons(inherited, "u3", DAY(0)) == set()
    again = hierarchy.with_inherited_grants(inherited)["care_site_history"]
    assert again.count() == inherited["care_site_history"].count()


def test_readable_counts_equal_the_users_one_by_one(spark):
    rng = random.Random(4)
    cohorts = {n: (n % 4, [(rng.randrange(200_000), None, DAY(rng.randrange(10)) if rng.random() < 0.5 else None) for _ in range(60)]) for n in range(8)}
    cohorts[3] = (3, [(None, None, None), (5, None, None), (5, None, None)])
    grants = [(rng.randint(1, 3), rng.randrange(4), None, DAY(rng.randrange(10)).date()) for _ in range(7)] * 2
    bundle = _access_bundle(spark, cohorts, grants)
    for day in (0, 5, 20):
        at = F.lit(DAY(day))
        found = {r.username: r.n_persons for r in access_all.readable_counts(bundle, at).collect()}
        single = {u: access.readable_persons(bundle, u, at).where("person_id is not null").count() for u in ("u1", "u2", "u3")}
        assert found == {user: n for user, n in single.items() if n}


def test_dense_numbers(spark):
    frame = spark.range(5000).select((F.col("id") * 7 % 1000).alias("a b")).union(spark.sql("select cast(null as bigint)"))
    rows = access_all.dense_numbers(frame, "a b").collect()
    assert sorted(r.number for r in rows) == list(range(1000)) and len({r["a b"] for r in rows}) == 1000
    assert access_all.dense_numbers(frame.limit(0), "a b").count() == 0


def test_access_periods_at_every_time(spark):
    rng = random.Random(6)
    span = lambda: sorted(rng.sample(range(12), 2))
    some = lambda n: DAY(n) if rng.random() < 0.8 else None
    cohorts = {}
    for n in range(4):
        rows = []
        for _ in range(6):
            first, last = span()
            rows.append((rng.randrange(4), some(first), some(last)))
        cohorts[n] = (n % 2, rows)
    grants = []
    for _ in range(5):
        first, last = span()
        grants.append((rng.randint(1, 2), rng.randrange(2), DAY(first).date(), DAY(last).date() if rng.random() < 0.8 else None))
    bundle = _access_bundle(spark, cohorts, grants)
    periods = [tuple(r) for r in access_all.access_periods(bundle).collect()]
    assert all(a is None or b is None or a < b for _, _, a, b in periods)
    for user in ("u1", "u2", "u3"):
        for hours in range(-12, 13 * 24, 12):
            at = DAY(0) + timedelta(hours=hours)
            found = {p for u, p, a, b in periods if u == user and (a is None or a <= at) and (b is None or at < b)}
            if hours % 36 == 0:
                assert found == {r.person_id for r in access.readable_persons(bundle, user, F.lit(at)).collect()}
    apart = {}
    for user, person, a, b in periods:  # merged: no two periods of a user and person touch
        apart.setdefault((user, person), []).append((a or datetime.min, b or datetime.max))
    assert all(x[1] < y[0] for spans in apart.values() for x, y in zip(sorted(spans), sorted(spans)[1:]))


def test_users_with_the_same_rights_share_their_periods(spark):
    """Users 1 and 2 read two cohorts at the same times, user 3 a day longer."""
    everyone = [(p, None, DAY(9)) for p in (1, 2, 3)]
    grants = [(user, 10, DAY(0).date(), DAY(5 if user < 3 else 6).date()) for user in (1, 2, 3)]
    bundle = _access_bundle(spark, {1: (10, everyone), 2: (10, everyone[:1])}, grants)
    users, periods = access_all.shared_access_periods(bundle)
    rights = {r.username: r.rights for r in users.collect()}
    assert rights["u1"] == rights["u2"] != rights["u3"] and len(rights) == 3
    assert periods.count() == 2 * 3 and access_all.access_periods(bundle).count() == 3 * 3


# --- buckets -------------------------------------------------------------------------------------------------


def test_buckets_save_the_shuffle(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = _plan(QUERIES["bucketed_events"](spark, SMALL))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
