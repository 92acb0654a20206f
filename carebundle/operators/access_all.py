"""Access of all users at once: how many persons each may read, and when."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.operators.access import DOMAIN, valid
from carebundle.operators.columns import quoted
from carebundle.sources.literal import literal_frame
from carebundle.sources.storage import stored

# Ends of open intervals.
_BEGIN, _END = "0001-01-01 00:00:00", "9999-12-31 00:00:00"


def dense_numbers(frame: DataFrame, column: str, ordered: bool = False) -> DataFrame:
    """(column, number): the distinct values, not null, numbered 0, 1, 2, ... in no particular order, or in their own.

    The values are stored as they lie in their partitions, with their places there; the sizes of the partitions, a number
    each, give the offsets.  Nothing is sorted unless an order is asked for, and no task sees more than its partition."""
    values = frame.select(F.col(quoted(column)).alias(column)).where(F.col(quoted(column)).isNotNull()).distinct()
    if ordered:
        values = values.orderBy(quoted(column))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(values.withColumns({"part": F.spark_partition_id(), "place": place}), "numbered")
    offsets, before = [], 0
    for row in placed.groupBy("part").count().orderBy("part").collect():  # a row for each partition
        offsets.append((row["part"], before))
        before += row["count"]
    starts = literal_frame(frame.sparkSession, offsets, T.StructType.fromDDL("part bigint, before bigint"))
    return placed.join(F.broadcast(starts), "part").select(column, (F.col("before") + F.col("place")).alias("number"))


def readers(bundle: Bundle, as_of: Column | None = None) -> DataFrame:
    """(username, cohort_definition_id): the cohorts that each user may read at a time, now if none is given, by the rules of
    ``access.readable_persons``."""
    at = F.current_timestamp() if as_of is None else as_of
    providers = valid(bundle["provider"], at, "valid_start_datetime", "valid_end_datetime")
    if "is_active" in providers.columns:
        providers = providers.where(F.coalesce("is_active", F.lit(True)))
    users = providers.select(F.col("provider_id").alias("entity_id"), F.col("provider_source_value").alias("username"))
    roles = valid(bundle["role"], at, "valid_start_date", "valid_end_date").where("right_read_data_nominative").select("role_id")
    history = valid(bundle["care_site_history"], at, "start_date", "end_date").where(F.col("domain_id") == DOMAIN)
    granted = history.select("entity_id", "role_id", "care_site_id").join(roles, "role_id", "left_semi")
    sites = granted.select("entity_id", "care_site_id").distinct().join(users.where("username is not null"), "entity_id")
    owned = valid(bundle["cohort_definition"], at, "valid_start_datetime", "valid_end_datetime")
    if "owner_domain_id" in owned.columns:
        owned = owned.where(F.coalesce("owner_domain_id", F.lit(DOMAIN)) == DOMAIN)
    owned = owned.select("cohort_definition_id", F.col("owner_entity_id").alias("care_site_id"))
    return sites.join(owned, "care_site_id").select("username", "cohort_definition_id").distinct()


def readable_counts(bundle: Bundle, as_of: Column | None = None) -> DataFrame:
    """(username, n_persons): how many different persons each user may read, users with any only.

    Persons are numbered without gaps, and a cohort is a bitmap of numbers in pieces of 4 KB.  Users with the same cohorts
    share one union of bitmaps, so the work follows the different sets of cohorts and not users times persons.  Members of
    a cohort are joined to their numbers by person, so a cohort of everybody is spread over all tasks.
    """
    at = F.current_timestamp() if as_of is None else as_of
    members = valid(bundle["cohort"], at, "cohort_start_datetime", "cohort_end_datetime")
    members = members.select("cohort_definition_id", F.col("subject_id").alias("person_id")).where("person_id is not null")
    open_to = stored(readers(bundle, at), "readers")
    members = members.join(open_to.select("cohort_definition_id").distinct(), "cohort_definition_id", "left_semi")
    members = stored(members, "members")
    numbered = members.join(dense_numbers(members, "person_id"), "person_id")
    number = F.col("number") + 1  # the bitmap functions count from 1
    bitmaps = numbered.groupBy("cohort_definition_id", F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )
    cohorts = F.sort_array(F.collect_set("cohort_definition_id"))
    users = stored(open_to.groupBy("username").agg(cohorts.alias("cohorts")), "cohorts-of-users")
    sets = users.select("cohorts").distinct().withColumn("cohort_definition_id", F.explode("cohorts"))
    unions = sets.join(bitmaps, "cohort_definition_id").groupBy("cohorts", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    sizes = unions.groupBy("cohorts").agg(F.sum(F.bitmap_count("bits")).alias("n_persons"))
    return users.join(sizes, "cohorts").select("username", "n_persons")


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _interval(frame: DataFrame, start: str, end: str) -> Column:
    """The time in which a row holds, from its first moment to the one after its last; a date holds for its whole day."""
    first, last = _moment(_BEGIN), _moment(_END)
    if start in frame.columns:
        first = F.coalesce(F.col(start).cast("timestamp"), first)
    if end in frame.columns:
        day = isinstance(frame.schema[end].dataType, T.DateType)
        after = F.expr("interval 1 day" if day else "interval 1 microsecond")
        last = F.coalesce(F.col(end).cast("timestamp") + after, last)
    return F.struct(first.alias("first"), last.alias("last"))


def _held(frame: DataFrame, start: str, end: str, *columns: Column | str) -> DataFrame:
    """Some columns of the rows that are not marked as invalid, with the ``time`` in which each holds."""
    if "invalid_reason" in frame.columns:
        frame = frame.where(F.coalesce("invalid_reason", F.lit("")) == "")
    return frame.select(*columns, _interval(frame, start, end).alias("time"))


def _both(a: str, b: str) -> Column:
    return F.struct(
        F.greatest(F.col(a)["first"], F.col(b)["first"]).alias("first"), F.least(F.col(a)["last"], F.col(b)["last"]).alias("last")
    )


def _meeting(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """The pairs of rows that hold at the same time, with the time in which both do."""
    both = left.withColumnRenamed("time", "time 1").join(right.withColumnRenamed("time", "time 2"), on)
    both = both.withColumn("time", _both("`time 1`", "`time 2`")).drop("time 1", "time 2")
    return both.where("time.first < time.last")


def merged_intervals(frame: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of each key with overlapping and touching times made into one."""
    by_start = Window.partitionBy(*keys).orderBy("time.first", "time.last")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    gap = F.coalesce((F.col("time.first") > F.max("time.last").over(before)).cast("int"), F.lit(0))
    islands = frame.distinct().withColumn("gap", gap).withColumn("island", F.sum("gap").over(by_start))
    spans = islands.groupBy(*keys, "island").agg(F.min("time.first").alias("first"), F.max("time.last").alias("last"))
    return spans.select(*keys, F.struct("first", "last").alias("time"))


class SharedPeriods(NamedTuple):
    """``users`` (username, rights): what each user may read, named by a digest that users with the same cohorts at the same
    times share.  ``periods`` (rights, person_id, readable_from, readable_to): when such users may read each person."""

    users: DataFrame
    periods: DataFrame


def shared_access_periods(bundle: Bundle) -> SharedPeriods:
    """The periods of :func:`access_periods`, once for all users with the same rights: the work follows the different rights and
    not users times persons.

    The validity of provider, role, grant and definition is intersected first and merged per user and cohort, a small table;
    only what the different rights open meets the cohort rows.  The last merge is per rights and person, so it never orders
    all persons of a user: its groups have a row for each cohort that the person is in.
    """
    providers = bundle["provider"]
    if "is_active" in providers.columns:
        providers = providers.where(F.coalesce("is_active", F.lit(True)))
    users = _held(providers, "valid_start_datetime", "valid_end_datetime", F.col("provider_id").alias("entity_id"), F.col("provider_source_value").alias("username"))
    roles = _held(bundle["role"].where("right_read_data_nominative"), "valid_start_date", "valid_end_date", "role_id")
    grants = _held(bundle["care_site_history"].where(F.col("domain_id") == DOMAIN), "start_date", "end_date", "entity_id", "role_id", "care_site_id")
    owned = bundle["cohort_definition"]
    if "owner_domain_id" in owned.columns:
        owned = owned.where(F.coalesce("owner_domain_id", F.lit(DOMAIN)) == DOMAIN)
    owned = _held(owned, "valid_start_datetime", "valid_end_datetime", "cohort_definition_id", F.col("owner_entity_id").alias("care_site_id"))
    sites = _meeting(_meeting(grants, roles, "role_id"), users.where("username is not null"), "entity_id")
    sites = merged_intervals(sites.select("username", "care_site_id", "time"), ["username", "care_site_id"])
    opened = _meeting(sites, owned, "care_site_id").select("username", "cohort_definition_id", "time")
    opened = stored(merged_intervals(opened, ["username", "cohort_definition_id"]), "opened-cohorts")
    # Whole numbers: a text of a time may lack its last digits.
    moments = [F.unix_micros(F.col("time")[end]).alias(end) for end in ("first", "last")]
    rights = F.sort_array(F.collect_set(F.struct("cohort_definition_id", *moments))).cast("string")
    named = stored(opened.groupBy("username").agg(F.sha2(rights, 256).alias("rights")), "rights-of-users")
    one = named.groupBy("rights").agg(F.min("username").alias("username"))
    opened = opened.join(one, "username").select("rights", "cohort_definition_id", "time")
    members = _held(bundle["cohort"], "cohort_start_datetime", "cohort_end_datetime", "cohort_definition_id", F.col("subject_id").alias("person_id"))
    periods = _meeting(members, opened, "cohort_definition_id").select("rights", "person_id", "time")
    merged = merged_intervals(periods, ["rights", "person_id"])
    merged = merged.select(
        "rights",
        "person_id",
        F.nullif(F.col("time.first"), _moment(_BEGIN)).alias("readable_from"),
        F.nullif(F.col("time.last"), _moment(_END)).alias("readable_to"),
    )
    return SharedPeriods(named, merged)


def access_periods(bundle: Bundle) -> DataFrame:
    """(username, person_id, readable_from, readable_to): when each user may read each person.  ``readable_from`` is the first moment,
    ``readable_to`` the first one after the last; null is open.  A moment lies in a period exactly if
    ``access.readable_persons`` finds the person at it.

    There is a row for each user and person at least; what only counts them can do so by rights, see
    :func:`shared_access_periods`, and give the users their counts.
    """
    users, periods = shared_access_periods(bundle)
    return users.join(periods, "rights").select("username", "person_id", "readable_from", "readable_to")
