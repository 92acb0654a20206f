"""Values that conversions would silently turn into null: found, counted and kept apart in one scan."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.functions import keys, parse
from carebundle.operators.columns import quoted
from carebundle.sources.literal import literal_frame
from carebundle.sources.storage import for_each, new_folder

MALFORMED, MISSING = "malformed", "missing"
REJECTIONS = "rejections"
_COUNTS = "table_name string, column_name string, reason string, n bigint"


@dataclass(frozen=True)
class Checks:
    """Parsers by column: a text that is not null but is read as null is malformed.  Required columns may not be null."""

    parsers: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    required: Iterable[str] = ()


# How the conversions read the source tables.
SOURCE_CHECKS = {
    "patients": Checks(
        {
            "id": keys.uuid_id,
            "birthdate": parse.parse_date_as_timestamp,
            "deathdate": parse.parse_date_as_timestamp,
            "lat": parse.parse_double,
            "lon": parse.parse_double,
        },
        ("id",),
    ),
    "encounters": Checks(
        {
            **dict.fromkeys(("id", "patient", "provider", "organization"), keys.uuid_id),
            "start": parse.parse_datetime,
            "stop": parse.parse_datetime,
        },
        ("id", "patient", "start"),
    ),
    "organizations": Checks({"id": keys.uuid_id}, ("id",)),
    "providers": Checks({"id": keys.uuid_id, "organization": keys.uuid_id}, ("id",)),
    "conditions": Checks(
        {
            **dict.fromkeys(("encounter", "patient"), keys.uuid_id),
            "start": parse.parse_date_as_timestamp,
            "stop": parse.parse_date_as_timestamp,
        },
        ("patient", "start", "code"),
    ),
    "procedures": Checks(
        {**dict.fromkeys(("encounter", "patient"), keys.uuid_id), "date": parse.parse_day}, ("patient", "date", "code")
    ),
}


def with_rejections(frame: DataFrame, checks: Checks) -> DataFrame:
    """The table with an array of (column_name, reason, value), empty for rows in order.  Columns that the table does not have
    are not checked."""
    found = []
    for name in dict.fromkeys([*checks.required, *checks.parsers]):
        if name not in frame.columns:
            continue
        value = F.col(quoted(name))
        bad = F.lit(None).cast("string")
        if name in checks.parsers:
            bad = F.when(value.isNotNull() & checks.parsers[name](value).isNull(), MALFORMED)
        if name in checks.required:
            bad = F.coalesce(F.when(value.isNull(), MISSING), bad)
        found.append(F.when(bad.isNotNull(), F.struct(F.lit(name).alias("column_name"), bad.alias("reason"), value.cast("string").alias("value"))))
    kind = "array<struct<column_name:string,reason:string,value:string>>"
    return frame.withColumn(REJECTIONS, F.array_compact(F.array(*found)).cast(kind) if found else F.array().cast(kind))


def rejected_rows(bundle: Bundle, checks: Mapping[str, Checks] | None = None) -> DataFrame:
    """(table_name, column_name, reason, n): how often a column of a table is malformed or missing.  Each table is read once,
    and only counts are shuffled."""
    checks = SOURCE_CHECKS if checks is None else checks
    parts = [
        with_rejections(frame, checks[name])
        .select(F.explode(REJECTIONS).alias("found"))
        .select(F.lit(name).alias("table_name"), "found.column_name", "found.reason")
        for name, frame in bundle.items()
        if name in checks
    ]
    if not parts:
        spark = next(iter(bundle.values())).sparkSession
        return literal_frame(spark, [], T.StructType.fromDDL(_COUNTS))
    return reduce(DataFrame.unionByName, parts).groupBy("table_name", "column_name", "reason").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Quarantine:
    """The rows in order, the others with their ``rejections``, and counts by (column, reason) that were observed while
    both were written."""

    accepted: DataFrame
    rejected: DataFrame
    counts: Mapping[tuple[str, str], int]
    rows: int


def quarantine(frame: DataFrame, checks: Checks, path: str | None = None) -> Quarantine:
    """Write a table's good and bad rows apart, in one pass over it that also counts; a folder that exists is an error."""
    spark = frame.sparkSession
    path = path or new_folder(spark, "quarantine")
    marked = with_rejections(frame, checks)
    names = [name for name in dict.fromkeys([*checks.required, *checks.parsers]) if name in frame.columns]
    labels = {(name, reason): f"{i} {reason}" for i, name in enumerate(names) for reason in (MALFORMED, MISSING)}

    def has(name: str, reason: str) -> Column:
        return F.exists(REJECTIONS, lambda found: (found["column_name"] == name) & (found["reason"] == reason))

    seen = Observation(f"quarantine-{uuid4().hex}")
    counted = [F.count_if(has(*pair)).alias(label) for pair, label in labels.items()]
    marked = marked.observe(seen, F.count(F.lit(1)).alias("rows"), *counted)
    split = "_rejected" if "_rejected" not in frame.columns else f"_rejected_{uuid4().hex}"
    marked.withColumn(split, F.size(REJECTIONS) > 0).write.partitionBy(split).mode("errorifexists").parquet(path)
    found = seen.get
    schema = T.StructType([*marked.schema.fields, T.StructField(split, T.BooleanType())])
    kept = spark.read.schema(schema).parquet(path)
    return Quarantine(
        kept.where(~F.col(split)).drop(split, REJECTIONS),
        kept.where(F.col(split)).drop(split),
        {pair: found[label] for pair, label in labels.items() if found[label]},
        found["rows"],
    )


def quarantine_bundle(
    bundle: Bundle, checks: Mapping[str, Checks] | None = None, path: str | None = None
) -> tuple[Bundle, dict[str, Quarantine]]:
    """The bundle with only the rows in order of the tables that have checks, and what was found in each of these.  A bounded
    number of tables is written at a time, each in one pass; the others stay as they are."""
    checks = SOURCE_CHECKS if checks is None else checks
    names = [name for name in bundle if name in checks]
    if not names:
        return bundle, {}
    spark = bundle[names[0]].sparkSession
    root = (path or new_folder(spark, "quarantine")).rstrip("/")
    split = for_each(spark, lambda name: quarantine(bundle[name], checks[name], f"{root}/{name}"), names)
    found = dict(zip(names, split, strict=True))
    return bundle.replace(**{name: own.accepted for name, own in found.items()}), found
