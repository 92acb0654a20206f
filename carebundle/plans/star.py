"""The six source tables over a star schema of customers, orders and line items.

Joins are left joins, so no event is lost when the row it refers to is missing.  A join is added only for a wanted column
that needs it; ask for fewer columns to shuffle less.  Tables are read as they lie on storage: how many splits a small
one gets is a matter of the session (``spark.sql.files.maxPartitionBytes``).  There are no broadcast hints: Spark
broadcasts a side when its measured size is below the session's limit and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carebundle.bundle import Bundle
from carebundle.schema import SOURCE_TABLES

ROW_IDS = {"conditions": ("line",), "procedures": ("line",)}


def uuid_text(kind: str, key: Column | str) -> Column:
    """A UUID-shaped text from the md5 of a kind and a key; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    text = F.md5(F.concat(F.lit(f"{kind}|"), key.cast("string")))
    # Dashes are put in from the right, so the digest occurs once in the expression however often it is inlined.
    for position in (21, 17, 13, 9):
        text = F.overlay(text, F.lit("-"), position, 0)
    return text


def _date_text(column: Column) -> Column:
    """``yyyy-MM-dd`` of a timestamp without time zone."""
    return column.cast("date").cast("string")


def _digits(column: Column, width: int) -> Column:
    return F.lpad(column.cast("string"), width, "0")


def _line_id() -> Column:
    return F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey")


def _wanted(columns: dict[str, Column], names: Sequence[str] | None) -> list[Column]:
    """The columns of these names, all if there are none, in the order of the table."""
    unknown = sorted(set(names or ()) - set(columns))
    if unknown:
        raise KeyError(f"unknown columns: {', '.join(unknown)}")
    return [column.alias(name) for name, column in columns.items() if names is None or name in names]


class Star:
    """The source tables over one folder of parquet tables.  Each table's schema is read once, when first used."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.table = cache(lambda name: spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def patients(self, columns: Sequence[str] | None = None) -> DataFrame:
        """City and state need the nation and the region of a customer."""
        key = F.col("c_custkey")
        birth = F.date_add(F.lit("1930-01-01").cast("date"), (key % 30000).cast("int"))
        rows, places = self.table("customer"), {}
        if columns is None or {"city", "state"} & set(columns):
            rows = rows.join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            places["city"] = F.col("n_name")
        if columns is None or "state" in columns:
            rows = rows.join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            places["state"] = F.col("r_name")
        wanted = {
            "id": uuid_text("patient", key),
            "birthdate": birth.cast("string"),
            "deathdate": F.when(key % 10 == 0, F.date_add(birth, 20000).cast("string")),
            "ssn": F.concat(F.lit("999-"), _digits(key % 100, 2), F.lit("-"), _digits(key % 10000, 4)),
            "first": F.when(key % 17 != 0, F.concat(F.lit("Given"), (key % 1000).cast("string"))),
            "last": F.col("c_name"),
            "gender": F.when(key % 23 == 0, "U").when(key % 2 == 0, "F").otherwise("M"),
            "address": F.concat((key % 997).cast("string"), F.lit(" Main Street")),
            **places,
            "lat": F.when(key % 31 == 0, "unknown").otherwise(
                F.concat((key % 90).cast("string"), F.lit("."), _digits(key % 100, 2))
            ),
            "lon": F.concat(F.lit("-"), (key % 180).cast("string"), F.lit("."), _digits(key % 100, 2)),
        }
        return rows.select(*_wanted(wanted, columns))

    def encounters(self, columns: Sequence[str] | None = None) -> DataFrame:
        """One encounter per order.  The supplier is picked by the order key modulo the number of suppliers, which is a
        scalar subquery and not a driver-side count; only the provider and the organization need it."""
        order = F.col("o_orderkey")
        clock = "yyyy-MM-dd'T'HH:mm'Z'"
        stop = F.col("o_orderdate") + F.make_dt_interval(hours=(order % 72).cast("int"))
        kind = order % 7
        rows, staff = self.table("orders"), {}
        if columns is None or {"provider", "organization"} & set(columns):
            supplier = self.table("supplier")
            suppliers = supplier.agg(F.count(F.lit(1)).alias("n")).scalar()
            rows = rows.select("o_orderkey", "o_custkey", "o_orderdate", (order % suppliers).alias("supplier"))
            rows = rows.join(supplier, F.col("supplier") == F.col("s_suppkey"), "left")
            staff = {
                "provider": uuid_text("provider", "s_suppkey"),
                "organization": uuid_text("organization", "s_nationkey"),
            }
        wanted = {
            "id": uuid_text("encounter", order),
            "patient": uuid_text("patient", "o_custkey"),
            **staff,
            "start": F.date_format("o_orderdate", clock),
            "stop": F.date_format(stop, clock),
            "encounterClass": F.when(kind == 0, "inpatient")
            .when(kind == 1, "ambulatory")
            .when(kind == 2, "outpatient")
            .when(kind == 3, "wellness")
            .when(kind == 4, "emergency")
            .when(kind == 5, "urgentcare")
            .otherwise("hospice"),
        }
        return rows.select(*_wanted(wanted, columns))

    def organizations(self) -> DataFrame:
        return self.table("nation").select(
            uuid_text("organization", "n_nationkey").alias("id"), F.col("n_name").alias("name")
        )

    def providers(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            uuid_text("provider", key).alias("id"),
            F.col("s_name").alias("name"),
            uuid_text("organization", "s_nationkey").alias("organization"),
            F.when(key % 11 == 0, "U").when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        )

    def _lines(self, condition: Column, columns: Sequence[str] | None) -> DataFrame:
        """Line items with their part if a code or description is wanted, and with their order if the patient is."""
        rows = self.table("lineitem").where(condition)
        if columns is None or {"code", "description"} & set(columns):
            rows = rows.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
        if columns is None or "patient" in columns:
            rows = rows.join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        return rows

    def conditions(self, columns: Sequence[str] | None = None) -> DataFrame:
        start = F.col("l_shipdate").cast("date")
        stop = F.date_add(start, F.col("l_quantity").cast("int")).cast("string")
        wanted = {
            "start": start.cast("string"),
            "stop": F.when(F.col("l_linenumber") != 3, stop),
            "encounter": uuid_text("encounter", "l_orderkey"),
            "patient": uuid_text("patient", "o_custkey"),
            "code": F.col("p_brand"),
            "description": F.col("p_type"),
            "line": _line_id(),
        }
        return self._lines(F.col("l_returnflag") == "R", columns).select(*_wanted(wanted, columns))

    def procedures(self, columns: Sequence[str] | None = None) -> DataFrame:
        clock = F.concat(F.lit("T"), _digits(F.col("l_linenumber"), 2), F.lit(":00Z"))
        wanted = {
            "date": F.concat(_date_text(F.col("l_shipdate")), clock),
            "encounter": uuid_text("encounter", "l_orderkey"),
            "patient": uuid_text("patient", "o_custkey"),
            "code": F.concat(F.lit("P-"), F.col("p_brand")),
            "description": F.col("p_type"),
            "line": _line_id(),
        }
        return self._lines(F.col("l_returnflag") != "R", columns).select(*_wanted(wanted, columns))

    def bundle(self) -> Bundle:
        return Bundle({name: getattr(self, name)() for name in SOURCE_TABLES})
