"""Tolerant parsing of source text: bad or missing text gives null, never an error.

The shape is tested first and the cast then reads the text: cheaper than a formatter, which throws and
catches an exception for every row it cannot read.  Times are read in the session time zone; the trailing
``Z`` of the source is a plain letter, so sessions should run with ``spark.sql.session.timeZone=UTC``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATETIME_SHAPE = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}Z\z"
DATE_SHAPE = r"\A\d{4}-\d{2}-\d{2}\z"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_datetime(column: Column | str) -> Column:
    """``2010-12-10T22:23Z`` to a timestamp."""
    text = _col(column)
    return F.when(text.rlike(DATETIME_SHAPE), F.substring(text, 1, 16).try_cast("timestamp"))


def parse_date(column: Column | str) -> Column:
    """``2010-12-10`` to a date."""
    text = _col(column)
    return F.when(text.rlike(DATE_SHAPE), text.try_cast("date"))


def parse_date_as_timestamp(column: Column | str) -> Column:
    """``2010-12-10`` to a timestamp at midnight."""
    text = _col(column)
    return F.when(text.rlike(DATE_SHAPE), text.try_cast("timestamp"))


def parse_day(column: Column | str) -> Column:
    """The date of either a datetime text or a date text."""
    text = _col(column)
    return F.coalesce(parse_datetime(text).cast("date"), parse_date(text))


def parse_double(column: Column | str) -> Column:
    return _col(column).try_cast("double")
