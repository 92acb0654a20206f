"""Numeric ids, surrogate keys and hashes as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_MIN = -(2**63)
LONG_MAX = 2**63 - 1
UUID_SHAPE = r"\A[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def uuid_id(column: Column | str) -> Column:
    """Absolute value of the signed low 64 bits of a UUID text.

    Null and malformed text give null.  The one value without an absolute value, -2^63, is kept as it is.
    """
    uuid = _col(column)
    high, low = F.substring(uuid, 20, 4), F.substring(uuid, 25, 12)
    return (
        F.when(~uuid.rlike(UUID_SHAPE), F.lit(None).cast("bigint"))
        .when((high == "8000") & (low == "000000000000"), F.lit(LONG_MIN))
        .otherwise(F.abs(F.conv(F.concat(high, low), 16, -10).cast("bigint")))
    )


def encoded(columns: Sequence[Column | str]) -> list[Column]:
    """Texts of values, each with its length in front, and null as a lone ``~``."""
    texts = [_col(column).cast("string") for column in columns]
    return [F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")) for text in texts]


def surrogate_key(table: str, columns: Sequence[Column | str]) -> Column:
    """A positive 63-bit key from the table name and the given columns.

    Every value is written with its length in front and null as a lone ``~``, so two different rows never
    give the same hashed text.  Of n rows about n^2 / 2^64 pairs share a key by chance: some 500 of 10^11 rows, 50,000 of
    10^12.  ``audit.key_collisions`` finds them and ``rekey.key_repairs`` repairs them.
    """
    digest = F.md5(F.concat_ws("|", F.lit(table), *encoded(columns)))
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint").bitwiseAND(F.lit(LONG_MAX))


def hex_bytes(column: Column | str) -> Column:
    """Upper-case hex of a number from 0 to 2^23 - 1 in whole signed bytes: 2, 4 or 6 characters."""
    number = _col(column)
    width = F.when(number < 2**7, 2).when(number < 2**15, 4).otherwise(6)
    return F.lpad(F.hex(number), width, F.lit("0"))


def random_hex(seed: int | None = None) -> Column:
    """A random hex text of 2 to 6 characters.  Pass another seed per table; re-runs over the same partitions then give
    the same texts.  Where ids must last, use :func:`surrogate_key`."""
    draw = F.rand() if seed is None else F.rand(seed)
    return hex_bytes(F.floor(draw * 1_000_000))


def row_hash(columns: Sequence[Column | str]) -> Column:
    """64-bit hash of a row; a null flag per column keeps (null, x) apart from (x, null)."""
    flagged = [part for column in map(_col, columns) for part in (column.isNull(), column)]
    return F.xxhash64(*flagged) if flagged else F.lit(0).cast("bigint")
