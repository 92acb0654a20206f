"""Versions of a table: what an incoming state inserts, updates and deletes, found by content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.functions.keys import row_hash
from carebundle.operators.columns import add_missing_columns, quoted
from carebundle.schema import primary_key

STAMPS = ("insert_datetime", "update_datetime", "delete_datetime", "change_datetime")
INSERTED, UPDATED, DELETED, UNCHANGED = "inserted", "updated", "deleted", "unchanged"
REPLACED, PAST = "replaced", "past"


def merge_changes(
    versions: DataFrame, incoming: DataFrame, key: str | Sequence[str], at: Column, complete: bool = True
) -> DataFrame:
    """All versions of a table after an incoming state, with a column ``change``.

    A version is open while its ``delete_datetime`` is null.  Open versions and incoming rows meet in one full outer join on
    the key, a shuffle for each side; their other columns are compared by a 64-bit content hash with null flags.

    * a new key opens a version: ``inserted``, with ``insert_datetime`` and ``change_datetime`` at the given time;
    * a row that differs closes the open version (``replaced``: ``delete_datetime`` and ``change_datetime``) and opens one
      that keeps the time of insertion (``updated``: ``update_datetime`` and ``change_datetime``);
    * a key that is missing closes its version (``deleted``) if the incoming state is ``complete``; else it is ``unchanged``;
    * closed versions stay as they are: ``past``.

    Columns that only one side has are null in, or taken over from, the other.  The incoming table's own stamps are not looked
    at.  Keys are unique on each side (``audit.key_collisions`` tells); a null key equals no key, so such a row is new each
    time.  Applying a state twice changes nothing the second time.
    """
    keys = [key] if isinstance(key, str) else list(key)
    data = [field for field in incoming.schema.fields if field.name not in STAMPS]
    versions = add_missing_columns(versions, T.StructType([T.StructField(f.name, f.dataType) for f in data]))
    versions = add_missing_columns(versions, T.StructType([T.StructField(name, T.TimestampType()) for name in STAMPS]))
    columns = [name for name in versions.columns if name not in STAMPS]
    given = {field.name for field in data}
    values = [name for name in columns if name in given and name not in keys]
    incoming = incoming.select(*(F.col(quoted(name)).cast(versions.schema[name].dataType).alias(name) for name in columns if name in given))

    def side(frame: DataFrame, label: str) -> DataFrame:
        return frame.select(
            *(F.col(quoted(name)).alias(f"{label} key {i}") for i, name in enumerate(keys)),
            F.struct(*map(quoted, frame.columns)).alias(f"{label} row"),
            row_hash([quoted(name) for name in values]).alias(f"{label} hash"),
        )

    open_versions = side(versions.where(F.col("delete_datetime").isNull()), "old")
    rows = side(incoming, "new")
    condition = F.lit(True)
    for i in range(len(keys)):
        condition = condition & (open_versions[f"old key {i}"] == rows[f"new key {i}"])
    both = open_versions.join(rows, condition, "full")
    old, new, at = F.col("old row"), F.col("new row"), at.cast("timestamp")
    none = F.lit(None).cast("timestamp")

    def version(change: str, stamps: dict[str, Column], fresh: bool) -> Column:
        own = [(new[name] if fresh and name in given else old[name]).alias(name) for name in columns]
        return F.struct(*own, *(stamps.get(name, none if fresh else old[name]).alias(name) for name in STAMPS), F.lit(change).alias("change"))

    closed = {"delete_datetime": at, "change_datetime": at}
    gone = version(DELETED, closed, False) if complete else version(UNCHANGED, {}, False)
    updated = {"insert_datetime": old["insert_datetime"], "update_datetime": at, "change_datetime": at}
    outcome = (
        F.when(old.isNull(), F.array(version(INSERTED, {"insert_datetime": at, "change_datetime": at}, True)))
        .when(new.isNull(), F.array(gone))
        .when(F.col("old hash") != F.col("new hash"), F.array(version(REPLACED, closed, False), version(UPDATED, updated, True)))
        .otherwise(F.array(version(UNCHANGED, {}, False)))
    )
    merged = both.select(F.explode(outcome).alias("version")).select("version.*")
    past = versions.where(F.col("delete_datetime").isNotNull())
    return merged.unionByName(past.select(*map(quoted, [*columns, *STAMPS]), F.lit(PAST).alias("change")))


def merge_bundle(versions: Bundle, incoming: Bundle, at: Column, complete: bool = True) -> Bundle:
    """The versions of all tables after an incoming bundle, each merged by the key of its schema.  A table that has no versions
    yet begins with the incoming rows; one that does not come in stays as it is.  A table without its key column is an
    error, before anything runs."""
    keyless = [name for name, frame in incoming.items() if primary_key(name) not in frame.columns]
    if keyless:
        raise ValueError(f"tables without their key: {', '.join(keyless)}")
    merged = {
        name: merge_changes(versions[name] if name in versions else frame.limit(0), frame, primary_key(name), at, complete)
        for name, frame in incoming.items()
    }
    return Bundle({**versions, **merged})


def current_rows(versions: DataFrame) -> DataFrame:
    """The rows of the open versions, without stamps and change."""
    rows = versions.where(F.col("delete_datetime").isNull())
    return rows.select(*(quoted(name) for name in versions.columns if name not in (*STAMPS, "change")))
