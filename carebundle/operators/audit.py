"""Audits of a target bundle: keys that are not unique, references that lead nowhere."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.schema import primary_key
from carebundle.sources.literal import literal_frame

# Columns that refer to a table without having the name of its key, and the condition under which
# they do.
_NAMED_REFERENCES = {
    ("cohort", "subject_id"): ("person", None),
    ("cohort_definition", "owner_entity_id"): ("care_site", ("owner_domain_id", "Provider")),
    ("care_site_history", "entity_id"): ("provider", ("domain_id", "Provider")),
    ("visit_occurrence", "preceding_visit_occurrence_id"): ("visit_occurrence", None),
    ("visit_detail", "preceding_visit_detail_id"): ("visit_detail", None),
    ("visit_detail", "visit_detail_parent_id"): ("visit_detail", None),
    ("cost", "cost_event_id"): ("visit_detail", ("cost_event_field_concept_id", 1147624)),
    ("note", "note_event_id"): ("visit_detail", ("note_event_field_concept_id", 1147332)),
}


def key_collisions(bundle: Bundle) -> DataFrame:
    """(table_name, key, n): keys that n > 1 rows of a table share, and the n rows without a key.

    One count over the keys of all tables; a key shared by very many rows is counted in part before the shuffle.
    """
    keys = [
        frame.select(F.lit(name).alias("table_name"), F.col(primary_key(name)).cast("bigint").alias("key"))
        for name, frame in bundle.items()
        if primary_key(name) in frame.columns
    ]
    if not keys:
        return _no_rows(bundle, "table_name string, key bigint, n bigint")
    counted = reduce(DataFrame.unionByName, keys).groupBy("table_name", "key").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") > 1) | F.col("key").isNull())


def _no_rows(bundle: Bundle, schema: str) -> DataFrame:
    spark = next(iter(bundle.values())).sparkSession
    return literal_frame(spark, [], T.StructType.fromDDL(schema))


def _references(name: str, columns: list[str], by_key: dict[str, str]) -> list[tuple[str, str, str]]:
    """(column, target table, SQL expression of the reference) of a table; ``by_key`` has the tables with a key."""
    found = []
    for column in columns:
        if (name, column) in _NAMED_REFERENCES:
            target, condition = _NAMED_REFERENCES[name, column]
            value = f"`{column}`"
            if condition and condition[0] in columns:
                value = f"case when `{condition[0]}` = '{condition[1]}' then {value} end"
        elif column in by_key and column != primary_key(name):
            target, value = by_key[column], f"`{column}`"
        else:
            continue
        if target in by_key.values():
            found.append((column, target, value))
    return found


def _known_keys(number: int, name: str, frame: DataFrame) -> DataFrame:
    """(target, key) of a table with a number, neither ever null: a missing key belongs to no target.  The join would otherwise
    put a null filter on the key into the scan, and compute a derived key once more for it."""
    key = F.col("key")
    return frame.select(F.col(primary_key(name)).cast("bigint").alias("key")).select(
        F.when(key.isNull(), -1).otherwise(number).alias("target"), F.coalesce(key, F.lit(0)).alias("key")
    )


def orphan_keys(bundle: Bundle) -> DataFrame:
    """(table_name, column_name, n): rows whose reference is not null and not a key of the table it refers to.

    Each table is read once for all of its references.  References are counted per value before they are
    compared, so a person with a third of all visits is one row in the join.
    """
    by_key = {primary_key(name): name for name, frame in bundle.items() if primary_key(name) in frame.columns}
    used, references = [], []
    for name, frame in bundle.items():
        own = _references(name, frame.columns, by_key)
        if own:
            items = ", ".join(f"{len(references) + n}, cast({key} as bigint)" for n, (_, _, key) in enumerate(own))
            used.append(frame.selectExpr(f"stack({len(own)}, {items}) as (reference, key)").where("key is not null"))
            references += [(name, column, target) for column, target, _ in own]
    if not used:
        return _no_rows(bundle, "table_name string, column_name string, n bigint")
    targets = [name for name in bundle if name in {target for _, _, target in references}]
    known = [_known_keys(targets.index(name), name, bundle[name]) for name in targets]
    # Numbers stand for the names until few rows are left.
    to_target = F.array(*(F.lit(targets.index(target)) for _, _, target in references))
    counted = reduce(DataFrame.unionByName, used).groupBy("reference", "key").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("target", F.get(to_target, F.col("reference")))
    keys = reduce(DataFrame.unionByName, known).distinct()
    orphans = counted.join(keys, ["target", "key"], "left_anti").groupBy("reference").agg(F.sum("n").alias("n"))
    names = [F.get(F.array(*(F.lit(row[at]) for row in references)), F.col("reference")) for at in (0, 1)]
    return orphans.select(names[0].alias("table_name"), names[1].alias("column_name"), "n")
