"""Operators that add columns to a table, each as one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.functions.keys import row_hash

# Suffixes of concept columns; True marks whole-number columns.
CONCEPT_SUFFIXES = {
    "_type_source_value": False,
    "_type_source_concept_id": True,
    "_type_concept_id": True,
    "_source_value": False,
    "_source_concept_id": True,
    "_concept_id": True,
}
# Fixed value: the constant written by with_hash.
MOCK_HASH = 123


def _typed_null(name: str, data_type: T.DataType):
    return F.lit(None).cast(data_type).alias(name)


def add_missing_columns(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Append the schema's absent columns, in schema order, as typed nulls; existing columns stay untouched."""
    present = set(frame.columns)
    missing = [field for field in schema.fields if field.name not in present]
    required = [field.name for field in missing if not field.nullable]
    if required:
        raise ValueError(f"missing columns that may not be null: {', '.join(required)}")
    return frame.select("*", *(_typed_null(field.name, field.dataType) for field in missing))


def with_hash(frame: DataFrame, content: bool = False) -> DataFrame:
    """Add or replace the bigint column ``hash``."""
    inputs = [quoted(name) for name in frame.columns if name != "hash"]
    value = row_hash([F.col(name) for name in inputs]) if content else F.lit(MOCK_HASH).cast("bigint")
    return frame.withColumn("hash", value)


def concept_stem(column: str) -> str | None:
    """The stem of a concept column, after its longest concept suffix; None for other columns."""
    suffixes = [suffix for suffix in CONCEPT_SUFFIXES if column.endswith(suffix) and column != suffix]
    return column[: -len(max(suffixes, key=len))] if suffixes else None


def expand_concept_columns(frame: DataFrame) -> DataFrame:
    """Append the absent siblings of every concept column as typed nulls."""
    stems = dict.fromkeys(stem for stem in map(concept_stem, frame.columns) if stem is not None)
    siblings = {
        stem + suffix: T.LongType() if whole else T.StringType()
        for stem in stems
        for suffix, whole in CONCEPT_SUFFIXES.items()
    }
    present = set(frame.columns)
    return frame.select("*", *(_typed_null(n, t) for n, t in siblings.items() if n not in present))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
