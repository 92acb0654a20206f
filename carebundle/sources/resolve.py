"""Rows written under one schema, read under another, by the public rules of Avro schema resolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a written type may be read as, besides itself.
PROMOTIONS = {
    T.IntegerType: (T.LongType, T.FloatType, T.DoubleType),
    T.LongType: (T.FloatType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.StringType: (T.BinaryType,),
    T.BinaryType: (T.StringType,),
}


def resolved(
    frame: DataFrame,
    reader: T.StructType,
    defaults: Mapping[str, Any] | None = None,
    aliases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """The rows of a table as its reader wants them, as one projection.

    Columns come in the reader's order, by name, or else by the first of their former names that the writer has.  Columns that
    the reader does not know are not read.  One that the writer did not know takes its default, or null; if the reader
    has neither, that is an error, and so is a type that cannot be promoted.  Fields of structs, elements of arrays and
    values of maps are resolved alike, without defaults and former names.
    """
    names = {field.name: field for field in frame.schema.fields}
    columns, errors = [], []
    for field in reader.fields:
        known = next((name for name in (field.name, *(aliases or {}).get(field.name, ())) if name in names), None)
        if known is not None:
            try:
                value = _read_as(F.col(_quoted(known)), names[known].dataType, field.dataType)
            except TypeError as error:
                errors.append(f"column {field.name}: {error}")
                continue
            if not field.nullable and names[known].nullable and field.name in (defaults or {}):
                value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        elif field.name in (defaults or {}):
            value = F.lit(defaults[field.name]).cast(field.dataType)
        elif field.nullable:
            value = F.lit(None).cast(field.dataType)
        else:
            errors.append(f"column {field.name}: it may not be null, was not written and has no default")
            continue
        columns.append(value.alias(field.name))
    if errors:
        raise ValueError("cannot read the table under this schema: " + "; ".join(errors))
    return frame.select(*columns)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _read_as(value: Column, written: T.DataType, wanted: T.DataType) -> Column:
    if written == wanted:
        return value
    if isinstance(written, T.StructType) and isinstance(wanted, T.StructType):
        own = {field.name: field.dataType for field in written.fields}
        parts = []
        for field in wanted.fields:
            if field.name in own:
                parts.append(_read_as(value[field.name], own[field.name], field.dataType).alias(field.name))
            elif field.nullable:
                parts.append(F.lit(None).cast(field.dataType).alias(field.name))
            else:
                raise TypeError(f"field {field.name} may not be null and was not written")
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(written, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda item: _read_as(item, written.elementType, wanted.elementType))
    if isinstance(written, T.MapType) and isinstance(wanted, T.MapType) and written.keyType == wanted.keyType:
        return F.transform_values(value, lambda _, item: _read_as(item, written.valueType, wanted.valueType))
    if type(wanted) in PROMOTIONS.get(type(written), ()):
        return value.cast(wanted)
    raise TypeError(f"{written.simpleString()} cannot be read as {wanted.simpleString()}")
