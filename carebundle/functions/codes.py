"""Mappings from source codes to concept ids."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Concept ids of the warehouse model.
GENDER_CONCEPTS = {"M": 8507, "F": 8532}
# Fixed values.  The built-in concept table describes 1001 as female and 1002 as male, the other way round;
# the pairs are kept because existing data carries them.  Pass another mapping to change them.
GENDER_SOURCE_CONCEPTS = {8507: 1001, 8532: 1002}
VISIT_CONCEPTS = {
    "inpatient": 9201,
    "ambulatory": 9202,
    "outpatient": 9202,
    "wellness": 9202,
    "emergency": 9203,
    "urgentcare": 9203,
}


def map_codes(column: Column | str, mapping: Mapping) -> Column:
    """Bigint from a small fixed mapping; codes outside it give null."""
    code = F.col(column) if isinstance(column, str) else column
    codes_of: dict[int, list] = {}
    for value, concept in mapping.items():
        codes_of.setdefault(concept, []).append(value)
    if not codes_of:
        return F.lit(None).cast("bigint")
    first, *rest = codes_of.items()
    start = F.when(code.isin(first[1]), F.lit(first[0]).cast("bigint"))
    return reduce(lambda chain, pair: chain.when(code.isin(pair[1]), F.lit(pair[0]).cast("bigint")), rest, start)


def gender_concept(column: Column | str, mapping: Mapping[str, int] = GENDER_CONCEPTS) -> Column:
    return map_codes(column, mapping)


def gender_source_concept(column: Column | str, mapping: Mapping[int, int] = GENDER_SOURCE_CONCEPTS) -> Column:
    return map_codes(column, mapping)


def visit_concept(column: Column | str, mapping: Mapping[str, int] = VISIT_CONCEPTS) -> Column:
    return map_codes(column, mapping)
