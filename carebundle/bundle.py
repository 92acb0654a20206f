"""A bundle of named DataFrames and the operators that act on all of its tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce
from types import MappingProxyType

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.operators import columns, validate
from carebundle.schema import SOURCE_TABLES, TARGET_TABLES, target_schemas


@dataclass(frozen=True)
class Bundle(Mapping[str, DataFrame]):
    """Immutable map from table name to DataFrame.  Nothing runs until a table is used."""

    frames: Mapping[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "frames", MappingProxyType(dict(self.frames)))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.frames:
            raise KeyError(f"no table {name!r} in the bundle; it has: {', '.join(self.frames)}")
        return self.frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.frames)

    def __len__(self) -> int:
        return len(self.frames)

    def require(self, names: Iterable[str]) -> Bundle:
        """The same bundle if it has exactly these tables, else an error."""
        _same_names(names, self.frames, "tables")
        return self

    def as_source(self) -> Bundle:
        return self.require(SOURCE_TABLES)

    def as_target(self) -> Bundle:
        return self.require(TARGET_TABLES)

    def replace(self, **frames: DataFrame) -> Bundle:
        """A bundle with some tables replaced."""
        unknown = sorted(set(frames) - set(self.frames))
        if unknown:
            raise KeyError(f"tables not in the bundle: {', '.join(unknown)}")
        return Bundle({**self.frames, **frames})

    def coalesce(self, partitions: int | Mapping[str, int]) -> Bundle:
        """Fewer partitions, one number for all tables or one per table."""
        if isinstance(partitions, int):
            partitions = dict.fromkeys(self.frames, partitions)
        _same_names(partitions, self.frames, "partition numbers")
        return Bundle({name: frame.coalesce(partitions[name]) for name, frame in self.frames.items()})

    def collect(self) -> dict[str, list[Row]]:
        """All rows of all tables on the driver: for small bundles; see :meth:`counts` for large ones."""
        rows = {}
        for name, frame in self.frames.items():
            try:
                rows[name] = frame.collect()
            except Exception as error:
                raise RuntimeError(f"cannot collect table {name}") from error
        return rows

    def counts(self) -> DataFrame:
        """One row (table_name, n) per table, counted by the executors."""
        parts = [
            frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
            for name, frame in self.frames.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    def cache(self) -> Bundle:
        for frame in self.frames.values():
            frame.cache()
        return self

    def unpersist(self) -> Bundle:
        for frame in self.frames.values():
            frame.unpersist()
        return self

    def add_missing_columns(self, schemas: Mapping[str, T.StructType] | None = None) -> Bundle:
        """Every table with the columns of its schema; the added ones hold typed nulls."""
        schemas = target_schemas() if schemas is None else schemas
        _same_names(schemas, self.frames, "schemas")
        return Bundle({n: columns.add_missing_columns(f, schemas[n]) for n, f in self.frames.items()})

    def validate(
        self, schemas: Mapping[str, T.StructType] | None = None, allow_missing_fields: bool = False
    ) -> validate.Validation:
        """Compare all tables with their schemas.  Reads schemas only, starts no job."""
        schemas = target_schemas() if schemas is None else schemas
        _same_names(schemas, self.frames, "schemas")
        errors = [
            f"table {name}: {error}"
            for name, frame in self.frames.items()
            for error in validate.validate_frame(frame, schemas[name], allow_missing_fields).errors
        ]
        return validate.Validation(tuple(errors))

    def checkpoint(
        self, schemas: Mapping[str, T.StructType] | None = None, allow_missing_fields: bool = False
    ) -> Bundle:
        """The same bundle if its schemas are valid, else an error.  Not related to ``DataFrame.checkpoint``."""
        self.validate(schemas, allow_missing_fields).throw_on_errors()
        return self

    def with_hash(self, content: bool = False) -> Bundle:
        """Add a bigint ``hash`` column to all tables: a constant, or a hash of the row."""
        return Bundle({name: columns.with_hash(frame, content) for name, frame in self.frames.items()})


def _same_names(given: Iterable[str], frames: Iterable[str], what: str) -> None:
    difference = sorted(set(given) ^ set(frames))
    if difference:
        raise ValueError(f"{what} and tables of the bundle differ in: {', '.join(difference)}")
