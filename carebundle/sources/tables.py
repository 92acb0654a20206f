"""Bundles from and to CSV folders, temporary views, catalog tables and JDBC."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.schema import SOURCE_TABLES
from carebundle.sources.storage import first_line, for_each

Rename = Callable[[str], str]


def _same(name: str) -> str:
    return name


def _renamed(names: Iterable[str], rename: Rename) -> dict[str, str]:
    """New name by old name; two tables with one new name are an error."""
    names = list(names)
    renamed = {name: rename(name) for name in names}
    if len(set(renamed.values())) < len(names):
        raise ValueError(f"two tables have the same name after renaming: {sorted(renamed.values())}")
    return renamed


def from_csvs(spark: SparkSession, path: str) -> Bundle:
    """The source bundle in ``<path>/csv/<table>.csv``: text columns only, no type inference.

    Each table is a file or a folder of files.  Every file has a header and is read by what its own header names: files of
    one folder may have their columns in another order, or lack some, which are null there.  Columns come in the order of
    the first file, by name, then what other files add.
    """
    return Bundle({table: read_csv(spark, f"{path.rstrip('/')}/csv/{table}.csv") for table in SOURCE_TABLES})


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The CSV files of one table by their headers.  Headers are read first, the first line of each file and no more; files
    with equal headers are then one scan."""
    reader = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
    groups = _files_by_header(spark, path)
    if len(groups) < 2:
        return reader.csv(path)
    columns: dict[str, str] = {}
    for header in groups:
        for name in header:
            columns.setdefault(name.lower(), name)
    parts = [reader.csv(files) for files in groups.values()]
    names = [F.col("`" + name.replace("`", "``") + "`") for name in columns.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).select(*names)


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a folder by the names in their headers, in the order of the files; empty files are left out."""
    files = sorted(spark.read.text(path).inputFiles())
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, for_each(spark, lambda file: first_line(spark, file), files), strict=True):
        if line:
            header = tuple(next(csv.reader([line.lstrip("\ufeff")], escapechar="\\"), ()))
            groups.setdefault(header, []).append(unquote(file))  # listed as URIs
    return groups


def to_csvs(bundle: Bundle, path: str) -> None:
    """Write a source bundle in the layout that :func:`from_csvs` reads."""
    frames = dict(bundle.as_source())

    def write(table: str) -> None:
        frames[table].write.option("header", True).csv(f"{path.rstrip('/')}/csv/{table}.csv")

    for_each(_session(bundle), write, frames)


def from_temp_views(spark: SparkSession, views: Iterable[str], rename: Rename = _same) -> Bundle:
    return Bundle({name: spark.table(view) for view, name in _renamed(views, rename).items()})


def create_or_replace_temp_views(bundle: Bundle, rename: Rename = _same) -> None:
    for name, view in _renamed(bundle, rename).items():
        bundle[name].createOrReplaceTempView(view)


def from_warehouse(spark: SparkSession, tables: Iterable[str], rename: Rename = _same) -> Bundle:
    return Bundle({name: spark.read.table(table) for table, name in _renamed(tables, rename).items()})


def save_to_warehouse(
    bundle: Bundle,
    rename: Rename = _same,
    mode: str = "errorifexists",
    data_format: str = "parquet",
    location: str | None = None,
    buckets: Mapping[str, tuple[int, Sequence[str]]] | None = None,
) -> None:
    """Save every table in the catalog.  With ``location`` the files go to ``<location>/<table>``, which should be
    a folder that all executors share; without it they go to the warehouse folder of the session.

    ``buckets`` gives a number of buckets and their columns per table.  Such a table is shuffled once, here, into one sorted
    file for each bucket, and tables with equal numbers of buckets over the columns they are joined or grouped by meet
    without a shuffle ever after.  Some 128 to 512 MB to a bucket are about right; a value that makes up much of a table
    makes one large bucket, which readers split only where they need no grouping."""
    renamed = _renamed(bundle, rename)

    def save(name: str) -> None:
        frame, bucket = bundle[name], (buckets or {}).get(name)
        if bucket:
            frame = frame.repartition(bucket[0], *(F.col("`" + column.replace("`", "``") + "`") for column in bucket[1]))
        writer = frame.write.format(data_format).mode(mode)
        if bucket:
            writer = writer.bucketBy(bucket[0], *bucket[1]).sortBy(*bucket[1])
        if location is not None:
            writer = writer.option("path", f"{location.rstrip('/')}/{renamed[name]}")
        writer.saveAsTable(renamed[name])

    for_each(_session(bundle), save, renamed)


def from_db(
    spark: SparkSession,
    tables: Iterable[str],
    url: str,
    rename: Rename = _same,
    properties: Mapping[str, str] | None = None,
    partition_columns: Mapping[str, str] | None = None,
    num_partitions: int | None = None,
) -> Bundle:
    """One DataFrame per database table.

    ``partition_columns`` names a numeric, date or timestamp column per table; such a table is read by
    ``num_partitions`` tasks (default: the cluster's parallelism) over equal ranges between the column's smallest
    and largest value, which the database computes.  A table without one is read by a single task, so name one
    for every table that grows.
    """
    properties = dict(properties or {})
    columns = dict(partition_columns or {})
    num_partitions = num_partitions or spark.sparkContext.defaultParallelism

    def read(table: str) -> DataFrame:
        if table not in columns:
            return spark.read.jdbc(url, table, properties=properties)
        column = columns[table]
        query = f"(select min({column}) lo, max({column}) hi from {table}) b"
        lower, upper = spark.read.jdbc(url, query, properties=properties).first()
        if lower is None:
            return spark.read.jdbc(url, table, properties=properties)
        return spark.read.jdbc(
            url,
            table,
            column=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=num_partitions,
            properties=properties,
        )

    return Bundle({name: read(table) for table, name in _renamed(tables, rename).items()})


def save_to_db(
    bundle: Bundle, url: str, rename: Rename = _same, properties: Mapping[str, str] | None = None, **options: str
) -> None:
    """Append every table over JDBC; ``numPartitions`` and ``batchsize`` in ``options`` bound the load."""
    renamed = _renamed(bundle, rename)

    def save(name: str) -> None:
        writer = bundle[name].write.mode("append").option("cascadeTruncate", "true").options(**options)
        writer.jdbc(url, renamed[name], properties=dict(properties or {}))

    for_each(_session(bundle), save, renamed)


def read_concepts(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A concept table in parquet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _session(bundle: Bundle) -> SparkSession:
    for frame in bundle.values():
        return frame.sparkSession
    return SparkSession.active()
