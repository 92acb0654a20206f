"""Data packages: a folder with a ``datapackage.json`` that describes the tables in it.

The layout follows the public Data Package specification; a resource's ``schema`` names a sidecar file with an
Avro schema.  The descriptor is written last, so a folder without it is an unfinished package.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, fields, replace
from functools import reduce
from typing import Any, NamedTuple
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.schema import from_avro_json, to_avro_json
from carebundle.sources import storage
from carebundle.sources.resolve import resolved

DESCRIPTOR = "datapackage.json"
Options = Mapping[str, Mapping[str, Any]]


@dataclass(frozen=True)
class License:
    name: str
    path: str
    title: str | None = None


@dataclass(frozen=True)
class Source:
    title: str
    path: str | None = None
    email: str | None = None


@dataclass(frozen=True)
class Contributor:
    title: str
    email: str | None = None
    path: str | None = None
    role: str | None = None
    organization: str | None = None


@dataclass(frozen=True)
class Resource:
    name: str
    path: tuple[str, ...]
    profile: str | None = None
    title: str | None = None
    description: str | None = None
    format: str | None = None
    mediatype: str | None = None
    encoding: str | None = None
    dialect: Mapping[str, str] | None = None
    bytes: int | None = None
    hash: str | None = None
    digests: Mapping[str, str] | None = None
    sources: tuple[Source, ...] = ()
    licenses: tuple[License, ...] = ()
    schema: str | None = None


@dataclass(frozen=True)
class Descriptor:
    resources: tuple[Resource, ...]
    name: str | None = None
    id: str | None = None
    licenses: tuple[License, ...] = ()
    profile: str | None = None
    title: str | None = None
    description: str | None = None
    homepage: str | None = None
    version: str | None = None
    sources: tuple[Source, ...] = ()
    contributors: tuple[Contributor, ...] = ()
    keywords: tuple[str, ...] = ()
    image: str | None = None
    created: str | None = None

    def to_json(self) -> str:
        return json.dumps(_without_none(asdict(self)), indent=2)

    @staticmethod
    def from_json(text: str) -> Descriptor:
        return _build(Descriptor, json.loads(text))


class PackagedBundle(NamedTuple):
    descriptor: Descriptor
    bundle: Bundle


_NESTED = {"licenses": License, "sources": Source, "contributors": Contributor, "resources": Resource}


def _without_none(value):
    if isinstance(value, dict):
        return {key: _without_none(item) for key, item in value.items() if item is not None}
    if isinstance(value, (list, tuple)):
        return [_without_none(item) for item in value]
    return value


def _build(record: type, values: Mapping[str, Any]):
    """A record from a JSON object; properties the record does not have are ignored."""
    known = {}
    for name in (item.name for item in fields(record)):
        value = values.get(name)
        if value is None or name in ("dialect", "digests") and not value:
            continue
        if name in _NESTED:
            value = tuple(_build(_NESTED[name], item) for item in value)
        elif name in ("path", "keywords") and record in (Resource, Descriptor):
            value = (value,) if isinstance(value, str) else tuple(value)
        known[name] = value
    return record(**known)


def describe(bundle: Bundle, data_format: str = "parquet", **properties: Any) -> Descriptor:
    """A descriptor for all tables of a bundle, one folder and one sidecar schema each."""
    resources = [
        Resource(name, (f"{name}.{data_format}",), format=data_format, schema=f"{name}.schema.json") for name in bundle
    ]
    return Descriptor(tuple(resources), **properties)


def write_package(
    descriptor: Descriptor,
    bundle: Bundle,
    path: str,
    single_files: bool = False,
    options: Options | None = None,
    digests: bool = False,
) -> Descriptor:
    """Write a bundle as a data package and return the descriptor with the files written.

    ``options`` holds writer options per format, such as ``{"csv": {"header": True}}``; they are kept in the descriptor as
    the ``dialect`` of each resource, and :func:`read_package` applies them.  A folder that holds a package already is an
    error.  With ``single_files`` a table that was written as one file is renamed to the path of its
    resource; a table of several files stays a folder and is never squeezed through one task.  Coalesce the
    bundle first to get single files for small tables.

    With ``digests`` the files are read once more, and the descriptor gets a digest of the rows of each and, as ``hash``, of
    all rows of a resource, which :func:`verify_package` compares.
    """
    bundle.require(resource.name for resource in descriptor.resources)
    if len({resource.name for resource in descriptor.resources}) < len(descriptor.resources):
        raise ValueError("two resources have the same name")
    for resource in descriptor.resources:
        if len(resource.path) != 1:
            raise ValueError(f"resource {resource.name}: give exactly one path to write to")
        if not resource.format:
            raise ValueError(f"resource {resource.name} has no format")
    root = path.rstrip("/")
    spark = SparkSession.active()
    if storage.exists(spark, f"{root}/{DESCRIPTOR}"):
        raise FileExistsError(f"{root} already holds a package")

    def write(resource: Resource) -> Resource:
        frame = bundle[resource.name]
        written = _write_resource(spark, frame, resource, root, single_files, (options or {}).get(resource.format, {}))
        if resource.schema:
            storage.write_text(spark, f"{root}/{resource.schema}", to_avro_json(frame.schema))
        if digests:
            sizes = {file.path: file.bytes for file in _files(spark, root, written)}
            found = {path: f"{sizes[path]}:{digest}" for path, digest in _digests(spark, root, written, frame.schema, written.path).items()}
            written = replace(written, digests=found, hash=_merged(found.values()))
        return written

    written = replace(descriptor, resources=tuple(storage.for_each(spark, write, descriptor.resources)))
    storage.write_text(spark, f"{root}/{DESCRIPTOR}", written.to_json())
    return written


def _write_resource(
    spark: SparkSession, frame: DataFrame, resource: Resource, root: str, single_files: bool, options: Mapping[str, Any]
) -> Resource:
    relative = resource.path[0].rstrip("/")
    target = f"{root}/{relative}"
    if single_files and storage.exists(spark, target):
        raise FileExistsError(f"{target} already exists")
    if options:
        resource = replace(resource, dialect={name: _option_text(value) for name, value in options.items()})
    folder = f"{target}-{uuid4().hex}" if single_files else target
    try:
        frame.write.format(resource.format).options(**options).mode("errorifexists").save(folder)
        files = storage.data_files(spark, folder)
        size = sum(file.bytes for file in files)
        if single_files and len(files) == 1:
            storage.rename(spark, f"{folder}/{files[0].path}", target)
            return replace(resource, path=(relative,), bytes=size)
        if single_files:
            storage.rename(spark, folder, target)
        return replace(resource, path=tuple(f"{relative}/{file.path}" for file in files), bytes=size)
    finally:
        if single_files:
            storage.delete_folder(spark, folder)


def _option_text(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _reader(spark: SparkSession, resource: Resource, schema: T.StructType | None, options: Mapping[str, Any]):
    reader = spark.read.format(resource.format).options(**{**(resource.dialect or {}), **options})
    return reader.schema(schema) if schema is not None else reader


def _files(spark: SparkSession, root: str, resource: Resource) -> list[storage.FileInfo]:
    """The data files in the folders that a resource's files lie in, relative to the package."""
    folders = sorted({path.rsplit("/", 1)[0] for path in resource.path if "/" in path})
    found = []
    for folder in folders:
        if storage.exists(spark, f"{root}/{folder}"):
            found += [storage.FileInfo(f"{folder}/{file.path}", file.bytes) for file in storage.data_files(spark, f"{root}/{folder}")]
    lone = [path for path in resource.path if "/" not in path]
    return found + [storage.FileInfo(path, size) for path in lone if (size := storage.file_size(spark, f"{root}/{path}")) is not None]


def _digests(spark: SparkSession, root: str, resource: Resource, schema: T.StructType, files: Sequence[str]) -> dict[str, str]:
    """The digest of the rows of each file: their number and two sums of 64-bit hashes modulo 2^64.  A sum does not depend on
    the order of rows, and digests of files add up to that of the table.  One row for each file comes to the driver, as
    from any listing."""
    if not files:
        return {}
    paths = [f"{root}/{file}" for file in files]
    frame = _reader(spark, resource, schema, {"ignoreCorruptFiles": "true"}).load(paths)
    columns = [F.col(f"`{name.replace('`', '``')}`") for name in frame.columns]
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}) if _has_map(schema) else None
    parts = [text] if text is not None else [part for column in columns for part in (column.isNull(), column)]
    hashes = [F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)") for seed in (0, 1)]
    modulus = F.lit(str(1 << 64)).cast("decimal(38,0)")
    sums = [F.pmod(F.sum(value), modulus).cast("string").alias(f"sum{k}") for k, value in enumerate(hashes)]
    rows = frame.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    found = {unquote(row["file"]): f"{row['n']}:{int(row['sum0']):016x}:{int(row['sum1']):016x}" for row in rows}
    by_name: dict[str, list[str]] = {}
    for path in found:
        by_name.setdefault(path.rsplit("/", 1)[-1], []).append(path)
    own = {}
    for file in files:  # a file without rows has no group
        same = [path for path in by_name.get(file.rsplit("/", 1)[-1], ()) if path.endswith(f"/{file}")]
        own[file] = found[same[0]] if same else f"0:{0:016x}:{0:016x}"
    return own


def _has_map(schema: T.StructType) -> bool:
    return "map" in schema.json()


def _merged(digests: Iterable[str]) -> str:
    """The digest of all rows from those of the files, without the files' sizes."""
    total = [0, 0, 0]
    for digest in digests:
        _, n, *sums = digest.split(":")
        total = [total[0] + int(n), *((a + int(b, 16)) % (1 << 64) for a, b in zip(total[1:], sums, strict=True))]
    return f"rows:{total[0]}:{total[1]:016x}:{total[2]:016x}"


class Problem(NamedTuple):
    """What is wrong with a file: it is ``missing``, not listed (``unexpected``), or its size or rows are ``changed``."""

    resource: str
    path: str
    problem: str


def verify_package(spark: SparkSession, path: str) -> list[Problem]:
    """The files of a package that differ from its descriptor, by name; resources without digests are checked for missing files
    only.  Sizes are compared first, and only files of the right size are read; one that cannot be read to its end is
    changed.  Rows are compared as multisets: files that were swapped are both changed, a file with another order of the same
    rows is not."""
    root = path.rstrip("/")
    descriptor = Descriptor.from_json(storage.read_text(spark, f"{root}/{DESCRIPTOR}"))

    def check(resource: Resource) -> list[Problem]:
        present = {file.path: file.bytes for file in _files(spark, root, resource)}
        problems = [Problem(resource.name, file, "missing") for file in resource.path if file not in present]
        if resource.digests is None:
            return problems
        problems += [Problem(resource.name, file, "unexpected") for file in present if file not in resource.path]
        size = lambda file: int((resource.digests.get(file) or "-1:").split(":")[0])
        same = [file for file in resource.path if present.get(file) == size(file)]
        problems += [Problem(resource.name, file, "changed") for file in resource.path if file in present and file not in same]
        schema = from_avro_json(storage.read_text(spark, f"{root}/{resource.schema}")) if resource.schema else None
        if schema is None and same:
            schema = _reader(spark, resource, None, {}).load([f"{root}/{file}" for file in same]).schema
        found = _digests(spark, root, resource, schema, same) if same else {}
        problems += [Problem(resource.name, file, "changed") for file in same if resource.digests[file].split(":", 1)[1] != found[file]]
        return sorted(problems)

    return [problem for problems in storage.for_each(spark, check, descriptor.resources) for problem in problems]


def read_package(spark: SparkSession, path: str, options: Options | None = None, verify: bool = False) -> PackagedBundle:
    """Read a data package lazily; the sidecar schema of a resource, if any, is the schema of its reader, and its dialect
    holds reader options, which ``options`` overrides.  With ``verify`` its files are first compared with the descriptor, and
    a package that differs is an error that names them."""
    root = path.rstrip("/")
    if verify and (problems := verify_package(spark, root)):
        raise ValueError("the package differs from its descriptor: " + "; ".join(f"{p.path} is {p.problem}" for p in problems))
    descriptor = Descriptor.from_json(storage.read_text(spark, f"{root}/{DESCRIPTOR}"))
    frames = {}
    for resource in descriptor.resources:
        if not resource.format:
            raise ValueError(f"resource {resource.name} has no format")
        schema = from_avro_json(storage.read_text(spark, f"{root}/{resource.schema}")) if resource.schema else None
        if resource.path:
            reader = _reader(spark, resource, schema, (options or {}).get(resource.format, {}))
            frames[resource.name] = reader.load([f"{root}/{file}" for file in resource.path])
        elif schema is not None:
            frames[resource.name] = spark.createDataFrame([], schema)
        else:
            raise ValueError(f"resource {resource.name} has neither files nor a schema")
    return PackagedBundle(descriptor, Bundle(frames))


def read_packages(
    spark: SparkSession,
    paths: Sequence[str],
    schemas: Mapping[str, T.StructType] | None = None,
    defaults: Mapping[str, Mapping[str, Any]] | None = None,
    aliases: Mapping[str, Mapping[str, Sequence[str]]] | None = None,
) -> Bundle:
    """Packages written at different times, with different schemas, as one bundle under the reader's schemas: those given, else
    those of the last package that has the table.  ``defaults`` and ``aliases`` (former names) are per table and column; see
    ``resolve.resolved``.  Each package's files stay one scan of their own schema."""
    bundles = [read_package(spark, path).bundle for path in paths]
    wanted = {name: frame.schema for bundle in bundles for name, frame in bundle.items()} | dict(schemas or {})
    frames = {}
    for name, schema in wanted.items():
        parts = [
            resolved(bundle[name], schema, (defaults or {}).get(name), (aliases or {}).get(name)) for bundle in bundles if name in bundle
        ]
        if parts:
            frames[name] = reduce(DataFrame.unionByName, parts)
    return Bundle(frames)
