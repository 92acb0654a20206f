"""Files read by their headers, packages that are compared with their digests, and packages of several schemas."""

import gzip
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebundle.bundle import Bundle
from carebundle.schema import SOURCE_TABLES
from carebundle.sources import package, tables
from carebundle.sources.resolve import resolved

# --- headers -------------------------------------------------------------------------------------------------


def test_files_of_one_table_with_different_headers(spark, tmp_path):
    folder = tmp_path / "csv"
    for name in SOURCE_TABLES:
        (folder / f"{name}.csv").mkdir(parents=True)
        (folder / f"{name}.csv" / "a.csv").write_text("id,name\n1,ann\n")
    patients = folder / "patients.csv"
    (patients / "b 1.csv").write_text('﻿name,"id"\nbob,2\n')
    with gzip.open(patients / "c.csv.gz", "wt") as file:
        file.write("id,Extra\n3,x\n")
    (patients / "d.csv").write_text("")
    (patients / "e.csv").write_text("name,id\n")
    read = tables.from_csvs(spark, str(tmp_path))
    assert read["patients"].columns == ["id", "name", "Extra"]
    assert sorted(map(tuple, read["patients"].collect())) == [("1", "ann", None), ("2", "bob", None), ("3", None, "x")]
    assert read["providers"].columns == ["id", "name"] and read["providers"].count() == 1


def test_a_single_file(spark, tmp_path):
    (tmp_path / "one.csv").write_text("b,a\n1,2\n")
    assert [r.asDict() for r in tables.read_csv(spark, str(tmp_path / "one.csv")).collect()] == [{"b": "1", "a": "2"}]


def test_only_first_lines_are_read_for_headers(spark, tmp_path):
    """Files with equal headers are one scan."""
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f"a,b\n{k},x\n")
    frame = tables.read_csv(spark, str(tmp_path))
    assert frame._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and frame.count() == 3


# --- digests -------------------------------------------------------------------------------------------------


@pytest.fixture(params=["parquet", "json", "csv"])
def written(spark, tmp_path, request):
    """A package of some files a table, and where they are."""
    rows = spark.range(400).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("n"), "id")).alias("name"))
    bundle = Bundle({"person": rows.repartition(4, "id"), "none": rows.limit(0)})
    options = {"csv": {"header": True}}
    descriptor = package.write_package(package.describe(bundle, request.param), bundle, str(tmp_path / "p"), options=options, digests=True)
    return str(tmp_path / "p"), next(r for r in descriptor.resources if r.name == "person")


def _without_checksums(path):
    """The local file system's own checksums would notice before the digests do."""
    for file in Path(path).rglob(".*.crc"):
        file.unlink()


def _named(spark, path):
    return {(p.path, p.problem) for p in package.verify_package(spark, path)}


def test_an_intact_package(spark, written):
    path, resource = written
    assert package.verify_package(spark, path) == [] and len(resource.digests) == len(resource.path) == 4
    assert resource.hash.startswith("rows:400:") and package.read_package(spark, path, verify=True).bundle["person"].count() == 400
    read = package.Descriptor.from_json(open(f"{path}/datapackage.json").read())
    assert next(r for r in read.resources if r.name == "person").digests == dict(resource.digests)


def test_swapped_cut_doubled_and_missing_files(spark, written):
    path, resource = written
    a, b, c, d = resource.path
    _without_checksums(path)
    os.rename(f"{path}/{a}", f"{path}/aside")
    os.rename(f"{path}/{b}", f"{path}/{a}")
    os.rename(f"{path}/aside", f"{path}/{b}")
    assert _named(spark, path) == {(a, "changed"), (b, "changed")}
    data = open(f"{path}/{c}", "rb").read()
    open(f"{path}/{c}", "wb").write(data[: len(data) // 2])
    copy = f"{d.rsplit('/', 1)[0]}/copy-{d.rsplit('/', 1)[1]}"
    open(f"{path}/{copy}", "wb").write(open(f"{path}/{d}", "rb").read())
    os.remove(f"{path}/{d}")
    assert _named(spark, path) == {(a, "changed"), (b, "changed"), (c, "changed"), (d, "missing"), (copy, "unexpected")}
    with pytest.raises(ValueError, match="is missing"):
        package.read_package(spark, path, verify=True)


def test_a_changed_byte_and_another_order(spark, tmp_path):
    rows = [(k, f"n{k}") for k in range(50)]
    frame = spark.createDataFrame(rows, "id bigint, name string").coalesce(1)
    bundle = Bundle({"t": frame})
    resource = package.write_package(package.describe(bundle, "json"), bundle, str(tmp_path / "p"), digests=True).resources[0]
    file = f"{tmp_path}/p/{resource.path[0]}"
    _without_checksums(tmp_path)
    lines = open(file).read().splitlines()
    open(file, "w").write("\n".join(lines[::-1]) + "\n")
    assert package.verify_package(spark, str(tmp_path / "p")) == []
    open(file, "w").write("\n".join(lines).replace('"n7"', '"n8"') + "\n")
    assert _named(spark, str(tmp_path / "p")) == {(resource.path[0], "changed")}


def test_packages_without_digests_are_looked_at_for_missing_files_only(spark, tmp_path):
    bundle = Bundle({"t": spark.range(5)})
    resource = package.write_package(package.describe(bundle), bundle, str(tmp_path / "p")).resources[0]
    assert resource.digests is None and resource.hash is None and package.verify_package(spark, str(tmp_path / "p")) == []


def test_digests_merge(spark, tmp_path):
    """The digest of a table does not depend on how its rows lie in files."""
    frame = spark.range(1000).select("id", (F.col("id") % 7).cast("string").alias("text"))
    hashes = []
    for parts in (1, 5):
        bundle = Bundle({"t": frame.repartition(parts)})
        written = package.write_package(package.describe(bundle), bundle, str(tmp_path / f"p{parts}"), digests=True, single_files=parts == 1)
        assert package.verify_package(spark, str(tmp_path / f"p{parts}")) == []
        hashes.append(written.resources[0].hash)
    assert hashes[0] == hashes[1]


# --- schemas -------------------------------------------------------------------------------------------------


def test_resolution(spark):
    frame = spark.sql("select 1 as n, 2L as m, cast(1.5 as float) as f, 'x' as old, named_struct('a', 1, 'b', 'y') as s, array(1, null) as l, 'gone' as dropped")
    reader = T.StructType.fromDDL("s struct<a: bigint, c: string>, m double, n bigint, f double, name string, l array<bigint>, added int, filled string")
    rows = resolved(frame, reader, {"filled": "d"}, {"name": ["older", "old"]})
    assert [f.dataType.simpleString() for f in rows.schema] == [f.dataType.simpleString() for f in reader]
    assert rows.columns == reader.names
    row = rows.first()
    assert (row.s.a, row.s.c, row.m, row.n, row.f, row.name, row.l, row.added, row.filled) == (1, None, 2.0, 1, 1.5, "x", [1, None], None, "d")
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString() and resolved(frame.limit(0), reader, {"filled": "d"}).count() == 0


def test_what_cannot_be_resolved(spark):
    frame = spark.sql("select 'x' as a, 1L as b")
    with pytest.raises(ValueError, match="column a: string cannot be read as int; column b: bigint cannot be read as int"):
        resolved(frame, T.StructType.fromDDL("a int, b int"))
    with pytest.raises(ValueError, match="may not be null"):
        resolved(frame, T.StructType([T.StructField("c", T.LongType(), False)]))
    assert resolved(frame, T.StructType([T.StructField("c", T.LongType(), False)]), {"c": 5}).first().c == 5


def test_two_versions_of_a_package(spark, tmp_path):
    first = Bundle({"t": spark.sql("select 1 as id, 'a' as was"), "only": spark.range(2)})
    second = Bundle({"t": spark.sql("select 5000000000L as id, 'b' as name, true as flag")})
    for name, bundle in (("p1", first), ("p2", second)):
        package.write_package(package.describe(bundle), bundle, str(tmp_path / name))
    read = package.read_packages(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")], aliases={"t": {"name": ["was"]}})
    assert sorted(map(tuple, read["t"].collect())) == [(1, "a", None), (5_000_000_000, "b", True)] and read["only"].count() == 2
