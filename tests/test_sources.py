import json
from unittest.mock import MagicMock
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from carebundle.bundle import Bundle
from carebundle.schema import SOURCE_TABLES
from carebundle.sources import package, storage, tables
from carebundle.sources.package import Contributor, Descriptor, License, Resource, Source
from carebundle.sources.supply import SupplyCache


def _rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture
def bundle(frame):
    return Bundle(
        {
            "df1": frame([(1, "foo"), (2, "bar")], "id2 int, value1 string"),
            "df2": frame([(2, "qux"), (3, "wobble")], "id2 int, value2 string"),
        }
    )


# --- CSV, views, catalog, JDBC -----------------------------------------------------------------------------


def test_csv_round_trip(spark, source, tmp_path):
    tables.to_csvs(source, str(tmp_path))
    read = tables.from_csvs(spark, f"{tmp_path}/").as_source()
    for name in SOURCE_TABLES:
        assert read[name].columns == source[name].columns
        assert {f.dataType.simpleString() for f in read[name].schema.fields} == {"string"}
        assert _rows(read[name]) == _rows(source[name])


def test_csv_columns_stay_text(spark, tmp_path):
    for name in SOURCE_TABLES:
        (tmp_path / "csv").mkdir(exist_ok=True)
        (tmp_path / "csv" / f"{name}.csv").write_text("Id,CODE\n1,007\n")
    assert _rows(tables.from_csvs(spark, str(tmp_path))["conditions"]) == [("1", "007")]


def test_temp_views(spark, bundle):
    suffix = uuid4().hex
    tables.create_or_replace_temp_views(bundle, lambda name: f"{name}_{suffix}")
    read = tables.from_temp_views(spark, [f"df1_{suffix}", f"df2_{suffix}"], lambda view: view.split("_")[0])
    assert list(read) == ["df1", "df2"] and _rows(read["df2"]) == _rows(bundle["df2"])


def test_warehouse_really_saves(spark, bundle, tmp_path):
    suffix = uuid4().hex
    save = {"rename": lambda name: f"{name}_{suffix}", "location": str(tmp_path)}
    tables.save_to_warehouse(bundle, **save)
    read = tables.from_warehouse(spark, [f"df1_{suffix}"], lambda _: "df1")
    assert _rows(read["df1"]) == _rows(bundle["df1"])
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.save_to_warehouse(bundle, **save)
    tables.save_to_warehouse(bundle, mode="append", **save)
    assert spark.table(f"df1_{suffix}").count() == 4


def test_two_tables_with_one_name(spark, bundle):
    for call in (
        lambda: tables.create_or_replace_temp_views(bundle, lambda _: "same"),
        lambda: tables.save_to_warehouse(bundle, lambda _: "same"),
        lambda: tables.save_to_db(bundle, "jdbc:x", lambda _: "same"),
        lambda: tables.from_temp_views(spark, ["a", "b"], lambda _: "same"),
    ):
        with pytest.raises(ValueError, match="same"):
            call()


def test_read_from_a_database_in_parallel():
    """No database is started: the calls to Spark's reader are recorded."""
    session = MagicMock()
    session.sparkContext.defaultParallelism = 40
    session.read.jdbc.return_value.first.return_value = (5, 105)
    tables.from_db(session, ["person", "role"], "jdbc:x", str.upper, {"user": "u"}, {"person": "person_id"})
    bounds, person, role = session.read.jdbc.call_args_list
    assert "min(person_id)" in bounds.args[1] and "from person" in bounds.args[1]
    assert person.args == ("jdbc:x", "person") and person.kwargs == {
        "column": "person_id", "lowerBound": "5", "upperBound": "105", "numPartitions": 40, "properties": {"user": "u"}
    }
    assert role.args == ("jdbc:x", "role") and role.kwargs == {"properties": {"user": "u"}}


def test_empty_database_table():
    session = MagicMock()
    session.read.jdbc.return_value.first.return_value = (None, None)
    tables.from_db(session, ["t"], "jdbc:x", partition_columns={"t": "id"}, num_partitions=3)
    assert session.read.jdbc.call_args.args == ("jdbc:x", "t")


def test_append_to_a_database(spark, monkeypatch):
    monkeypatch.setattr(tables, "for_each", lambda _, action, items: [action(item) for item in items])
    frame = MagicMock()
    tables.save_to_db(Bundle({"person": frame}), "jdbc:x", str.upper, {"user": "u"}, numPartitions="4")
    writer = frame.write.mode
    writer.assert_called_once_with("append")
    options = writer.return_value.option
    options.assert_called_once_with("cascadeTruncate", "true")
    options.return_value.options.assert_called_once_with(numPartitions="4")
    options.return_value.options.return_value.jdbc.assert_called_once_with("jdbc:x", "PERSON", properties={"user": "u"})


def test_concepts(spark, frame, tmp_path):
    from carebundle.plans import concepts

    table = frame([("S", "a"), ("S", "b"), (None, "c")], "standard_concept string, concept_code string")
    table.write.parquet(str(tmp_path / "concept"))
    read = tables.read_concepts(spark, str(tmp_path / "concept"))
    assert _rows(concepts.count_by(read, "standard_concept")) == [("S", 2), (None, 1)]
    read.createOrReplaceTempView("concept_test")
    assert _rows(concepts.count_by_sql(spark, "concept_test", "standard_concept")) == [("S", 2), (None, 1)]
    assert concepts.preview(read, "concept_code", rows=2).count() == 2
    codes = read.select("concept_code").schema
    assert tables.read_concepts(spark, str(tmp_path / "concept"), codes).schema == codes


# --- data packages -----------------------------------------------------------------------------------------


def test_package_of_csv_files(spark, bundle, tmp_path):
    path = str(tmp_path / "out")
    resources = [Resource(n, (f"{n}.csv",), format="csv", schema=f"{n}.schema.json") for n in ("df1", "df2")]
    written = package.write_package(Descriptor(tuple(resources), name="two"), bundle.coalesce(1), path)
    assert all(len(r.path) == 1 and r.path[0].startswith(f"{r.name}.csv/part-") for r in written.resources)
    descriptor, read = package.read_package(spark, path)
    assert descriptor == written and descriptor.name == "two"
    assert {name: _rows(frame) for name, frame in read.items()} == {n: _rows(f) for n, f in bundle.items()}
    assert read["df1"].schema == bundle["df1"].schema
    assert all(r.bytes and r.bytes > 0 for r in descriptor.resources)


def test_package_single_files(spark, bundle, tmp_path):
    path = str(tmp_path / "out")
    more = bundle["df1"].select("id2", F.col("value1").alias("value2")).repartition(3)
    mixed = Bundle({"df1": bundle["df1"].coalesce(1), "df2": bundle["df2"].coalesce(1).unionByName(more)})
    written = package.write_package(package.describe(mixed, "csv"), mixed, path, single_files=True)
    one, many = written.resources
    assert one.path == ("df1.csv",) and (tmp_path / "out" / "df1.csv").is_file()
    assert len(many.path) > 1 and (tmp_path / "out" / "df2.csv").is_dir()
    visible = {path.name for path in (tmp_path / "out").iterdir() if not path.name.startswith(".")}
    assert visible == {"df1.csv", "df2.csv", "df1.schema.json", "df2.schema.json", package.DESCRIPTOR}
    read = package.read_package(spark, path).bundle
    assert {name: _rows(frame) for name, frame in read.items()} == {n: _rows(f) for n, f in mixed.items()}


def test_package_parquet_is_lossless(spark, source, tmp_path):
    from carebundle.plans.convert import convert

    target = convert(source)
    package.write_package(package.describe(target), target, f"file://{tmp_path}/out")
    read = package.read_package(spark, f"file://{tmp_path}/out").bundle.as_target()
    assert read.validate(allow_missing_fields=True).valid
    for name in ("note", "person", "role", "cost"):
        assert _rows(read[name]) == _rows(target[name])


def test_package_csv_options_keep_empty_text(spark, frame, tmp_path):
    bundle = Bundle({"t": frame([("", "a"), (None, "b")], "x string, y string")})
    options = {"csv": {"header": True, "nullValue": "\\N"}}
    package.write_package(package.describe(bundle, "csv"), bundle, str(tmp_path / "p"), options=options)
    for given in (None, options):
        assert _rows(package.read_package(spark, str(tmp_path / "p"), given).bundle["t"]) == _rows(bundle["t"])
    other = {"csv": {"header": False}}
    assert package.read_package(spark, str(tmp_path / "p"), other).bundle["t"].count() > 2


def test_single_files_leave_foreign_folders_alone(bundle, tmp_path):
    foreign = tmp_path / "out" / "df1.parquet_temp"
    foreign.mkdir(parents=True)
    (foreign / "mine.txt").write_text("keep")
    package.write_package(package.describe(bundle), bundle.coalesce(1), str(tmp_path / "out"), single_files=True)
    assert (foreign / "mine.txt").read_text() == "keep"


def test_files_of_partitioned_folders_are_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(6).selectExpr("id % 2 as k", "id").write.partitionBy("k").parquet(path)
    files = storage.data_files(spark, path)
    assert {file.path.split("/")[0] for file in files} == {"k=0", "k=1"}
    assert all(file.bytes == (tmp_path / "t" / file.path).stat().st_size for file in files)


def test_package_does_not_overwrite(bundle, tmp_path):
    for single in (False, True):
        path = str(tmp_path / f"out{single}")
        package.write_package(package.describe(bundle), bundle.coalesce(1), path, single_files=single)
        with pytest.raises(Exception, match="(?i)already"):
            package.write_package(package.describe(bundle), bundle.coalesce(1), path, single_files=single)


def test_package_descriptor_comes_last(bundle, tmp_path):
    broken = bundle.replace(df2=bundle["df2"].select(F.raise_error(F.lit("stop")).alias("x")))
    with pytest.raises(Exception, match="stop"):
        package.write_package(package.describe(broken), broken, str(tmp_path / "out"))
    assert not (tmp_path / "out" / package.DESCRIPTOR).exists()


def test_package_checks(spark, bundle, tmp_path):
    good = Resource("df1", ("a",), format="csv")
    path = str(tmp_path / "out")
    for resources, message in (
        ((good,), "df2"),
        ((good, Resource("df2", ("b", "c"), format="csv")), "df2: give exactly one path"),
        ((good, Resource("df2", ("b",))), "df2 has no format"),
        ((good, good, Resource("df2", ("b",), format="csv")), "same name"),
    ):
        with pytest.raises(ValueError, match=message):
            package.write_package(Descriptor(resources), bundle, path)
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / package.DESCRIPTOR).write_text('{"resources": [{"name": "x", "path": "x.csv"}]}')
    with pytest.raises(ValueError, match="x has no format"):
        package.read_package(spark, str(tmp_path / "p"))


def test_descriptor_json():
    descriptor = Descriptor(
        (Resource("t", ("t.csv",), format="csv", sources=(Source("s", email="e"),), bytes=3),),
        licenses=(License("MIT", "x"),),
        contributors=(Contributor("Ann", role="author"),),
        keywords=("health",),
    )
    raw = json.loads(descriptor.to_json())
    assert raw["resources"][0] == {
        "name": "t", "path": ["t.csv"], "format": "csv", "bytes": 3, "sources": [{"title": "s", "email": "e"}],
        "licenses": [],
    }
    assert Descriptor.from_json(descriptor.to_json()) == descriptor
    raw["resources"][0]["dialect"] = {}
    assert Descriptor.from_json(json.dumps(raw)) == descriptor


# --- supply cache ------------------------------------------------------------------------------------------


def test_supply_cache_of_a_table(spark, tmp_path):
    cache, calls = SupplyCache(spark, str(tmp_path)), []

    def supply():
        calls.append(1)
        return spark.range(3)

    first, second = cache.table("numbers", supply), cache.table("numbers", supply)
    assert len(calls) == 1 and _rows(first) == _rows(second) == [(0,), (1,), (2,)]
    assert "FileScan" in first._jdf.queryExecution().executedPlan().toString()


def test_supply_cache_repeats_a_write_that_was_cut_off(spark, bundle, tmp_path):
    cache = SupplyCache(spark, str(tmp_path))
    cache.bundle("b", bundle, lambda: bundle)
    (tmp_path / "b" / "df2" / "_SUCCESS").unlink()
    changed = Bundle({name: frame.limit(1) for name, frame in bundle.items()})
    read = cache.bundle("b", list(bundle), lambda: changed)
    assert read["df1"].count() == 2 and read["df2"].count() == 1


def test_two_sessions_that_miss_at_once(spark, tmp_path):
    cache = SupplyCache(spark, str(tmp_path))

    def supply():
        SupplyCache(spark, str(tmp_path)).table("numbers", lambda: spark.range(3))
        return spark.range(5)

    assert cache.table("numbers", supply).count() == 3
    assert [path.name for path in tmp_path.iterdir()] == ["numbers"]


def test_supply_cache_wants_all_tables(spark, bundle, tmp_path):
    with pytest.raises(ValueError, match="df3"):
        SupplyCache(spark, str(tmp_path)).bundle("b", ["df1", "df2", "df3"], lambda: bundle)


def test_supply_cache_default_root(spark):
    assert SupplyCache(spark).root.startswith(storage.shared_folder(spark))


# --- storage -----------------------------------------------------------------------------------------------


def test_shared_folder_is_the_named_one():
    session = MagicMock()
    session.conf.get.return_value = "hdfs://x/shared"
    assert storage.shared_folder(session) == "hdfs://x/shared"
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = "yarn"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(session)
    session.sparkContext.master = "local[2]"
    session.conf.get.side_effect = lambda key, *_: "file:/w/" if key == "spark.sql.warehouse.dir" else None
    assert storage.shared_folder(session) == "file:/w-shared"


def test_text_files(spark, tmp_path):
    storage.write_text(spark, f"{tmp_path}/a.txt", "é\n")
    assert storage.read_text(spark, f"{tmp_path}/a.txt") == "é\n"
    storage.write_text(spark, f"{tmp_path}/b.txt", "")
    with pytest.raises(FileExistsError):
        storage.rename(spark, f"{tmp_path}/a.txt", f"{tmp_path}/b.txt")
