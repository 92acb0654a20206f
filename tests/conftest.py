import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from carebundle.session import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[8]").appName("tests")
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = configure(builder, shuffle_partitions=8, **local).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def source(spark):
    """A tiny source bundle with the cases that go wrong."""
    from carebundle.bundle import Bundle

    uuid = "00000000-0000-0000-0000-{:012x}".format
    encounters = [
        (uuid(10), uuid(1), uuid(30), uuid(20), "2010-12-10T22:23Z", "2010-12-11T01:00Z", "inpatient"),
        (uuid(11), uuid(2), "broken", None, "2010-12-10", None, "hospice"),
    ]
    patients = [
        (uuid(1), "1950-01-02", None, "999-1", "Ann", "Lee", "F", "1 Main", "Paris", "IDF", "48.5", "2.5"),
        (uuid(2), "1960-02-30", "2001-01-01", "999-2", None, "Roy", "M", "1 Main", "Paris", "IDF", "north", "2.5"),
        (uuid(3), None, None, None, "Zoe", None, "X", None, None, None, None, None),
    ]
    conditions = [("2010-12-10", None, uuid(10), uuid(1), "C1", "pain")] * 3
    conditions += [("2010-12-11", "2010-12-12", uuid(11), uuid(2), "C1", "ache")]
    procedures = [
        ("2010-12-10T22:23Z", uuid(10), uuid(1), "P1", "scan"),
        ("2010-12-10", uuid(10), uuid(1), "P1", "scan"),
    ]
    text = lambda names: ", ".join(f"{name} string" for name in names.split())
    return Bundle(
        {
            "patients": spark.createDataFrame(
                patients, text("id birthdate deathdate ssn first last gender address city state lat lon")
            ),
            "encounters": spark.createDataFrame(
                encounters, text("id patient provider organization start stop encounterClass")
            ),
            "organizations": spark.createDataFrame([(uuid(20), "Hospital")], text("id name")),
            "conditions": spark.createDataFrame(conditions, text("start stop encounter patient code description")),
            "procedures": spark.createDataFrame(procedures, text("date encounter patient code description")),
            "providers": spark.createDataFrame([(uuid(30), "Dr", uuid(20), "F")], text("id name organization gender")),
        }
    )
