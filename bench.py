"""Time the headline queries and print one JSON line.

The tables are first copied, untimed, into files of many row groups: a real table has them, while each of the given ones is
a single row group that only one task can read.  Every query is then run to its last row into a sink that keeps nothing:
once cold, then three times warm.  ``value`` is the sum of the warm medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from carebundle.checks.queries import QUERIES  # noqa: E402
from carebundle.session import configure  # noqa: E402

HEADLINE = (
    "to_persons",
    "to_observations",
    "to_locations",
    "to_visit_occurrences",
    "to_notes",
    "to_fhir_concepts",
    "to_condition_occurrences",
    "to_condition_occurrences_by_row_id",
    "to_procedure_occurrences",
    "to_procedure_occurrences_by_row_id",
    "to_costs",
    "to_costs_by_row_id",
    "to_providers",
    "convert_row_counts",
    "surrogate_key",
    "uuid_numeric_id",
    "number_copies",
    "with_root_provider_cohort",
    "readable_persons",
    "key_collisions",
    "orphan_keys",
    "group_count",
    "csv_roundtrip",
    "package_roundtrip",
    "supply_cache_roundtrip",
    "stream_visit_occurrences",
)


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
ROW_GROUP_BYTES = 256 << 10


def copied(spark: SparkSession, folder: str) -> str:
    """A folder with the same rows in files of many row groups."""
    target = tempfile.mkdtemp(prefix="bench-tables-")
    for table in TABLES:
        rows = spark.read.parquet(f"{folder}/{table}.parquet")
        rows.coalesce(1).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{target}/{table}.parquet")
    return target


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    local = {
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.files.maxPartitionBytes": "16m",
        "spark.sql.files.openCostInBytes": "512k",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = configure(builder, shuffle_partitions=cpus, **local).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tables = copied(spark, folder)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    names = [name for name in HEADLINE if not sys.argv[1:] or name in sys.argv[1:]]
    first = {name: run(name) for name in names}
    warm = {name: statistics.median(run(name) for _ in range(3)) for name in names}
    print(
        json.dumps(
            {
                "metric": "sum of warm medians of the headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in warm.items()},
                "first_run": {name: round(seconds, 3) for name, seconds in first.items()},
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
