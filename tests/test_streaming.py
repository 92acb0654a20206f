from pathlib import Path

from carebundle.checks.queries import QUERIES
from carebundle.plans import convert
from carebundle.streaming.append import append_converted, stream_csvs


def test_visits_arrive_once(spark, source, tmp_path):
    folder, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    encounters = source["encounters"]

    def run():
        stream = stream_csvs(spark, folder, encounters.columns)
        append_converted(stream, convert.to_visit_occurrences, out, progress).awaitTermination()
        return sorted(tuple(row) for row in spark.read.parquet(out).select("visit_occurrence_id").collect())

    encounters.limit(1).write.option("header", True).csv(folder)
    assert run() == [(10,)] and run() == [(10,)]
    encounters.where("encounterClass = 'hospice'").write.option("header", True).mode("append").csv(folder)
    assert run() == [(10,), (11,)]


def test_row_ids_let_events_stream(spark, source, tmp_path):
    folder, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    costs = source["procedures"]
    costs.write.option("header", True).csv(folder)
    stream = stream_csvs(spark, folder, costs.columns)
    append_converted(stream, lambda f: convert.to_costs(f, ["code"]), out, progress).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_no_task_writes_a_whole_delivery(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"), "carebundle")
    before = set(shared.glob("arrived-*"))
    assert QUERIES["stream_concepts"](spark, "/root/testdata/sf0.01").count() == 60
    (arrived,) = set(shared.glob("arrived-*")) - before
    assert len(list(arrived.glob("*.parquet"))) >= 2 * 3
