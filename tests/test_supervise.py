import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from meterlake.plans.reports import written_manifest
from meterlake.sources.zones import read_zone, rows_written, write_partitions, write_snapshot
from meterlake.streaming.runs import append_to
from meterlake.streaming.supervise import supervise


@pytest.fixture
def stream(spark, tmp_path):
    """Starts streams over a folder of five files, the first ones broken at a file."""
    zone, out = str(tmp_path / "zone"), str(tmp_path / "out")
    spark.range(50).repartition(5).write.parquet(zone)
    files = read_zone(spark, zone).select("_metadata.file_path").distinct()
    bad = files.agg(F.max("file_path")).first()[0]

    def make(broken_starts, every=None):
        starts = []

        def start():
            starts.append(1)
            rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(zone)
            if len(starts) <= broken_starts:
                fails = F.raise_error(F.lit("injected")).cast("long")
                rows = rows.withColumn("id", F.when(F.col("_metadata.file_path") == bad, fails).otherwise(F.col("id")))
            return append_to(rows, out, str(tmp_path / "checkpoint"), every=every)

        return start, lambda: sorted(r.id for r in spark.read.parquet(out).collect())

    return make


def test_goes_on_after_failures(spark, stream):
    start, result = stream(2)
    run = supervise(start, restarts=2, first_wait=0.01, poll=0.2)
    assert result() == list(range(50))
    assert run.attempts == 3
    record = run.table(spark).collect()
    assert [r.attempt for r in record if r.failure] == [1, 2]
    batches = [r for r in record if not r.failure]
    assert sum(r.input_rows for r in batches) == 50
    assert sorted(r.batch for r in batches) == list(range(5))


def test_gives_up_in_the_end(stream):
    start, _ = stream(9)
    with pytest.raises(StreamingQueryException):
        supervise(start, restarts=1, first_wait=0.01, poll=0.2)


def test_runs_on_until_it_is_told_to_stop(spark, stream):
    start, result = stream(0, every="100 milliseconds")
    run = supervise(start, poll=0.5, stop_after=12)
    assert result() == list(range(50))
    assert run.attempts == 1 and all(r[-1] is None for r in run.rows)


def test_rows_are_counted_while_written(spark, tmp_path):
    path = str(tmp_path / "zone")
    rows = spark.range(1000).selectExpr("id", "int(id % 7) as part")
    assert write_snapshot(rows, path, "part") == rows_written(spark, path) == 1000
    assert write_snapshot(rows.limit(0), path, "part") == rows_written(spark, path) == 0
    assert write_snapshot(rows.where("id < 5"), path, sort_within=["id"]) == 5
    other = str(tmp_path / "other")
    write_partitions(rows, other, "part")
    assert rows_written(spark, other) is None
    told = written_manifest(spark, {"one": path, "two": other, "three": rows.limit(3)})
    assert {r.zone: r.rows for r in told.collect()} == {"one": 5, "two": 1000, "three": 3}
    assert written_manifest(spark, {"one": path}).collect()[0].rows == 5
    write_snapshot(rows, path, "part")
    write_partitions(rows.where("part = 1 and id < 9"), path, "part")
    assert rows_written(spark, path) is None and read_zone(spark, path).count() == 860 - 1
