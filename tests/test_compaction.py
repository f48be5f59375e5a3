import pytest
from pyspark.sql import functions as F

from meterlake.operators.upsert import LOAD, READY, note
from meterlake.sources.compaction import compact, compaction_plan, file_listing
from meterlake.sources.zones import (
    complete_slots,
    current_path,
    read_mark,
    read_zone,
    write_snapshot,
    write_switched,
)

FILES = "d date, file string, bytes bigint"


def test_bins_by_falling_size(spark, day):
    files = [(day(1), f"f{i}", n) for i, n in enumerate([90, 70, 50, 40, 10, 5])]
    files += [(day(2), "alone", 5), (day(3), "full", 80), (day(3), "full2", 99), (None, "x", 3), (None, "y", 4)]
    plan = compaction_plan(spark.createDataFrame(files, FILES), "d", 100).collect()
    bins = {(r.d, r.file): r.bin for r in plan}
    assert {d for d, _ in bins} == {day(1), None}
    first = [bins[day(1), f"f{i}"] for i in range(6)]
    # 90 is nearly full; of the others 70 + 50, then 40 + 10 + 5 begin below a multiple of 100
    assert first[0] < 0 and first[1:] == [0, 0, 1, 1, 1]
    assert bins[None, "x"] == bins[None, "y"] == 0


def zone_of(spark, path, n=40):
    rows = spark.range(n).selectExpr(
        "id", "case when id % 4 < 3 then date_add(date '2025-08-01', int(id % 4)) end as event_date"
    )
    rows.repartition(6).write.partitionBy("event_date").parquet(path)
    return rows


def files_by_day(spark, path):
    listing = file_listing(spark, path, "event_date").groupBy("event_date").count()
    return {r[0]: r[1] for r in listing.collect()}


def test_days_with_small_files_are_rewritten(spark, tmp_path):
    path, staging = str(tmp_path / "zone"), str(tmp_path / "staging")
    rows = zone_of(spark, path)
    before = files_by_day(spark, path)
    plan = compact(spark, path, staging)
    assert {r.event_date for r in plan.collect()} == {d for d, n in before.items() if n > 1}
    assert set(files_by_day(spark, path).values()) == {1}
    assert read_zone(spark, path).exceptAll(rows).isEmpty()
    assert rows.exceptAll(read_zone(spark, path)).isEmpty()
    kept = {r.file for r in file_listing(spark, path, "event_date").collect()}
    assert compact(spark, path, staging).isEmpty()
    assert {r.file for r in file_listing(spark, path, "event_date").collect()} == kept


def test_a_day_whose_files_are_full_is_left_alone(spark, tmp_path):
    path = str(tmp_path / "zone")
    zone_of(spark, path)
    assert compact(spark, path, str(tmp_path / "staging"), target_bytes=10).isEmpty()


def test_an_interrupted_run_is_finished(spark, tmp_path):
    path, staging = str(tmp_path / "zone"), str(tmp_path / "staging")
    rows = zone_of(spark, path)
    whole = read_zone(spark, path).where("event_date = '2025-08-02'").coalesce(1)
    whole.write.partitionBy("event_date").parquet(f"{staging}/{LOAD}/merged")
    note(spark, staging, LOAD, READY)
    # the day is gone from the zone when the run is lost
    left = str(tmp_path / "left")
    read_zone(spark, path).where("event_date <=> null or event_date <> '2025-08-02'").write.parquet(left)
    write_snapshot(read_zone(spark, left), path, "event_date")
    compact(spark, path, staging)
    assert read_zone(spark, path).exceptAll(rows).isEmpty()
    assert read_zone(spark, path).count() == rows.count()


def test_empty_zone(spark, tmp_path):
    path = str(tmp_path / "zone")
    write_snapshot(spark.createDataFrame([], "v int, event_date date"), path, "event_date")
    listing = spark.createDataFrame([], "event_date date, file string, bytes bigint")
    assert compaction_plan(listing, "event_date").isEmpty()


# -- switched tables ----------------------------------------------------------------


def values(spark, path):
    return sorted(r.v for r in read_zone(spark, current_path(spark, path)).collect())


def test_readers_follow_the_slot_written_last(spark, tmp_path):
    path = str(tmp_path / "table")
    assert current_path(spark, path) == path
    for n in range(1, 5):
        write_switched(spark.createDataFrame([(n,), (n,)], "v int"), path, mark=("_as_of", str(n)))
        assert values(spark, path) == [n, n]
        assert read_mark(spark, current_path(spark, path), "_as_of") == str(n)
    assert sorted(complete_slots(spark, path).values()) == [3, 4]
    # a table may be recomputed from itself
    write_switched(read_zone(spark, current_path(spark, path)).select((F.col("v") + 1).alias("v")), path)
    assert values(spark, path) == [5, 5]


@pytest.mark.parametrize("left", ["nothing", "rows", "rows without a mark"])
def test_a_lost_reload_leaves_the_old_rows(spark, tmp_path, left):
    path = str(tmp_path / "table")
    for n in (1, 2):
        write_switched(spark.createDataFrame([(n,)], "v int"), path)
    torn = f"{path}/{'a' if current_path(spark, path).endswith('b') else 'b'}"
    bad = spark.createDataFrame([(9,)], "v int")
    if left == "nothing":
        write_snapshot(bad.limit(0), torn)
    else:
        write_snapshot(bad, torn)
    assert values(spark, path) == [2]
    write_switched(spark.createDataFrame([(3,)], "v int"), path)
    assert values(spark, path) == [3]
