import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from meterlake.checks.queries import QUERIES
from meterlake.operators import marts
from meterlake.operators.conform import conform
from meterlake.operators.outliers import service_profile
from meterlake.operators.quality import split_quality
from meterlake.plans.live import LiveMarts
from meterlake.plans.serving import ServingStore
from meterlake.sources.events import scan_lines, text_schema, typed_events
from meterlake.streaming.ingest import ingest_events, start_intake
from meterlake.streaming.marts import (
    after_newest_file,
    complete_windows,
    refresh_mart,
    update_ledger,
    windowed_usage,
)
from meterlake.streaming.runs import append_to, finish
from meterlake.streaming.silver import start_silver, stream_zone


def line(event_id, time="2025-08-01T10:00:00Z", **cells):
    row = {
        "event_id": event_id, "timestamp": time, "org_id": "a", "service": "db",
        "metric": "requests", "value": 2.5, "unit": "count",
        "cost_usd_increment": 1.0, "schema_version": 1,
    }
    return json.dumps({k: v for k, v in {**row, **cells}.items() if v is not None})


@pytest.fixture
def place(tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    class Place:
        bronze, checkpoints = str(tmp_path / "bronze"), str(tmp_path / "checkpoints")
        at = staticmethod(lambda name: str(tmp_path / name))

        @staticmethod
        def drop(name, *lines):
            (landing / name).write_text("\n".join(lines) + "\n")
            return str(landing)

    return Place


def test_each_event_once_across_files_and_runs(spark, place):
    landing = place.drop("1.jsonl", line("e1"), line("e1"), line("e2"), line(None))
    for i in range(2, 8):  # more files than one batch takes
        broken = '{"event_id": "cut", "val'
        place.drop(f"{i}.jsonl", line("e1"), line(f"x{i}"), line(None), broken)
    # an old file that comes late
    place.drop("8.jsonl", line("old", "2025-07-03T00:00:00Z"), line("e2"))
    ingest_events(spark, landing, place.bronze, place.checkpoints)
    ids = [r.event_id for r in spark.read.parquet(place.bronze).collect()]
    # rows without an id, and broken lines, are all kept for the rules to reject
    assert ids.count(None) == 7 + 6
    assert sorted(i for i in ids if i) == sorted(
        ["e1", "e2", "old"] + [f"x{i}" for i in range(2, 8)]
    )
    ingest_events(spark, landing, place.bronze, place.checkpoints)
    assert spark.read.parquet(place.bronze).count() == len(ids)
    place.drop("9.jsonl", line("e1"), line("new"))
    ingest_events(spark, landing, place.bronze, place.checkpoints)
    assert spark.read.parquet(place.bronze).count() == len(ids) + 1


def test_no_event_is_late_whatever_its_time(spark, place):
    landing = place.drop("1.jsonl", line("e1"), line("far", "2099-01-01T00:00:00Z"))
    place.drop("0.jsonl", line("e0", "2025-08-01T09:00:00Z"))
    options = {"watermark": "1 hour", "files_per_trigger": 1}
    ingest_events(spark, landing, place.bronze, place.checkpoints, **options)
    place.drop("2.jsonl", line("late", "2025-07-01T00:00:00Z"))
    ingest_events(spark, landing, place.bronze, place.checkpoints, **options)
    ids = {r.event_id for r in spark.read.parquet(place.bronze).collect()}
    assert ids == {"e0", "e1", "far", "late"}
    place.drop("3.jsonl", line("late", "2025-07-01T00:00:00Z"), line("far", "2099-01-01T00:00:00Z"))
    ingest_events(spark, landing, place.bronze, place.checkpoints, **options)
    assert spark.read.parquet(place.bronze).count() == 4


def test_bronze_is_partitioned_by_day(spark, place):
    landing = place.drop(
        "1.jsonl", line("e1", "2025-08-01T23:59:59Z"),
        line("e2", "2025-08-02T00:30:00+01:00"), line("e3", "2025-08-02T00:00:00Z"),
    )
    ingest_events(spark, landing, place.bronze, place.checkpoints)
    days = {r.event_id: r.event_date.day for r in spark.read.parquet(place.bronze).collect()}
    assert days == {"e1": 1, "e2": 1, "e3": 2}


def test_continuous_trigger(spark, place):
    landing = place.drop("1.jsonl", line("e1"))
    query = start_intake(
        spark, landing, place.bronze, place.checkpoints, every="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.isActive
        assert spark.read.parquet(place.bronze).count() == 1
    finally:
        query.stop()


def test_malformed_cells_are_told_from_missing_ones(spark, place):
    landing = place.drop(
        "1.jsonl",
        line("quoted", value="12.5", genai_tokens="7", schema_version=2),
        line("decimal", genai_tokens=5.0),
        line("half", genai_tokens=5.5),
        line("word", value="n/a", unit=None),
        line("missing", value=None),
        line("time", "yesterday"),
        '{"event_id": "cut", "val',
    )
    typed = typed_events(scan_lines(spark, landing))
    rows = {r.event_id: r for r in typed.collect()}
    assert (rows["quoted"].value, rows["quoted"].genai_tokens) == (12.5, 7)
    assert rows["decimal"].genai_tokens == 5 and not rows["decimal"].malformed_fields
    assert rows["half"].malformed_fields == ["genai_tokens"]
    assert rows["word"].malformed_fields == ["value"]
    assert rows["time"].malformed_fields == ["timestamp"]
    assert rows["missing"].malformed_fields == []
    clean, bad = split_quality(conform(typed))
    assert sorted(r.event_id for r in clean.collect()) == ["decimal", "missing", "quoted"]
    reasons = {(r.event_id, r.dq_rule) for r in bad.collect()}
    assert reasons == {
        ("half", "malformed_value"), ("word", "malformed_value"),
        ("time", "malformed_value"), (None, "event_id_null"),
    }
    assert bad.where("event_id is null").first().broken_line == '{"event_id": "cut", "val'


ORGS = "org_id string, org_name string, plan_tier string, industry string, hq_region string"


def bronze_rows(spark, rows):
    lines = spark.createDataFrame([(r,) for r in rows], "value string")
    parsed = lines.select(F.from_json("value", text_schema()).alias("v")).select("v.*")
    return typed_events(parsed).withColumn("event_date", F.to_date("timestamp"))


@pytest.mark.parametrize("scored", [False, True])
def test_silver_stream(spark, place, scored):
    orgs = spark.createDataFrame([("a", "Acme", "pro", "Media", "eu")], ORGS)
    rows = [line(f"e{i}", cost_usd_increment=1.0 + i % 7) for i in range(60)]
    rows += [line("spike", cost_usd_increment=1000.0), line("b", org_id="zzz"),
             line("nounit", unit=None), line(None)]
    bronze_rows(spark, rows).write.parquet(place.bronze)
    history = conform(spark.read.parquet(place.bronze)).where("event_id <> 'spike'")
    profile = service_profile(history) if scored else None
    silver, bad = place.at("silver"), place.at("bad")
    for _ in range(2):  # the second run finds nothing new
        finish(*start_silver(spark, place.bronze, orgs, silver, bad,
                             place.checkpoints, profile))
        out = {r.event_id: r for r in spark.read.parquet(silver).collect()}
        assert len(out) == spark.read.parquet(silver).count() == 62
        assert out["e1"].org_name == "Acme" and out["b"].org_name is None
        assert spark.read.parquet(bad).count() == 2
    if scored:
        flagged = [i for i, r in out.items() if r.cost_anomaly_flag]
        assert flagged == ["spike"]


def test_silver_has_few_files_for_a_day(spark, place):
    orgs = spark.createDataFrame([("a", "Acme", "pro", "Media", "eu")], ORGS)
    rows = [
        line(f"e{i}", f"2025-08-0{1 + i % 3}T10:00:00Z", unit="count" if i % 2 else None) for i in range(96)
    ]
    bronze_rows(spark, rows).repartition(6).write.parquet(place.bronze)
    finish(*start_silver(spark, place.bronze, orgs, place.at("silver"), place.at("bad"), place.checkpoints))
    for zone in ("silver", "bad"):
        written = spark.read.parquet(place.at(zone))
        assert written.count() == 48 and len(written.inputFiles()) == 3


def test_after_newest_file(spark, place):
    assert after_newest_file(spark, place.at("none")) is None
    rows = bronze_rows(spark, [line("e1"), line("e2", "2025-08-02T10:00:00Z")])
    rows.write.partitionBy("event_date").parquet(place.bronze)
    zone = spark.read.parquet(place.bronze)
    newest = zone.select(F.max("_metadata.file_modification_time")).first()[0]
    assert after_newest_file(spark, place.bronze) == newest + dt.timedelta(milliseconds=1)


def test_rounds_refresh_the_days_they_wrote(spark, tmp_path, monkeypatch):
    days = [dt.datetime(2024, 1, d, 12) for d in (2, 3, 4, 5, 6, 17, 18, 19)]
    events = [
        (i, days[i // 4 % 8], i % 7, ("signup", "view")[i % 2], 1000.0 if i == 50 else 1.0 + i % 3, '{"k": 1}')
        for i in range(400)
    ]
    tables = {
        "events": (events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
        "customer": ([(1, "c", 1, "s")], "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"),
        "nation": ([(1, "n", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(1, "r")], "r_regionkey int, r_name string"),
    }
    for name, (rows, layout) in tables.items():
        spark.createDataFrame(rows, layout).write.parquet(str(tmp_path / f"{name}.parquet"))
    seen, refresh = [], LiveMarts.refresh

    def noted(*args):
        seen.append({d.day for d in refresh(*args)})

    monkeypatch.setattr(LiveMarts, "refresh", noted)
    assert QUERIES["stream_anomalies"](spark, str(tmp_path)).count() > 0
    early, late = {2, 3, 4, 5, 6}, {17, 18, 19}
    assert seen[0] == seen[1] == early
    assert seen[2] == late


def test_windows_are_final_when_the_watermark_passes(spark, place):
    rows = [
        line("e1", "2025-08-01T10:00:00Z"), line("e2", "2025-08-01T20:00:00Z"),
        line("e3", "2025-08-02T10:00:00Z", genai_tokens=4), line("e4", "2025-08-03T02:00:00Z"),
    ]
    conform(bronze_rows(spark, rows)).write.parquet(place.bronze)
    out = place.at("windows")
    stream = windowed_usage(stream_zone(spark, place.bronze))
    finish(append_to(stream, out, place.checkpoints))
    got = {
        (r.window_start.day, r.service): (r.cost_usd, r.genai_tokens, r.event_count)
        for r in spark.read.parquet(out).collect()
    }
    assert got == {(1, "db"): (2.0, 0, 2), (2, "db"): (1.0, 4, 1)}
    # a late event, one without a time, and the newest day, which is still open
    late = [line("e5", "2025-08-01T11:00:00Z"), line("e6", None), line("e7", "2025-07-01T00:00:00Z")]
    conform(bronze_rows(spark, late)).write.mode("append").parquet(place.bronze)
    finish(append_to(stream, out, place.checkpoints))
    emitted = spark.read.parquet(out)
    whole = complete_windows(emitted, update_ledger(spark, place.bronze, place.at("ledger")))
    got = {str(r.window_start)[:10]: (r.cost_usd, r.event_count) for r in whole.collect()}
    assert got == {
        "2025-07-01": (1.0, 1), "2025-08-01": (3.0, 3), "2025-08-02": (1.0, 1), "2025-08-03": (1.0, 1),
    }


def test_mart_refresh_counts_nothing_twice(spark, place):
    silver = place.at("silver")
    store = ServingStore(spark, place.at("serving"), 4)
    name = "org_daily_usage_by_service"

    def land(*rows):
        out = conform(bronze_rows(spark, rows)).withColumn("cost_anomaly_flag", F.lit(False))
        for c in ("org_name", "plan_tier", "industry", "hq_region"):
            out = out.withColumn(c, F.lit("x"))
        out.write.mode("append").partitionBy("event_date").parquet(silver)

    def refresh(since=None):
        zone = spark.read.parquet(silver)
        return refresh_mart(store, name, zone, marts.daily_usage, since)

    land(line("e1"), line("e2", "2025-08-02T10:00:00Z"))
    assert len(refresh()) == 2
    refresh()
    since = dt.datetime.now(dt.timezone.utc)
    land(line("e3", "2025-08-02T11:00:00Z"), line("e4", None))
    assert sorted(map(str, refresh(since))) == ["2025-08-02", "None"]
    got = {r.event_date: r.event_count for r in store.table(name).collect()}
    assert got == {dt.date(2025, 8, 1): 1, dt.date(2025, 8, 2): 2, None: 1}
    assert refresh(dt.datetime.now(dt.timezone.utc)) == []
    # a group of a refreshed day that silver no longer has goes, other days stay
    store.load(name, store.table(name).withColumn("service", F.lit("gone")))
    assert store.row_count(name).first().rows == 6
    assert len(refresh()) == 3
    assert {r.service for r in store.table(name).collect()} == {"db"}
    with pytest.raises(ValueError):
        refresh_mart(store, "org_service_cost_14d", None, marts.trailing_cost)
