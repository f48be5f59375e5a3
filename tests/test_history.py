"""What is kept up from changed days and files: profiles and window sums."""

import datetime as dt
import glob
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from meterlake.operators.outliers import BAND, service_profile
from meterlake.operators.profiles import (
    DEVIATION_RANK_ERROR,
    RANK_ERROR,
    day_states,
    merged_profile,
)
from meterlake.plans.history import refreshed_states
from meterlake.streaming.marts import LEDGER, update_ledger

EVENTS = "service string, cost_usd double, event_date date"


def spoil(folder):
    """Make all files there unreadable without a trace in the listing."""
    for path in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        seen = os.stat(path)
        with open(path, "wb") as file:
            file.write(b"x" * seen.st_size)
        os.utime(path, ns=(seen.st_atime_ns, seen.st_mtime_ns))


def rank_is(value, values, share, error):
    below = sum(v < value for v in values) / len(values)
    upto = sum(v <= value for v in values) / len(values)
    return below - error <= share <= upto + error


def test_merged_days_are_the_whole(spark, day):
    draw = random.Random(3)
    rows = [("a", draw.gauss(1e6, 3), day(1 + i % 20)) for i in range(4000)]
    rows += [("b", draw.choice([0.0, 1.25, 1.25, 9.0]), day(1 + i % 3)) for i in range(3000)]
    rows += [("one", 5.0, day(1)), ("none", None, day(1)), ("none", float("nan"), day(2)),
             (None, 3.0, day(1)), (None, 4.0, None), ("b", None, day(1))]
    events = spark.createDataFrame(rows, EVENTS)
    states = day_states(events.repartition(5))
    assert states.groupBy("service", "event_date").count().where("count > 1").isEmpty()
    got = {r.service: r for r in merged_profile(states).collect()}
    want = {r.service: r for r in service_profile(events).collect()}
    assert got.keys() == want.keys()
    for service, exact in want.items():
        found = got[service]
        assert found.n_values == exact.n_values
        for name in ("mean_cost", "std_cost"):
            expected = exact[name] if exact[name] is None else pytest.approx(exact[name], rel=1e-9)
            assert found[name] == expected, (service, name)
        values = [v for s, v, _ in rows if s == service and v is not None and v == v]
        if service is None or not values:
            assert [found[name] for name in (*BAND, "mad")] == [None] * 4
            continue
        for name, p in BAND.items():
            assert rank_is(found[name], values, p, RANK_ERROR)
        apart = [abs(v - found.p50) for v in values]
        assert rank_is(found.mad, apart, 0.5, DEVIATION_RANK_ERROR)
    assert got["b"].mad == want["b"].mad and got["one"].mad == 0.0
    assert got["a"].std_cost == pytest.approx(statistics.stdev(v for s, v, _ in rows if s == "a"))


def test_no_state(spark):
    assert merged_profile(day_states(spark.createDataFrame([], EVENTS))).collect() == []


def test_only_changed_days_are_read(spark, tmp_path, day):
    zone, state = str(tmp_path / "zone"), str(tmp_path / "state")

    def land(*rows):
        df = spark.createDataFrame(rows, EVENTS)
        df.write.mode("append").partitionBy("event_date").parquet(zone)

    def profile():
        schema = spark.createDataFrame([], EVENTS).schema
        states = refreshed_states(spark, zone, state, lambda rows: rows.where("cost_usd > 0"), schema)
        return {r.service: (r.n_values, r.mean_cost) for r in merged_profile(states).collect()}

    land(("a", 1.0, day(1)), ("a", 3.0, day(2)), ("b", 5.0, None), ("a", -9.0, day(2)))
    assert profile() == {"a": (2, 2.0), "b": (1, 5.0)}
    spoil(f"{zone}/event_date=2025-08-01")
    assert profile() == {"a": (2, 2.0), "b": (1, 5.0)}
    land(("a", 5.0, day(2)), ("c", 7.0, day(3)), ("b", 7.0, None))
    assert profile() == {"a": (3, 3.0), "b": (2, 6.0), "c": (1, 7.0)}
    # a day that goes, and one that loses its last clean row
    os.rename(f"{zone}/event_date=2025-08-01", str(tmp_path / "gone"))
    os.rename(f"{zone}/event_date=2025-08-03", str(tmp_path / "too"))
    land(("c", -1.0, day(3)))
    assert profile() == {"a": (2, 4.0), "b": (2, 6.0)}


def test_only_new_files_are_counted(spark, tmp_path):
    zone, ledger = str(tmp_path / "zone"), str(tmp_path / "ledger")
    layout = "timestamp timestamp, service string, cost_usd double, genai_tokens bigint"
    schema = spark.createDataFrame([], layout).schema

    def land(*rows):
        rows = [(dt.datetime.fromisoformat(t), s, c, 1) for t, s, c in rows]
        spark.createDataFrame(rows, layout).coalesce(1).write.mode("append").parquet(zone)

    def sums():
        found = update_ledger(spark, zone, ledger, "6 hours", schema)
        found = found.groupBy("window_start", "service").agg(F.sum("cost_usd"), F.sum("event_count"))
        return {(r[0].isoformat()[5:13], r[1]): (r[2], r[3]) for r in found.collect()}

    land(("2025-08-01T01:00", "a", 1.0), ("2025-08-01T07:00", "a", 2.0), ("2025-08-02T01:00", None, 3.0))
    first = {("08-01T00", "a"): (1.0, 1), ("08-01T06", "a"): (2.0, 1), ("08-02T00", None): (3.0, 1)}
    assert sums() == first
    spoil(zone)
    assert sums() == first
    old = glob.glob(f"{zone}/*.parquet")[0]
    os.utime(old, (1e9, 1e9))
    land(("2025-08-01T02:00", "a", 5.0), ("2025-08-03T02:00", "b", 6.0))
    assert sums() == first | {("08-01T00", "a"): (6.0, 2), ("08-03T00", "b"): (6.0, 1)}
    assert spark.read.schema(LEDGER).parquet(ledger).where("window_start is null").count() == 2
    # a file that is no longer there takes its sums along
    os.rename(old, str(tmp_path / "gone"))
    assert sums() == {("08-01T00", "a"): (5.0, 1), ("08-03T00", "b"): (6.0, 1)}
