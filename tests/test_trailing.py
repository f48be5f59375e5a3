"""Window totals by retraction, and the live tables built on them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterlake.operators.trailing import moved, shown, summed, window_days
from meterlake.plans.live import ANOMALIES, DAILY, GENAI, TRAILING, LiveMarts
from meterlake.plans.serving import ServingStore
from meterlake.sources.zones import among, read_mark

KEYS, SUMS, LARGEST = ["org", "service"], ["cost"], ["name", "top"]
LAYOUT = "day date, org string, service string, cost double, name string, top int"


def totals_of(df):
    rows = df.select(*KEYS, shown("cost").alias("cost"), *LARGEST, "_rows").collect()
    return {tuple(r[:2]): (r.cost, r["name"], r.top, r["_rows"]) for r in rows}


def test_window_days(day):
    assert window_days(day(3), 3) == {day(1), day(2), day(3)}
    assert window_days(None, 3) == set()


def test_moved_totals_are_those_from_nothing(spark, day):
    draw = random.Random(8)
    rows = [
        (day(1 + i % 10), draw.choice(["a", "b", None]), draw.choice(["x", "y"]),
         draw.choice([None, 0.1, 0.2, 1e9, -3.3]), draw.choice([None, "m", "n"]), draw.choice([1, 2, 3]))
        for i in range(90)
    ]
    rows += [(day(2), "gone", "x", 5.0, "g", 9), (day(9), "new", "x", None, None, None)]
    table = spark.createDataFrame(rows, LAYOUT)
    totals = summed(table.where(among("day", window_days(day(4), 4))), KEYS, SUMS, LARGEST)
    for newest in range(5, 11):
        before, now = window_days(day(newest - 1), 4), window_days(day(newest), 4)
        inside = table.where(among("day", now))
        removed, added = (table.where(among("day", d)) for d in (before - now, now - before))
        totals = moved(totals, removed, added, inside, KEYS, SUMS, LARGEST)
        want = totals_of(summed(inside, KEYS, SUMS, LARGEST))
        assert totals_of(totals) == want
    assert ("gone", "x") not in want and want["new", "x"] == (None, None, None, 1)


def test_sums_leave_nothing_behind(spark, day):
    one = spark.createDataFrame([(day(1), "a", "x", 0.5, None, 1)], LAYOUT)
    many = spark.createDataFrame([(day(2), "a", "x", v, None, 1) for v in (1e9, 0.1, 0.2, 0.3)], LAYOUT)
    grown = moved(summed(one, KEYS, SUMS, LARGEST), one.limit(0), many, one.union(many), KEYS, SUMS, LARGEST)
    back = moved(grown, many, one.limit(0), one, KEYS, SUMS, LARGEST)
    assert totals_of(back) == {("a", "x"): (0.5, None, 1, 1)}
    assert moved(back, one, one.limit(0), one.limit(0), KEYS, SUMS, LARGEST).count() == 0


SILVER = (
    "event_date date, org_id string, service string, cost_usd double, requests double,"
    " genai_tokens bigint, carbon_kg double, org_name string, plan_tier string, industry string,"
    " hq_region string, cost_anomaly_flag boolean, score_zscore double, score_mad double,"
    " score_ptiles double, score_negative double, flag_zscore boolean, flag_mad boolean,"
    " flag_ptiles boolean, flag_negative boolean"
)


@pytest.fixture
def silver(spark, tmp_path):
    path = str(tmp_path / "silver")

    def land(*events):
        rows = [
            (day, org, service, cost, 1.0, 2, 0.1, org and org.upper(), "p", "i", "r", cost < 0,
             None, None, 0.0, -cost if cost < 0 else None, False, False, False, cost < 0)
            for day, org, service, cost in events
        ]
        spark.createDataFrame(rows, SILVER).write.mode("append").partitionBy("event_date").parquet(path)
        return spark.read.schema(SILVER).parquet(path)

    return land


def shown_tables(store):
    cost = store.table(TRAILING).collect()
    genai = store.table(GENAI).collect()
    odd = store.table(ANOMALIES).collect()
    return (
        {(r.org_id, r.service): (round(r.total_cost_usd, 9), r.org_name) for r in cost},
        {(r.org_id, r.event_date): (r.total_tokens, r.event_count) for r in genai},
        sorted((str(r.event_date), r.org_id, r.anomaly_score, tuple(r.methods)) for r in odd),
    )


def test_rounds_follow_silver(spark, tmp_path, silver, day):
    store = ServingStore(spark, str(tmp_path / "serving"), 2)
    live = LiveMarts(store, str(tmp_path / "state"), days=3)
    zone = silver((day(1), "a", "genai", 1.0), (day(2), "a", "genai", -2.0), (day(2), "b", "db", 4.0), (None, "a", "db", 8.0))
    assert len(live.refresh(zone)) == 3
    cost, genai, odd = shown_tables(store)
    assert cost == {("a", "genai"): (-1.0, "A"), ("b", "db"): (4.0, "B")}
    assert genai == {("a", day(1)): (2, 1), ("a", day(2)): (2, 1)}
    assert odd == [("2025-08-02", "a", 2.0, ("negative",))]
    # a late event, and a newer day that moves the window on
    since = dt.datetime.now(dt.timezone.utc)
    zone = silver((day(2), "a", "genai", 0.25), (day(4), "b", "db", -1.0), (day(1), "c", "db", 9.0))
    assert sorted(live.refresh(zone, since)) == [day(1), day(2), day(4)]
    cost, genai, odd = shown_tables(store)
    assert cost == {("a", "genai"): (-1.75, "A"), ("b", "db"): (3.0, "B")}
    assert genai[("a", day(2))] == (4, 2)
    assert [o[:2] for o in odd] == [("2025-08-02", "a"), ("2025-08-04", "b")]
    # nothing new, and everything once more
    assert live.refresh(zone, dt.datetime.now(dt.timezone.utc)) == []
    live.refresh(zone)
    assert shown_tables(store) == (cost, genai, odd)
    assert store.table(DAILY).agg(F.sum("event_count")).first()[0] == 7


@pytest.mark.parametrize("cut", ["genai", "anomalies", "trailing", "mark"])
def test_a_round_that_was_cut_off_is_finished_by_the_next(spark, tmp_path, silver, day, cut, monkeypatch):
    store = ServingStore(spark, str(tmp_path / "serving"), 2)
    live = LiveMarts(store, str(tmp_path / "state"), days=3)
    live.refresh(silver((day(1), "a", "genai", 1.0), (day(3), "a", "genai", -2.0)))
    since = dt.datetime.now(dt.timezone.utc)
    zone = silver((day(3), "a", "genai", 0.5), (day(4), "a", "genai", -7.0))

    class Lost(Exception):
        pass

    load, mark = ServingStore.load, "meterlake.plans.live.write_mark"
    lost_at = {"genai": GENAI, "anomalies": ANOMALIES, "trailing": TRAILING}.get(cut)

    def failing_load(self, name, *args, **options):
        if name == lost_at:
            raise Lost
        return load(self, name, *args, **options)

    with monkeypatch.context() as patched, pytest.raises(Lost):
        patched.setattr(ServingStore, "load", failing_load)
        if cut == "mark":
            from meterlake.plans import live as module

            whole = module.write_mark

            def failing_mark(spark, path, name, text):
                if name == "_round":
                    raise Lost
                whole(spark, path, name, text)

            patched.setattr(mark, failing_mark)
        live.refresh(zone, since)
    # no file is newer than this, so only the staged round is left to do
    live.refresh(zone, dt.datetime.now(dt.timezone.utc))
    fresh = ServingStore(spark, str(tmp_path / "fresh"), 2)
    LiveMarts(fresh, str(tmp_path / "fresh_state"), days=3).refresh(zone)
    assert shown_tables(store) == shown_tables(fresh)


def test_trailing_cost_after_rounds_without_it(spark, tmp_path, silver, day):
    store, state = ServingStore(spark, str(tmp_path / "serving"), 2), str(tmp_path / "state")
    LiveMarts(store, state, days=3).refresh(silver((day(1), "a", "genai", 1.0), (day(2), "b", "db", 4.0)))
    since = dt.datetime.now(dt.timezone.utc)
    zone = silver((day(2), "b", "db", 8.0), (day(3), "a", "db", 2.0))
    LiveMarts(store, state, (DAILY, GENAI), days=3).refresh(zone, since)
    # for other tables the rows as they were are not needed, and not written
    assert read_mark(spark, f"{state}/old", "_of_round") == "1"
    since = dt.datetime.now(dt.timezone.utc)
    zone = silver((day(3), "a", "db", 16.0))
    LiveMarts(store, state, days=3).refresh(zone, since)
    fresh = ServingStore(spark, str(tmp_path / "fresh"), 2)
    LiveMarts(fresh, str(tmp_path / "fresh_state"), days=3).refresh(zone)
    assert shown_tables(store)[0] == shown_tables(fresh)[0]
