import hashlib
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterlake.operators.upsert import ADDING, READY, merged, note, unfinished_loads, upsert
from meterlake.plans.serving import BUCKET, MONTH, TABLES, ServingStore
from meterlake.sources.zones import read_zone

DAILY = "org_daily_usage_by_service"
DAILY_LAYOUT = (
    "org_id string, event_date date, service string, cost_usd double, requests double,"
    " genai_tokens bigint, carbon_kg double, event_count bigint, has_anomaly boolean,"
    " org_name string, plan_tier string, industry string, hq_region string"
)


@pytest.fixture
def store(spark, tmp_path):
    return ServingStore(spark, str(tmp_path / "serving"), 4)


@pytest.fixture
def daily(spark):
    def build(*rows):
        tail = (None, 0, None, 1, False, "N", "pro", "M", "eu")
        return spark.createDataFrame([(*r, *tail) for r in rows], DAILY_LAYOUT)

    return build


def digests(root):
    return {
        str(p.relative_to(root)): hashlib.md5(p.read_bytes()).hexdigest()
        for p in Path(root).rglob("*.parquet")
    }


def test_keys_and_columns():
    assert len(TABLES) == 6
    assert TABLES[DAILY].keys == ["org_id", "event_date", "service"]
    assert [t.name for t in TABLES.values() if t.measured_key] == [
        "org_service_cost_14d", "cost_anomaly_by_org_date",
    ]


def test_range_question(store, daily, day):
    store.load(DAILY, daily(("a", day(1), "db", 1.0), ("a", day(2), "io", 2.0),
                            ("a", day(2), "db", 4.0), ("a", day(3), "db", 8.0),
                            ("b", day(2), "db", 16.0)))
    rows = store.daily_range("a", day(2), day(3)).collect()
    assert [(r.event_date.day, r.service, r.cost_usd) for r in rows] == [
        (2, "db", 4.0), (2, "io", 2.0), (3, "db", 8.0),
    ]
    assert store.daily_range("nobody", day(1), day(9)).isEmpty()


def test_one_bucket_is_read(store, daily, day):
    store.load(DAILY, daily(*[(f"org{i}", day(1), "db", 1.0) for i in range(40)]))
    plan = store.daily_range("org7", day(1), day(1))._jdf.queryExecution()
    scan = plan.executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BUCKET}" in scan
    assert "EqualTo(org_id,org7)" in scan


def test_upsert_is_idempotent_and_last_write_wins(store, daily, day):
    first = daily(("a", day(1), "db", 1.0), ("a", day(2), "db", 2.0))
    store.load(DAILY, first)
    store.load(DAILY, first)
    assert store.row_count(DAILY).first().rows == 2
    store.load(DAILY, daily(("a", day(2), "db", 9.0), ("a", day(3), "db", 3.0)))
    rows = store.table(DAILY).orderBy("event_date").collect()
    assert [r.cost_usd for r in rows] == [1.0, 9.0, 3.0]


def test_repeated_keys_in_one_load(store, daily, day):
    rows = daily(*[("a", day(1), "db", float(i)) for i in range(5)])
    for _ in range(2):
        store.load(DAILY, rows, unique=False)
        assert [r.cost_usd for r in store.table(DAILY).collect()] == [4.0]


def test_untouched_buckets_keep_their_files(spark, store, daily, day):
    orgs = [f"org{i}" for i in range(20)]
    store.load(DAILY, daily(*[(o, day(1), "db", 1.0) for o in orgs]))
    before = digests(store.path(DAILY))
    store.load(DAILY, daily(("org3", day(2), "db", 5.0)))
    after = digests(store.path(DAILY))
    bucket = spark.range(1).select(store._bucket(F.lit("org3"))).first()[0]
    touched = f"{BUCKET}={bucket}/"
    assert len({k.split("/")[0] for k in before}) > 1
    assert {k: v for k, v in before.items() if not k.startswith(touched)} == {
        k: v for k, v in after.items() if not k.startswith(touched)
    }
    assert store.row_count(DAILY).first().rows == 21


def test_versions_and_null_keys(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    layout = "k string, v int, version int, part int"

    def load(*rows):
        upsert(spark.createDataFrame(list(rows), layout), path, staging, ["k"], "part",
               version="version")

    load(("a", 1, 1, 0), ("a", 2, 2, 0), (None, 3, 1, 0))
    load((None, 4, 2, 0))
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {"a": 2, None: 4}
    upsert(spark.createDataFrame([], layout), path, staging, ["k"], "part")
    assert spark.read.parquet(path).count() == 2


def test_an_interrupted_load_is_finished_by_the_next(spark, store, daily, day):
    orgs = [f"org{i}" for i in range(40)]
    store.load(DAILY, daily(*[(o, day(1), "db", 1.0) for o in orgs]))
    path, staging = store.path(DAILY), store.staging(DAILY)
    whole = read_zone(spark, path)
    later = store.laid_out(DAILY, daily(*[(o, day(1), "db", 2.0) for o in orgs[:20]]))
    merged(whole, later, TABLES[DAILY].keys).write.parquet(f"{staging}/cut/merged")
    note(spark, staging, "cut", READY)
    shutil.rmtree(f"{path}/{BUCKET}=2")
    assert unfinished_loads(spark, staging) == ["cut"]
    store.load(DAILY, daily(("org0", day(1), "db", 3.0)))
    got = {r.org_id: r.cost_usd for r in store.table(DAILY).collect()}
    assert got == {o: 3.0 if o == "org0" else 2.0 if i < 20 else 1.0 for i, o in enumerate(orgs)}
    assert unfinished_loads(spark, staging) == []


def test_rows_that_are_replaced_are_not_staged_again(spark, store, daily, day, tmp_path):
    orgs = [f"org{i}" for i in range(20)]
    store.load(DAILY, daily(*[(o, day(d), "db", 1.0) for o in orgs for d in (1, 2)]))
    at, staging = str(tmp_path / "new"), store.staging(DAILY)
    fresh = daily(*[(o, day(2), "io", 2.0) for o in orgs[:15]])
    store.laid_out(DAILY, fresh).write.parquet(at)
    second = F.col("event_date") == F.lit(day(2))
    store.load(DAILY, read_zone(spark, at), replaces=second, stored_at=at)
    got = {(r.org_id, r.event_date.day, r.service) for r in store.table(DAILY).collect()}
    want = {(o, 1, "db") for o in orgs} | {(o, 2, "io") for o in orgs[:15]}
    assert got == want and store.row_count(DAILY).first().rows == 35
    # the rows that stay are staged alone, the others are where they were
    kept = read_zone(spark, f"{staging}/load/kept")
    assert kept.count() == 20 and not Path(f"{staging}/load/incoming").exists()
    # interrupted while partitions were swapped, it is finished from both
    note(spark, staging, "load", READY, at)
    shutil.rmtree(f"{store.path(DAILY)}/{BUCKET}=2")
    store.load(DAILY, daily(("org0", day(3), "db", 3.0)))
    got = {(r.org_id, r.event_date.day, r.service) for r in store.table(DAILY).collect()}
    assert got == want | {("org0", 3, "db")} and store.row_count(DAILY).first().rows == 36


def test_rows_that_replace_none_are_added(spark, store, daily, day, tmp_path):
    orgs = [f"org{i}" for i in range(20)]
    store.load(DAILY, daily(*[(o, day(d), "db", 1.0) for o in orgs for d in (1, 2)]))
    path, staging, at = store.path(DAILY), store.staging(DAILY), str(tmp_path / "new")
    before = digests(path)
    third = F.col("event_date") == F.lit(day(3))
    store.load(DAILY, daily(*[(o, day(3), "db", 3.0) for o in orgs[:15]]), replaces=third)
    assert before.items() <= digests(path).items() and not Path(f"{staging}/load/kept").exists()
    want = {(o, d, "db", 1.0) for o in orgs for d in (1, 2)} | {(o, 3, "db", 3.0) for o in orgs[:15]}

    def got():
        rows = store.table(DAILY).collect()
        found = {(r.org_id, r.event_date.day, r.service, r.cost_usd) for r in rows}
        assert len(rows) == len(found)
        return found

    assert got() == want
    # interrupted while rows were added, it is finished with each of them once
    store.laid_out(DAILY, daily(*[(o, day(4), "io", 4.0) for o in orgs])).write.parquet(at)
    note(spark, staging, "load", ADDING, at, TABLES[DAILY].keys)
    part = read_zone(spark, at).where(F.col(BUCKET) != 1)
    part.write.mode("append").partitionBy(*TABLES[DAILY].partitions).parquet(path)
    assert unfinished_loads(spark, staging) == ["load"]
    store.load(DAILY, daily(("org0", day(5), "db", 5.0)))
    assert got() == want | {(o, 4, "io", 4.0) for o in orgs} | {("org0", 5, "db", 5.0)}
    assert unfinished_loads(spark, staging) == []
    # the same rows once more replace themselves, with a measure in the key too
    store.load(DAILY, daily(*[(o, day(3), "db", 3.0) for o in orgs[:15]]), replaces=third)
    assert got() == want | {(o, 4, "io", 4.0) for o in orgs} | {("org0", 5, "db", 5.0)}


def test_a_key_that_is_not_replaced_is_overwritten(store, daily, day):
    store.load(DAILY, daily(*[("a", day(d), "db", 1.0) for d in (1, 2, 3)], ("a", None, "db", 1.0)))
    second = F.col("event_date") == F.lit(day(2))
    store.load(DAILY, daily(("a", day(2), "io", 2.0), ("a", day(3), "db", 2.0), ("a", None, "db", 2.0)), replaces=second)
    got = {(r.event_date and r.event_date.day, r.service): r.cost_usd for r in store.table(DAILY).collect()}
    assert got == {(1, "db"): 1.0, (2, "io"): 2.0, (3, "db"): 2.0, (None, "db"): 2.0}
    assert store.row_count(DAILY).first().rows == 4
    # a condition that asks about a measure says nothing about keys
    cheap = F.col("cost_usd") < 2.0
    store.load(DAILY, daily(("a", day(2), "io", 1.0)), replaces=cheap)
    got = {(r.event_date and r.event_date.day, r.service): r.cost_usd for r in store.table(DAILY).collect()}
    assert got == {(2, "io"): 1.0, (3, "db"): 2.0, (None, "db"): 2.0}
    assert store.row_count(DAILY).first().rows == 3


def test_refreshing_a_day_leaves_other_months_alone(store, daily, day):
    march = day(1).replace(month=3)
    orgs = [f"org{i}" for i in range(20)]
    store.load(DAILY, daily(*[(o, d, "db", 1.0) for o in orgs for d in (march, day(1), day(2))]))
    before = digests(store.path(DAILY))
    store.load(DAILY, daily(*[(o, day(2), "db", 5.0) for o in orgs]))
    after = digests(store.path(DAILY))
    other = f"{MONTH}={march}"
    assert any(other in k for k in before)
    assert {k: v for k, v in before.items() if other in k} == {
        k: v for k, v in after.items() if other in k
    }
    costs = {(r.event_date, r.cost_usd) for r in store.table(DAILY).collect()}
    assert costs == {(march, 1.0), (day(1), 1.0), (day(2), 5.0)}
    plan = store.daily_range("org7", day(1), day(1))._jdf.queryExecution()
    assert f"({MONTH}" in plan.executedPlan().toString().split("PartitionFilters")[1]


def test_a_whole_mart_replaces_the_table(store, daily, day):
    store.load(DAILY, daily(*[(f"org{i}", day(1), "db", 1.0) for i in range(40)]), whole=True)
    store.load(DAILY, daily(*[(f"org{i}", day(1), "db", 2.0) for i in range(20)]), whole=True)
    assert sorted({r.cost_usd for r in store.table(DAILY).collect()}) == [2.0]
    assert store.row_count(DAILY).first().rows == 20


def test_reload_leaves_no_orphan(spark, store):
    layout = "org_id string, service string, total_cost_usd double, org_name string"
    name = "org_service_cost_14d"
    for rows in (
        [("a", "db", 5.0, "A"), ("b", "db", 1.0, "B")],
        [("a", "db", 7.0, "A"), ("a", "io", 7.0, "A"), ("a", "net", 9.0, "A")],
    ):
        store.load(name, spark.createDataFrame(rows, layout))
    assert store.row_count(name).first().rows == 3
    top = store.top_services("a", 2).collect()
    assert [(r.service, r.total_cost_usd) for r in top] == [("net", 9.0), ("db", 7.0)]
    assert store.top_services("b", 2).isEmpty()


def test_worst_anomalies_first(spark, store, day):
    layout = (
        "org_id string, event_date date, service string, anomaly_score double,"
        " methods array<string>, scores map<string,double>, event_count bigint,"
        " org_name string"
    )
    rows = [
        ("a", day(1), "db", 3.0, ["mad"], {"mad": 3.0}, 1, "A"),
        ("a", day(2), "db", 3.0, ["mad", "zscore"], {"mad": 3.0, "zscore": 1.0}, 2, "A"),
        ("a", day(1), "io", 8.0, [], {}, 1, "A"),
    ]
    store.load("cost_anomaly_by_org_date", spark.createDataFrame(rows, layout))
    worst = store.worst_anomalies("a", 2).collect()
    assert [(r.service, r.event_date.day) for r in worst] == [("io", 1), ("db", 2)]
    assert set(worst[1].methods) == set(worst[1].scores) == {"mad", "zscore"}


def test_newest_first(spark, store, day):
    tickets = "org_id string, event_date date, severity string, ticket_count bigint, sla_breach_count bigint, sla_breach_rate double, avg_csat double"
    store.load("tickets_by_org_date", spark.createDataFrame(
        [("a", day(d), s, 1, 0, 0.0, None) for d, s in
         ((1, "low"), (3, "low"), (3, "critical"), (2, "high"))], tickets))
    got = [(r.event_date.day, r.severity) for r in store.tickets("a", day(2)).collect()]
    assert got == [(3, "critical"), (3, "low"), (2, "high")]
    assert store.tickets("a", day(1), "critical").count() == 1
    revenue = "org_id string, month date, revenue_usd double, subtotal double, credits double, taxes double, currency string"
    store.load("revenue_by_org_month", spark.createDataFrame(
        [("a", day(d), 1.0, 1.0, 0.0, 0.0, "USD") for d in (1, 5, 3)], revenue))
    assert [r.month.day for r in store.revenue("a").collect()] == [5, 3, 1]
    genai = "org_id string, event_date date, total_tokens bigint, cost_usd double, event_count bigint"
    store.load("genai_tokens_by_org_date", spark.createDataFrame(
        [("a", day(d), d, 1.0, 1) for d in (1, 5, 3)], genai))
    assert [r.total_tokens for r in store.genai("a", day(2)).collect()] == [5, 3]
