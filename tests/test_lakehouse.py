"""All zones end to end, twice, on a small landing area."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from meterlake.plans.lakehouse import Lakehouse
from meterlake.plans.reports import partition_report, rerun_check, zone_size
from meterlake.sources.schemas import MASTERS


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    landing = tmp_path_factory.mktemp("landing")
    rows = {
        "customers_orgs": [f"o{i},Org {i},Media,eu,pro,True,2025-01-01,r,active,ad," for i in range(5)],
        "support_tickets": [f"t{i},o{i % 5},bug,high,2025-08-0{1 + i % 9},,4.0,{i % 2 == 0}" for i in range(30)],
        "billing_monthly": [f"i{i},o{i % 5},2025-0{1 + i // 5}-01,100.0,,21.0,EUR,1.1" for i in range(20)],
    }
    for name, master in MASTERS.items():
        text = [",".join(master.schema.names), *rows.get(name, [])]
        (landing / master.filename).write_text("\n".join(text) + "\n")
    stream = landing / "usage_events_stream"
    stream.mkdir()
    for part in range(6):
        events = [
            {
                "event_id": None if i == 7 and part == 0 else f"e{part}-{i}",
                "timestamp": f"2025-08-{1 + (i + part) % 20:02d}T12:00:00Z",
                "org_id": f"o{i % 6}", "service": "genai" if i % 3 == 0 else "db",
                "metric": "requests", "value": 1.0, "unit": None if i % 25 == 0 else "n",
                "cost_usd_increment": 500.0 if i == 52 and part < 2 else -2.0 if i == 51 else 1.0 + i % 9 / 10,
                "schema_version": 2, "carbon_kg": 0.1, "genai_tokens": 3,
            }
            for i in range(100)
        ]
        copies = events[:10] if part else []
        (stream / f"{part}.jsonl").write_text(
            "\n".join(json.dumps(e) for e in events + copies) + "\n"
        )
    lake = Lakehouse(spark, str(landing), str(tmp_path_factory.mktemp("lake")), 4)
    lake.run(dt.date(2025, 8, 31))
    return lake


def test_counts_are_the_same_after_a_second_run(spark, lake, tmp_path):
    first = str(tmp_path / "first")
    lake.manifest().write.parquet(first)
    lake.run(dt.date(2025, 8, 31))
    check = rerun_check(spark.read.parquet(first), lake.manifest())
    rows = {r.zone: r for r in check.collect()}
    assert len(rows) == 4 + 6 + 6
    assert all(r.stable for r in rows.values()), rows
    count = {zone: r.first_rows for zone, r in rows.items()}
    assert count["bronze/usage_events"] == 600
    assert count["bronze/masters"] == 5 + 30 + 20
    # every unit missing (4 per file), and the one null id
    assert count["quarantine/rejected_usage"] == 25
    assert count["silver/scored_usage"] == 575
    for zone in rows:
        if zone.startswith("gold/"):
            assert count[zone] == count[zone.replace("gold/", "serving/")] > 0


def test_questions(lake):
    end = lake.newest_day()
    assert end == dt.date(2025, 8, 20)
    store = lake.serving
    assert store.daily_range("o1", dt.date(2025, 8, 1), end).count() > 0
    top = store.top_services("o0", 5).collect()
    assert [r.service for r in top] == sorted(
        (r.service for r in top), key=lambda s: -{r.service: r.total_cost_usd for r in top}[s]
    )
    assert store.revenue("o3").first().revenue_usd == pytest.approx(121 * 1.1)
    assert store.genai("o0", dt.date(2025, 8, 1)).first().total_tokens > 0
    assert store.tickets("o2", dt.date(2025, 8, 1)).count() > 0
    # the organisation of neither master: its usage is kept, unnamed
    assert store.table("org_daily_usage_by_service", "o5").where("org_name is null").count() > 0


def test_anomalies(lake):
    worst = lake.serving.table("cost_anomaly_by_org_date").collect()
    assert {m for r in worst for m in r.methods} >= {"negative", "zscore", "ptiles"}
    assert max(r.anomaly_score for r in worst) > 3


def test_partition_evidence(spark, lake):
    report = partition_report(spark, lake.silver, "event_date")
    assert report.count() == 20
    total = zone_size(report).first()
    assert total.partitions == 20 and total.files >= 20 and total.bytes > 1000


def test_streamed_rounds_equal_the_batch(spark, lake):
    name = "org_daily_usage_by_service"

    def rows(store):
        table = store.table(name)
        rounded = {c: F.round(c, 6) for c in ("cost_usd", "requests", "carbon_kg")}
        return sorted(map(str, table.withColumns(rounded).collect()))

    assert len(lake.stream_round()) == 20
    assert rows(lake.live) == rows(lake.serving)
    more = {
        "event_id": "more", "timestamp": "2025-08-03T12:00:00Z", "org_id": "o1", "service": "db",
        "metric": "requests", "value": 2.0, "unit": "n", "cost_usd_increment": 1.5,
        "schema_version": 2, "carbon_kg": 0.1, "genai_tokens": 3,
    }
    with open(f"{lake.landing}/usage_events_stream/more.jsonl", "w") as file:
        file.write(json.dumps(more) + "\n")
    assert dt.date(2025, 8, 3) in lake.stream_round(slack=dt.timedelta(0))
    live = lake.live.table(name).agg(F.sum("event_count")).first()[0]
    assert live == lake.serving.table(name).agg(F.sum("event_count")).first()[0] + 1
