import datetime as dt

import pytest

from meterlake.sources.masters import (
    current_master,
    ingest_masters,
    master_path,
    rejected_master,
    scan_master,
    unread_cells,
)
from meterlake.sources.schemas import MASTERS
from meterlake.sources.zones import read_zone, write_snapshot


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "landing").mkdir()

    def write(name, *lines):
        (tmp_path / "landing" / f"{name}.csv").write_text("\n".join(lines) + "\n")
        return str(tmp_path / "landing")

    return write


TICKETS = "ticket_id,org_id,category,severity,created_at,resolved_at,csat,sla_breached"


def test_json_in_a_cell(spark, landing):
    path = landing(
        "resources",
        "resource_id,org_id,service,region,created_at,state,tags_json",
        'r1,o1,db,eu,2025-01-02,on,"{""env"": ""a,b"", ""n"": 1}"',
    )
    row = scan_master(spark, MASTERS["resources"], path).first()
    assert row.tags_json == '{"env": "a,b", "n": 1}'
    assert row.created_at == dt.date(2025, 1, 2)


def test_cells_of_the_wrong_type_become_null(spark, landing):
    path = landing("support_tickets", TICKETS, "t1,o1,x,high,2025-08-01,,bad,True")
    row = scan_master(spark, MASTERS["support_tickets"], path).first()
    assert row.csat is None and row.sla_breached is True and row.resolved_at is None


def test_snapshots(spark, landing, tmp_path):
    bronze = str(tmp_path / "bronze")
    names = ["support_tickets"]
    t1 = "t1,o1,x,high,2025-08-01,,3.0,True"
    path = landing("support_tickets", TICKETS, t1, t1, "t2,o1,x,low,2025-08-01,,,")
    ingest_masters(spark, path, bronze, dt.date(2025, 8, 1), names)
    landing("support_tickets", TICKETS, "t1,o1,x,low,2025-08-01,,4.0,True")
    for _ in range(2):  # the same day again replaces the snapshot
        ingest_masters(spark, path, bronze, dt.date(2025, 8, 2), names)
    history = read_zone(spark, master_path(bronze, "support_tickets"))
    assert {r.ingest_date.day: r["count"] for r in
            history.groupBy("ingest_date").count().collect()} == {1: 2, 2: 1}
    now = current_master(spark, bronze, "support_tickets").collect()
    assert [(r.ticket_id, r.severity, r.csat) for r in now] == [("t1", "low", 4.0)]
    # the file is named although rows were shuffled after the scan
    assert now[0].source_file.endswith("support_tickets.csv")
    assert now[0].ingest_ts is not None


def test_composite_key(spark, landing, tmp_path):
    path = landing(
        "nps_surveys", "org_id,survey_date,nps_score,comment",
        "o1,2025-01-01,5.0,a", "o1,2025-01-01,5.0,b", "o1,2025-01-02,5.0,a",
    )
    ingest_masters(spark, path, str(tmp_path / "b"), None, ["nps_surveys"])
    rows = current_master(spark, str(tmp_path / "b"), "nps_surveys").collect()
    assert sorted((r.survey_date.day, r.comment) for r in rows) == [(1, "b"), (2, "a")]


def test_rows_without_a_key_are_kept_apart(spark, landing, tmp_path):
    path = landing(
        "nps_surveys", "org_id,survey_date,nps_score,comment",
        "o1,2025-01-01,5.0,a", ",2025-01-01,5.0,b", ",2025-01-01,5.0,b", "o1,never,5.0,c",
    )
    bronze = str(tmp_path / "b")
    ingest_masters(spark, path, bronze, None, ["nps_surveys"])
    assert [r.comment for r in current_master(spark, bronze, "nps_surveys").collect()] == ["a"]
    lost = rejected_master(spark, bronze, "nps_surveys").collect()
    assert sorted((r.comment, r.dq_rule) for r in lost) == [
        ("b", "org_id_null"), ("b", "org_id_null"), ("c", "survey_date_null"),
    ]


def test_an_empty_partitioned_zone_keeps_its_schema(spark, tmp_path):
    path = str(tmp_path / "zone")
    write_snapshot(spark.createDataFrame([], "v int, d date"), path, "d")
    assert read_zone(spark, path).schema.simpleString() == "struct<v:int,d:date>"
    assert read_zone(spark, path).count() == 0


def test_rewriting_a_zone_leaves_no_stale_partition(spark, tmp_path, day):
    path = str(tmp_path / "zone")
    rows = [(1, day(1)), (2, day(2))]
    write_snapshot(spark.createDataFrame(rows, "v int, d date"), path, "d")
    write_snapshot(spark.createDataFrame(rows[:1], "v int, d date"), path, "d")
    assert read_zone(spark, path).count() == 1


def test_only_the_newest_partition_is_opened(spark, tmp_path):
    from meterlake.sources.zones import latest_snapshot

    path = str(tmp_path / "zone")
    df = spark.range(40).selectExpr("id", "date_add(date '2025-01-01', int(id % 4)) as ingest_date")
    df.write.partitionBy("ingest_date").parquet(path)
    newest = latest_snapshot(read_zone(spark, path))
    assert newest.count() == 10
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_nothing_is_lost_without_a_reason(spark, landing, tmp_path):
    path = landing(
        "resources",
        "resource_id,org_id,service,region,created_at,state,tags_json",
        'r1,o1,db,eu,2025-01-02,on,"{""env"": ""a\nb""}"', "r2,o1,db", "r3,o1,db,eu,soon,on,x",
        ",o1,db,eu,2025-01-02,on,x", "r4,o1,db,eu,2025-01-02,on,x,y,z", "r5,o1,db,eu,,on,",
    )
    bronze = str(tmp_path / "b")
    ingest_masters(spark, path, bronze, dt.date(2025, 8, 1), ["resources"])
    rows = {r.resource_id: r for r in current_master(spark, bronze, "resources").collect()}
    assert rows.keys() == {"r1", "r3", "r5"}
    assert rows["r1"].tags_json == '{"env": "a\nb"}'
    assert rows["r3"].created_at is None and rows["r5"].created_at is None
    lost = {(r.dq_rule, r.broken_line) for r in rejected_master(spark, bronze, "resources").collect()}
    assert lost == {
        ("broken_line", "r2,o1,db"), ("broken_line", "r4,o1,db,eu,2025-01-02,on,x,y,z"),
        ("resource_id_null", None),
    }
    # of the two days that are null, one was there and could not be read
    (cell,) = unread_cells(spark, bronze, "resources").collect()
    assert (cell.row_key, cell.column, cell.text) == ('["r3"]', "created_at", "soon")
    assert cell.dq_rule == "malformed_value" and cell.ingest_date == dt.date(2025, 8, 1)


def test_an_unreadable_key_is_told_twice(spark, landing, tmp_path):
    path = landing("nps_surveys", "org_id,survey_date,nps_score,comment", "o1,never,NaN,c")
    bronze = str(tmp_path / "b")
    ingest_masters(spark, path, bronze, None, ["nps_surveys"])
    assert [r.dq_rule for r in rejected_master(spark, bronze, "nps_surveys").collect()] == ["survey_date_null"]
    cells = {(r.row_key, r.column, r.text) for r in unread_cells(spark, bronze, "nps_surveys").collect()}
    assert cells == {('["o1",""]', "survey_date", "never"), ('["o1",""]', "nps_score", "NaN")}
