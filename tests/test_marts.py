import pytest

from meterlake.operators import marts
from meterlake.operators.dedupe import one_row_per_key
from meterlake.operators.ranking import busiest, top_per_group
from meterlake.plans import questions

SILVER = (
    "org_id string, service string, event_date date, cost_usd double, requests double,"
    " genai_tokens bigint, carbon_kg double, cost_anomaly_flag boolean,"
    " org_name string, plan_tier string, industry string, hq_region string"
)


def usage(org, service, day, cost, requests=None, tokens=0, flag=False, region="eu"):
    return (org, service, day, cost, requests, tokens, None, flag, "N", "pro", "M", region)


def test_daily_usage_adds_up_regions(spark, day):
    rows = [
        usage("a", "db", day(1), 1.5, None, 3, False, "eu"),
        usage("a", "db", day(1), 2.0, 4.0, 5, True, "us"),
        usage("a", "db", day(2), 8.0),
    ]
    out = marts.daily_usage(spark.createDataFrame(rows, SILVER)).collect()
    by_day = {r.event_date: r for r in out}
    first = by_day[day(1)]
    assert (first.cost_usd, first.requests, first.genai_tokens) == (3.5, 4.0, 8)
    assert (first.event_count, first.has_anomaly, first.org_name) == (2, True, "N")
    assert first.hq_region == "us" and first.carbon_kg is None
    assert by_day[day(2)].requests is None and not by_day[day(2)].has_anomaly


def test_small_groups_are_grouped_once(spark, day):
    keys = list(marts.DAILY_KEYS)
    few = [usage(f"o{i % 90}", "db", day(1), 1.0, None, i, i == 95, "eu" if i < 90 else "us") for i in range(100)]
    few += [usage(None, None, None, -2.0, 1.0), usage(None, None, None, None, None, None)]
    many = [usage("a", s, day(1 + i % 3), float(i), 2.0, i) for i in range(60) for s in ("db", "io")]
    for rows, sparse in ((few, True), (many, False), ([], False)):
        silver = spark.createDataFrame(rows, SILVER)
        assert marts.is_sparse(silver, keys) == sparse
        got, want = marts.daily_usage_of_stored(silver), marts.daily_usage(silver)
        shuffles = got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert not rows or shuffles == (1 if sparse else 2)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("explicit", [True, False])
def test_trailing_window_edges(spark, day, explicit):
    layout = "org_id string, service string, event_date date, cost_usd double, org_name string"
    rows = [
        ("a", "db", day(20), 10.0, "A"), ("a", "db", day(7), 20.0, "A"),
        ("a", "db", day(6), 100.0, "A"), ("a", "io", day(20), 5.0, None),
    ]
    df = spark.createDataFrame(rows, layout)
    out = marts.trailing_cost(df, day(20) if explicit else None)
    assert {r.service: (r.total_cost_usd, r.org_name) for r in out.collect()} == {
        "db": (30.0, "A"), "io": (5.0, None),
    }


def test_trailing_window_opens_only_its_days(spark, tmp_path):
    path = str(tmp_path / "daily")
    spark.range(60).selectExpr(
        "'a' as org_id", "'db' as service", "1.0D as cost_usd", "'A' as org_name",
        "date_add(date '2025-07-01', int(id)) as event_date",
    ).write.partitionBy("event_date").parquet(path)
    cost = marts.trailing_cost(spark.read.parquet(path))
    assert cost.first().total_cost_usd == 14.0
    plan = cost._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "event_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_tickets(spark, day):
    layout = "org_id string, created_at date, severity string, csat double, sla_breached boolean"
    rows = [
        ("a", day(1), "high", None, True), ("a", day(1), "high", 4.0, None),
        ("a", day(1), "high", 2.0, False), ("a", day(1), "low", None, False),
        ("a", day(2), "critical", 5.0, True),
    ]
    mart = marts.tickets_by_day(spark.createDataFrame(rows, layout))
    by_key = {(r.event_date.day, r.severity): r for r in mart.collect()}
    high = by_key[1, "high"]
    assert (high.ticket_count, high.sla_breach_count, high.avg_csat) == (3, 1, 3.0)
    assert high.sla_breach_rate == pytest.approx(1 / 3)
    assert by_key[1, "low"].avg_csat is None and by_key[1, "low"].sla_breach_rate == 0
    recent = questions.ticket_evolution(mart, day(2)).collect()
    assert [r.severity for r in recent] == ["critical"]
    assert questions.critical_tickets(mart, day(1)).count() == 1
    assert questions.busiest_org(mart).first() == ("a", 5)
    assert questions.first_org(mart).first() == ("a",)


def test_revenue(spark, day):
    layout = (
        "invoice_id string, org_id string, month date, subtotal double, credits double,"
        " taxes double, currency string, exchange_rate_to_usd double"
    )
    rows = [
        ("1", "a", day(1), 100.0, 10.0, 21.0, "EUR", 1.5),
        ("2", "a", day(1), 40.0, None, None, "EUR", 2.0),
        ("3", "b", day(1), 7.0, None, 1.0, "USD", None),
        ("4", "c", day(1), 1.0, None, None, "USD", 1.0),
        ("5", "c", day(1), 1000.0, None, None, "ARS", 0.002),
        ("6", "d", day(1), None, 1.0, 1.0, "USD", 1.0),
    ]
    df = spark.createDataFrame(rows, layout)
    invoices = marts.revenue_per_invoice(df)
    assert invoices.count() == 6
    assert sorted(r.revenue_usd for r in invoices.where("org_id = 'a'").collect()) == [
        80.0, 166.5,
    ]
    months = {r.org_id: r for r in marts.revenue_by_month(df).collect()}
    assert (months["a"].revenue_usd, months["a"].subtotal) == (246.5, 140.0)
    assert (months["a"].credits, months["a"].taxes) == (10.0, 21.0)
    assert months["b"].revenue_usd is None and months["b"].taxes == 1.0
    assert months["c"].revenue_usd == 3.0 and months["c"].subtotal is None
    assert months["c"].currency is None and months["c"].invoice_count == 2
    assert months["d"].revenue_usd is None


def test_genai(spark, day):
    rows = [
        usage("a", "genai", day(1), 1.0, tokens=5), usage("a", "genai", day(1), 2.0),
        usage("a", "db", day(1), 9.0, tokens=99),
    ]
    mart = marts.genai_by_day(spark.createDataFrame(rows, SILVER))
    assert mart.collect() == [("a", day(1), 5, 3.0, 2)]


def test_anomaly_mart(spark, day):
    names = ("zscore", "mad", "ptiles", "negative")
    layout = (
        "org_id string, service string, event_date date, org_name string,"
        " cost_anomaly_flag boolean, "
        + ", ".join(f"flag_{n} boolean" for n in names) + ", "
        + ", ".join(f"score_{n} double" for n in names)
    )
    rows = [
        ("a", "db", day(1), "A", True, True, False, True, False, 4.0, 99.0, 7.5, None),
        ("a", "db", day(1), "A", True, True, False, True, False, 6.0, 1.0, 2.0, None),
        ("a", "db", day(1), "A", False, True, True, True, True, 900.0, 900.0, 900.0, 900.0),
        ("a", "io", day(1), "A", False, True, False, False, False, 8.0, 0.1, 0.0, None),
        ("a", "net", day(1), None, True, False, False, False, True, 0.1, 0.1, 0.0, 3.0),
    ]
    mart = marts.anomaly_by_day(spark.createDataFrame(rows, layout))
    out = {r.service: r for r in mart.collect()}
    assert set(out) == {"db", "net"}
    # the strongest score of a detector, where it fired; nothing for the others
    assert out["db"].scores == {"zscore": 6.0, "ptiles": 7.5}
    assert sorted(out["db"].methods) == ["ptiles", "zscore"]
    assert (out["db"].anomaly_score, out["db"].event_count) == (7.5, 2)
    assert out["net"].scores == {"negative": 3.0} and out["net"].org_name is None


def test_one_row_per_key(spark):
    rows = [(1, 5, "x"), (1, 9, "a"), (1, 9, "b"), (None, 1, "n"), (None, None, "m")]
    df = spark.createDataFrame(rows, "k int, v int, t string").repartition(3)
    assert sorted(one_row_per_key(df, ["k"], ["v"]).collect(), key=str) == [
        (1, 9, "b"), (None, 1, "n"),
    ]
    assert one_row_per_key(df.select("k"), ["k"]).count() == 2


def test_top_per_group_with_a_heavy_group(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).selectExpr("if(id < 2000, 0, id) as g", "id as v")
    top = top_per_group(df, "g", [F.desc("v")], 2)
    assert [r.v for r in top.where("g = 0").orderBy("rank").collect()] == [1999, 1998]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert busiest(df, "g", "v").first().g == 0
