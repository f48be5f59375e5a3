"""The business questions, asked of a mart or of its serving table.

Each takes any DataFrame with the mart's columns. Leaving out `org_id` answers for
every organisation at once.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.marts import Day, trailing_days
from meterlake.operators.ranking import busiest, top_per_group

TICKET_DAYS = 30


def _of_org(df: DataFrame, org_id: Any) -> DataFrame:
    return df if org_id is None else df.where(F.col("org_id") == F.lit(org_id))


def _top(df: DataFrame, org_id: Any, order: list[Column], n: int) -> DataFrame:
    if org_id is None:
        return top_per_group(df, "org_id", order, n).drop("rank")
    return _of_org(df, org_id).orderBy(*order).limit(n)


def daily_range(
    daily: DataFrame,
    start: Day,
    end: Day,
    org_id: Any = None,
) -> DataFrame:
    """Cost and requests per day and service, both ends included."""
    return (
        _of_org(daily, org_id)
        .where(F.col("event_date").between(F.lit(start), F.lit(end)))
        .select("org_id", "event_date", "service", "cost_usd", "requests")
    )


def top_services(cost: DataFrame, n: int, org_id: Any = None) -> DataFrame:
    """Services with the greatest trailing cost."""
    order = [F.desc("total_cost_usd"), F.asc("service")]
    columns = ("org_id", "service", "total_cost_usd")
    return _top(cost.select(*columns), org_id, order, n)


def ticket_evolution(
    tickets: DataFrame,
    since: Day,
    org_id: Any = None,
    severity: str | None = None,
) -> DataFrame:
    """Tickets, breaches and satisfaction per day and severity from `since` on."""
    rows = _of_org(tickets, org_id).where(F.col("event_date") >= F.lit(since))
    if severity is not None:
        rows = rows.where(F.col("severity") == severity)
    return rows.select(
        "org_id",
        "event_date",
        "severity",
        "ticket_count",
        "sla_breach_count",
        "sla_breach_rate",
        "avg_csat",
    )


def critical_tickets(
    tickets: DataFrame, since: Day, org_id: Any = None
) -> DataFrame:
    return ticket_evolution(tickets, since, org_id, "critical")


def busiest_org(
    tickets: DataFrame, days: int = TICKET_DAYS, as_of: Day | None = None
) -> DataFrame:
    """The organisation with most tickets in the trailing window."""
    recent = trailing_days(tickets, days, as_of)
    return busiest(recent, "org_id", "ticket_count", total="tickets")


def first_org(mart: DataFrame) -> DataFrame:
    """One organisation to try a question with: the least id, so always the same."""
    return mart.agg(F.min("org_id").alias("org_id"))


def monthly_revenue(revenue: DataFrame, org_id: Any = None) -> DataFrame:
    columns = (
        "org_id", "month", "revenue_usd", "subtotal", "credits", "taxes", "currency"
    )
    return _of_org(revenue, org_id).select(*columns)


def genai_usage(
    genai: DataFrame, since: Day, org_id: Any = None
) -> DataFrame:
    """Tokens and cost per day from `since` on."""
    return (
        _of_org(genai, org_id)
        .where(F.col("event_date") >= F.lit(since))
        .select("org_id", "event_date", "total_tokens", "cost_usd", "event_count")
    )


def worst_anomalies(anomalies: DataFrame, n: int, org_id: Any = None) -> DataFrame:
    """Anomalies with the greatest score; newer ones first among equals."""
    order = [F.desc("anomaly_score"), F.desc("event_date"), F.asc("service")]
    columns = (
        "org_id", "event_date", "service", "anomaly_score", "methods", "scores",
        "event_count",
    )
    return _top(anomalies.select(*columns), org_id, order, n)
