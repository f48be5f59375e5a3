"""The six marts. Grouped sums only: map tasks pre-aggregate, so the shuffle carries
at most one row per group and task, however many events a group has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.operators.conform import ORG_ATTRIBUTES
from meterlake.operators.outliers import DETECTORS

# Length of the trailing cost window, and the service of the token mart.
COST_WINDOW_DAYS = 14
GENAI_SERVICE = "genai"

# The columns of the marts, here and in the groupings below.
DAILY_KEYS = ("org_id", "service", "event_date")


Combine = Callable[[str], Column]


def rollup(
    df: DataFrame,
    keys: list[str],
    measures: Mapping[str, tuple[Column, Combine]],
    carried: list[str],
    sparse: bool = False,
) -> DataFrame:
    """One row per key: the measures, and the greatest value of each carried column.

    Aggregating text directly would make Spark sort every input row, because text
    buffers do not fit its hash aggregate. So the carried columns, which hardly vary
    within a key, first join the grouping columns; the few rows that leaves are then
    grouped by the keys alone. A measure is an aggregate and how partials combine.

    With `sparse` keys, see `is_sparse`, nearly as many rows are left as came in, and two
    groupings of them cost more than the sort. Then there is one, of the same result.
    """
    if sparse:
        return df.groupBy(*keys).agg(
            *[column.alias(name) for name, (column, _) in measures.items()],
            *[F.max(c).alias(c) for c in carried],
        )
    partial = df.groupBy(*keys, *carried).agg(
        *[column.alias(name) for name, (column, _) in measures.items()]
    )
    return partial.groupBy(*keys).agg(
        *[combine(name).alias(name) for name, (_, combine) in measures.items()],
        *[F.max(c).alias(c) for c in carried],
    )


def is_sparse(df: DataFrame, keys: list[str]) -> bool:
    """Whether there are more keys than half of the rows, about. One pass over the keys,
    for tables that are stored; only the way to group them depends on it.
    """
    found = df.agg(F.count("*"), F.approx_count_distinct(F.struct(*keys))).first()
    return found[0] < 2 * found[1]


def _sum(column: str) -> tuple[Column, Combine]:
    return F.sum(column), F.sum


def _count() -> tuple[Column, Combine]:
    return F.count("*"), F.sum


def daily_usage(silver: DataFrame, sparse: bool = False) -> DataFrame:
    """Organisation x service x day: measures over all regions, and whether any event
    was flagged. Organisation attributes are constant within a group; `max` skips
    nulls and does not depend on row order. `sparse` says that groups are small.
    """
    measures = {
        "cost_usd": _sum("cost_usd"),
        "requests": _sum("requests"),
        "genai_tokens": _sum("genai_tokens"),
        "carbon_kg": _sum("carbon_kg"),
        "event_count": _count(),
        "has_anomaly": (F.bool_or("cost_anomaly_flag"), F.bool_or),
    }
    return rollup(silver, list(DAILY_KEYS), measures, list(ORG_ATTRIBUTES), sparse)


def daily_usage_of_stored(silver: DataFrame) -> DataFrame:
    """The same, grouped in the way that the measured size of its groups asks for."""
    return daily_usage(silver, is_sparse(silver, list(DAILY_KEYS)))


Day = dt.date | Column


def newest_day(df: DataFrame, column: str = "event_date") -> Column:
    """The greatest day as a scalar subquery: usable in filters, pruned at run time."""
    return df.select(F.max(column)).scalar()


def trailing_days(
    df: DataFrame, days: int, as_of: Day | None = None, column: str = "event_date"
) -> DataFrame:
    """The last `days` days up to and including `as_of`, by default the newest day."""
    end = newest_day(df, column) if as_of is None else F.lit(as_of)
    return df.where(F.col(column).between(F.date_sub(end, days - 1), end))


def trailing_cost(
    daily: DataFrame, as_of: Day | None = None, days: int = COST_WINDOW_DAYS
) -> DataFrame:
    """Cost per organisation and service over the trailing window."""
    return rollup(
        trailing_days(daily, days, as_of),
        ["org_id", "service"],
        {"total_cost_usd": _sum("cost_usd")},
        ["org_name"],
    )


def tickets_by_day(tickets: DataFrame) -> DataFrame:
    """Organisation x creation day x severity. An unknown breach is no breach; a group
    without any satisfaction score has no mean.
    """
    breached = F.sum(F.coalesce(F.col("sla_breached").cast("int"), F.lit(0)))
    return tickets.groupBy(
        "org_id", F.col("created_at").alias("event_date"), "severity"
    ).agg(
        F.count("*").alias("ticket_count"),
        breached.alias("sla_breach_count"),
        (breached / F.count("*")).alias("sla_breach_rate"),
        F.avg("csat").alias("avg_csat"),
    )


def revenue_per_invoice(billing: DataFrame) -> DataFrame:
    """Invoices in USD: subtotal less credits plus taxes, at the invoice's own rate.

    Absent credits or taxes are zero; an absent subtotal or rate leaves revenue unknown.
    """
    return billing.withColumns(
        {c: F.ifnull(c, F.lit(0.0)) for c in ("credits", "taxes")}
    ).selectExpr(
        "org_id",
        "month",
        "(subtotal - credits + taxes) * exchange_rate_to_usd as revenue_usd",
        "subtotal",
        "credits",
        "taxes",
        "currency",
    )


def revenue_by_month(billing: DataFrame) -> DataFrame:
    """Organisation x month, invoices added up.

    Subtotal, credits and taxes stay in invoice currency and are null for a month
    billed in more than one, where their sum would mean nothing.
    """
    amounts = ("revenue_usd", "subtotal", "credits", "taxes")
    per_currency = (
        revenue_per_invoice(billing)
        .groupBy("org_id", "month", "currency")
        .agg(*[F.sum(a).alias(a) for a in amounts], F.count("*").alias("invoices"))
    )
    alone = F.count("*") == 1
    return per_currency.groupBy("org_id", "month").agg(
        F.sum("revenue_usd").alias("revenue_usd"),
        *[F.when(alone, F.sum(a)).alias(a) for a in amounts[1:]],
        F.when(alone, F.max("currency")).alias("currency"),
        F.sum("invoices").alias("invoice_count"),
    )


def genai_by_day(silver: DataFrame, service: str = GENAI_SERVICE) -> DataFrame:
    """Organisation x day of the generative service: tokens, cost, events."""
    return (
        silver.where(F.col("service") == service)
        .groupBy("org_id", "event_date")
        .agg(
            F.sum("genai_tokens").alias("total_tokens"),
            F.sum("cost_usd").alias("cost_usd"),
            F.count("*").alias("event_count"),
        )
    )


def genai_from_daily(daily: DataFrame, service: str = GENAI_SERVICE) -> DataFrame:
    """The same from the daily mart, which holds all its measures already."""
    return (
        daily.where(F.col("service") == service)
        .groupBy("org_id", "event_date")
        .agg(
            F.sum("genai_tokens").alias("total_tokens"),
            F.sum("cost_usd").alias("cost_usd"),
            F.sum("event_count").alias("event_count"),
        )
    )


def anomaly_by_day(silver: DataFrame) -> DataFrame:
    """Organisation x service x day, flagged events only.

    `scores` maps each detector that fired to its strongest score, `methods` are the
    keys of that map, and `anomaly_score` is the greatest value in it. That last one
    ranks unit-free scores next to amounts of money, which is kept as specified.
    """
    strongest = {
        m: (F.max(F.when(F.col(f"flag_{m}"), F.col(f"score_{m}"))), F.max) for m in DETECTORS
    }
    every = F.create_map(*[c for m in DETECTORS for c in (F.lit(m), F.col(m))])
    flagged = silver.where("cost_anomaly_flag")
    return (
        rollup(flagged, list(DAILY_KEYS), strongest | {"event_count": _count()}, ["org_name"])
        .withColumn("scores", F.map_filter(every, lambda _, v: v.isNotNull()))
        .select(
            *DAILY_KEYS,
            F.greatest(F.lit(0.0), *DETECTORS).alias("anomaly_score"),
            F.map_keys("scores").alias("methods"),
            "scores",
            "event_count",
            "org_name",
        )
    )
