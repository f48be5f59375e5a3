"""Bringing both event versions to one shape, and attaching the organisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.operators.joins import BROADCAST_BYTES, lookup_join

# The organisation attributes every enriched event carries.
ORG_ATTRIBUTES = ("org_name", "plan_tier", "industry", "hq_region")


def conform(events: DataFrame) -> DataFrame:
    """Derive the event day and the measures; no join, no row is dropped.

    Tokens not reported count as zero, which is neutral in sums. Carbon not reported
    stays unknown, since zero would be a claim. `requests` carries the metered value
    only for the metric of that name.
    """
    return events.withColumns(
        {
            "event_date": F.to_date("timestamp"),
            "cost_usd": F.col("cost_usd_increment"),
            "requests": F.when(F.col("metric") == "requests", F.col("value")),
            "genai_tokens": F.coalesce("genai_tokens", F.lit(0).cast("bigint")),
        }
    )


def org_dimension(orgs: DataFrame) -> DataFrame:
    return orgs.select("org_id", *ORG_ATTRIBUTES)


def enrich(
    events: DataFrame,
    orgs: DataFrame,
    max_bytes: int = BROADCAST_BYTES,
    history: DataFrame | None = None,
) -> DataFrame:
    """Attach organisation attributes; events of unknown organisations keep nulls."""
    return lookup_join(events, org_dimension(orgs), "org_id", max_bytes, history)


def conform_and_enrich(events: DataFrame, orgs: DataFrame) -> DataFrame:
    return enrich(conform(events), orgs)
