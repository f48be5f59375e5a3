"""Explicit schemas of everything that lands; nothing is ever inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

# Column names and types of the landing files, in file order, and
# the natural key of each master.
_MASTER_LAYOUTS = {
    "customers_orgs": (
        ("org_id",),
        "org_id string, org_name string, industry string, hq_region string, "
        "plan_tier string, is_enterprise boolean, signup_date date, "
        "sales_rep string, lifecycle_stage string, marketing_source string, "
        "nps_score double",
    ),
    "users": (
        ("user_id",),
        "user_id string, org_id string, email string, role string, "
        "active boolean, created_at date, last_login date",
    ),
    "resources": (
        ("resource_id",),
        "resource_id string, org_id string, service string, region string, "
        "created_at date, state string, tags_json string",
    ),
    "support_tickets": (
        ("ticket_id",),
        "ticket_id string, org_id string, category string, severity string, "
        "created_at date, resolved_at date, csat double, sla_breached boolean",
    ),
    "marketing_touches": (
        ("touch_id",),
        "touch_id string, org_id string, campaign string, channel string, "
        "timestamp date, clicked boolean, converted boolean",
    ),
    "nps_surveys": (
        ("org_id", "survey_date"),
        "org_id string, survey_date date, nps_score double, comment string",
    ),
    "billing_monthly": (
        ("invoice_id",),
        "invoice_id string, org_id string, month date, subtotal double, "
        "credits double, taxes double, currency string, "
        "exchange_rate_to_usd double",
    ),
}

# Both versions of a usage event; the last two columns exist only
# from version 2 on.
EVENT_LAYOUT = (
    "event_id string, timestamp timestamp, org_id string, resource_id string, "
    "service string, region string, metric string, value double, unit string, "
    "cost_usd_increment double, schema_version int, carbon_kg double, "
    "genai_tokens bigint"
)


# Masters whose cells may hold line breaks, being free text or JSON.
_FREE_TEXT = ("resources", "nps_surveys")


@dataclass(frozen=True)
class Master:
    """What is known about one master table before reading it. Files whose cells may hold
    line breaks are read whole by one task each; the others are split.
    """

    name: str
    keys: tuple[str, ...]
    layout: str
    multiline: bool = False

    @property
    def filename(self) -> str:
        return f"{self.name}.csv"

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.layout)


MASTERS: dict[str, Master] = {
    name: Master(name, keys, layout, name in _FREE_TEXT)
    for name, (keys, layout) in _MASTER_LAYOUTS.items()
}


def event_schema() -> StructType:
    return StructType.fromDDL(EVENT_LAYOUT)
