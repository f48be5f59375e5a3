"""Serving tables: one Parquet table per question, laid out for its reads.

Rows go to buckets by a hash of the organisation, so a question about one of them
opens one directory; tables with days are parted by month below that, so a question about
days opens few, and refreshing a day rewrites one month. Within a file rows are sorted
by organisation and then in the order the question wants, so row-group statistics skip
the rest.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.operators.upsert import finish_loads, latest_per_key, upsert
from meterlake.plans import questions
from meterlake.sources.zones import read_zone, slot_paths, write_switched

BUCKET = "org_bucket"
MONTH = "event_month"


@dataclass(frozen=True)
class ServingTable:
    """Key and order of a serving table. `measured_key` says that a measure is part
    of the key: then a changed value would not replace its old row, and the table is
    always reloaded as a whole.
    """

    name: str
    clustering: tuple[tuple[str, str], ...]
    layout: str
    measured_key: bool = False

    @property
    def keys(self) -> list[str]:
        return ["org_id", *[c for c, _ in self.clustering]]

    def order(self) -> list[Column]:
        direction = {"asc": F.asc, "desc": F.desc}
        return [F.asc("org_id"), *[direction[d](c) for c, d in self.clustering]]

    @property
    def by_day(self) -> bool:
        return "event_date" in self.keys

    @property
    def partitions(self) -> list[str]:
        return [BUCKET, MONTH] if self.by_day else [BUCKET]

    def schema(self, org_type: str) -> StructType:
        month = f", {MONTH} date" if self.by_day else ""
        return StructType.fromDDL(f"org_id {org_type}, {self.layout}, {BUCKET} int{month}")


# Table names, columns with their types, and clustering columns with
# their directions.
TABLES = {
    t.name: t
    for t in (
        ServingTable(
            "org_daily_usage_by_service",
            (("event_date", "asc"), ("service", "asc")),
            "event_date date, service string, cost_usd double, requests double,"
            " genai_tokens bigint, carbon_kg double, event_count bigint,"
            " has_anomaly boolean, org_name string, plan_tier string,"
            " industry string, hq_region string",
        ),
        ServingTable(
            "org_service_cost_14d",
            (("total_cost_usd", "desc"), ("service", "asc")),
            "total_cost_usd double, service string, org_name string",
            measured_key=True,
        ),
        ServingTable(
            "tickets_by_org_date",
            (("event_date", "desc"), ("severity", "asc")),
            "event_date date, severity string, ticket_count bigint,"
            " sla_breach_count bigint, sla_breach_rate double, avg_csat double",
        ),
        ServingTable(
            "revenue_by_org_month",
            (("month", "desc"),),
            "month date, revenue_usd double, subtotal double, credits double,"
            " taxes double, currency string",
        ),
        ServingTable(
            "genai_tokens_by_org_date",
            (("event_date", "desc"),),
            "event_date date, total_tokens bigint, cost_usd double,"
            " event_count bigint",
        ),
        ServingTable(
            "cost_anomaly_by_org_date",
            (("anomaly_score", "desc"), ("event_date", "desc"), ("service", "asc")),
            "anomaly_score double, event_date date, service string,"
            " methods array<string>, scores map<string, double>,"
            " event_count bigint, org_name string",
            measured_key=True,
        ),
    )
}


@dataclass(frozen=True)
class ServingStore:
    """Serving tables below `root`. `buckets` is fixed for the life of a store, and so
    is the type of organisation ids.
    """

    spark: SparkSession
    root: str
    buckets: int = 64
    org_type: str = "string"

    def base(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def path(self, name: str) -> str:
        """Where a table's rows are: of its two slots, the one written last."""
        current, other, _ = slot_paths(self.spark, self.base(name))
        return current or other

    def _bucket(self, org_id: Column) -> Column:
        return F.pmod(F.xxhash64(org_id), F.lit(self.buckets)).cast("int")

    def staging(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_staging/{name}"

    def laid_out(self, name: str, mart: DataFrame) -> DataFrame:
        """A mart's rows as its table holds them, with their bucket."""
        table = TABLES[name]
        rows = mart.withColumn("org_id", F.col("org_id").cast(self.org_type))
        rows = rows.withColumn(BUCKET, self._bucket(F.col("org_id")))
        if table.by_day:
            rows = rows.withColumn(MONTH, F.trunc("event_date", "month"))
        return rows.to(table.schema(self.org_type))

    def load(
        self,
        name: str,
        mart: DataFrame,
        unique: bool = True,
        whole: bool = False,
        replaces: Column | None = None,
        stored_at: str | None = None,
    ) -> None:
        """Bring a mart into its serving table: merge by key, or reload the table if
        its key holds a measure. Loading the same mart again changes nothing. Marts
        have each key once; rows that may repeat keys need `unique=False`. A mart that
        was recomputed as a `whole` takes the place of the table; one recomputed for
        the rows with `replaces` takes theirs, with a measure in the key too, since
        then no old row of theirs is left. Readers see a reload when it is complete.
        `stored_at` names the folder of a mart that is stored as `laid_out`, and stays
        there until it is loaded; it is not copied then.
        """
        table = TABLES[name]
        rows = self.laid_out(name, mart)
        slots = slot_paths(self.spark, self.base(name))
        current, staging = slots[0], self.staging(name)
        if current is None or whole or (table.measured_key and replaces is None):
            if current:
                # or the next upsert would finish it, in the new table
                finish_loads(self.spark, current, staging, table.partitions, table.order())
            if not unique:
                rows = latest_per_key(rows, table.keys)
            write_switched(rows, self.base(name), table.partitions, table.order(), slots=slots)
            return
        upsert(
            rows,
            current,
            staging,
            table.keys,
            table.partitions,
            sort_within=table.order(),
            unique=unique,
            replaces=replaces,
            stored_at=stored_at,
        )

    def table(
        self,
        name: str,
        org_id: Any = None,
        start: questions.Day | None = None,
        end: questions.Day | None = None,
    ) -> DataFrame:
        """A serving table, or the one bucket of it that holds `org_id`, and of a table
        by day the months from that of `start` to that of `end`.
        """
        df = read_zone(self.spark, self.path(name), TABLES[name].schema(self.org_type))
        if org_id is not None:
            key = F.lit(org_id).cast(self.org_type)
            df = df.where(F.col(BUCKET) == self._bucket(key))
        if start is not None:
            df = df.where(F.col(MONTH) >= F.trunc(F.lit(start), "month"))
        if end is not None:
            df = df.where(F.col(MONTH) <= F.trunc(F.lit(end), "month"))
        return df.drop(BUCKET, MONTH)

    def row_count(self, name: str) -> DataFrame:
        return self.table(name).agg(F.count("*").alias("rows"))

    def daily_range(self, org_id: Any, start: dt.date, end: dt.date) -> DataFrame:
        rows = self.table("org_daily_usage_by_service", org_id, start, end)
        return questions.daily_range(rows, start, end, org_id).orderBy(
            "event_date", "service"
        )

    def top_services(self, org_id: Any, n: int) -> DataFrame:
        rows = self.table("org_service_cost_14d", org_id)
        return questions.top_services(rows, n, org_id)

    def tickets(
        self, org_id: Any, since: dt.date, severity: str | None = None
    ) -> DataFrame:
        rows = self.table("tickets_by_org_date", org_id, since)
        return questions.ticket_evolution(rows, since, org_id, severity).orderBy(
            F.desc("event_date"), F.asc("severity")
        )

    def revenue(self, org_id: Any) -> DataFrame:
        rows = self.table("revenue_by_org_month", org_id)
        return questions.monthly_revenue(rows, org_id).orderBy(F.desc("month"))

    def genai(self, org_id: Any, since: dt.date) -> DataFrame:
        rows = self.table("genai_tokens_by_org_date", org_id, since)
        return questions.genai_usage(rows, since, org_id).orderBy(F.desc("event_date"))

    def worst_anomalies(self, org_id: Any, n: int) -> DataFrame:
        rows = self.table("cost_anomaly_by_org_date", org_id)
        return questions.worst_anomalies(rows, n, org_id)
