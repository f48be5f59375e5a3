"""The zones end to end: landing, bronze, silver and quarantine, gold, serving."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators import marts
from meterlake.operators.conform import conform, enrich
from meterlake.operators.outliers import score_against, service_profile
from meterlake.operators.profiles import merged_profile
from meterlake.operators.quality import accepted, rejected, tag_quality
from meterlake.plans.history import refreshed_states
from meterlake.plans.live import LiveMarts
from meterlake.plans.reports import written_manifest
from meterlake.plans.serving import TABLES, ServingStore
from meterlake.sources.events import bronze_schema
from meterlake.sources.masters import current_master, ingest_masters
from meterlake.sources.schemas import MASTERS
from meterlake.sources.zones import current_path, read_zone, write_snapshot, write_switched
from meterlake.streaming.ingest import ingest_events
from meterlake.streaming.runs import finish
from meterlake.streaming.silver import start_silver

SLACK = dt.timedelta(minutes=10)


@dataclass(frozen=True)
class Lakehouse:
    """Where everything is kept. All steps can be repeated with the same outcome."""

    spark: SparkSession
    landing: str
    root: str
    buckets: int = 64
    exact_profile: bool = False

    def at(self, zone: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}"

    @property
    def bronze(self) -> str:
        return self.at("bronze")

    @property
    def events(self) -> str:
        return self.at("bronze/usage_events")

    @property
    def silver(self) -> str:
        return self.at("silver/scored_usage")

    @property
    def quarantine(self) -> str:
        return self.at("quarantine/rejected_usage")

    @property
    def profile(self) -> str:
        return self.at("silver/service_profile")

    @property
    def profile_states(self) -> str:
        return self.at("silver/profile_states")

    def gold(self, name: str) -> str:
        return self.at(f"gold/{name}")

    @property
    def serving(self) -> ServingStore:
        return ServingStore(self.spark, self.at("serving"), self.buckets)

    def read(self, path: str) -> DataFrame:
        return read_zone(self.spark, self.stored_at(path))

    def stored_at(self, path: str) -> str:
        """The folder that holds the rows of a zone now."""
        return current_path(self.spark, path)

    def bronze_events(self) -> DataFrame:
        return read_zone(self.spark, self.events, bronze_schema())

    def rejected_events(self) -> DataFrame:
        schema = rejected(tag_quality(conform(self.bronze_events()))).schema
        return read_zone(self.spark, self.quarantine, schema)

    # -- steps ------------------------------------------------------------------

    def land_masters(self, ingest_date: dt.date | None = None) -> None:
        ingest_masters(self.spark, self.landing, self.bronze, ingest_date)

    def land_events(self, **options) -> None:
        """Take in every event file not seen before, then stop."""
        ingest_events(
            self.spark,
            f"{self.landing.rstrip('/')}/usage_events_stream",
            self.events,
            self.at("checkpoints"),
            **options,
        )

    def build_silver(self) -> None:
        """Quality gate first, on rows as they came; then statistics over what passed,
        so that rejects do not shift them; then one pass that enriches and scores.
        """
        tagged = tag_quality(conform(self.bronze_events()))
        write_snapshot(rejected(tagged), self.quarantine, "event_date")
        clean = accepted(tagged)
        if self.exact_profile:
            write_switched(service_profile(clean), self.profile)
        else:
            self.refresh_profile()
        orgs = current_master(self.spark, self.bronze, "customers_orgs")
        scored = score_against(enrich(clean, orgs), self.read(self.profile))
        write_snapshot(scored, self.silver, "event_date")

    def refresh_profile(self) -> None:
        """Profile the whole history by reading the days that changed since last time."""
        states = refreshed_states(
            self.spark, self.events, self.profile_states,
            lambda events: accepted(tag_quality(conform(events))), bronze_schema(),
        )
        write_switched(merged_profile(states), self.profile)

    def build_gold(self, as_of: dt.date | None = None) -> None:
        silver = self.read(self.silver)
        daily = self.gold("org_daily_usage_by_service")
        write_switched(marts.daily_usage(silver), daily, "event_date")
        for name, mart in {
            "org_service_cost_14d": marts.trailing_cost(self.read(daily), as_of),
            "tickets_by_org_date": marts.tickets_by_day(
                current_master(self.spark, self.bronze, "support_tickets")
            ),
            "revenue_by_org_month": marts.revenue_by_month(
                current_master(self.spark, self.bronze, "billing_monthly")
            ),
            "genai_tokens_by_org_date": marts.genai_from_daily(self.read(daily)),
            "revenue_per_invoice": marts.revenue_per_invoice(
                current_master(self.spark, self.bronze, "billing_monthly")
            ),
            "cost_anomaly_by_org_date": marts.anomaly_by_day(silver),
        }.items():
            write_switched(mart, self.gold(name))

    def load_serving(self) -> None:
        """The marts are recomputed as a whole, so the tables are replaced as a whole."""
        for name in TABLES:
            self.serving.load(name, self.read(self.gold(name)), whole=True)

    # -- the same by stream -------------------------------------------------------

    @property
    def live(self) -> ServingStore:
        """Serving tables kept up by `stream_round`, beside those of the batch run."""
        return ServingStore(self.spark, self.at("live/serving"), self.buckets)

    def stream_round(
        self, slack: dt.timedelta = SLACK, reprofile: bool = False, **options
    ) -> list[dt.date | None]:
        """Take in new files, carry them on to live silver and quarantine, and bring the
        live usage tables up to date for the days they touch, which are returned.

        Events are scored against the profile stored last, or with `reprofile` one that
        includes them, and get the organisations of the newest snapshot. A round that is repeated, or cut off
        and run again, counts nothing twice. `slack` allows for clocks that differ.
        """
        since = dt.datetime.now(dt.timezone.utc) - slack
        self.land_events(**options)
        if reprofile:
            self.refresh_profile()
        orgs = current_master(self.spark, self.bronze, "customers_orgs")
        finish(
            *start_silver(
                self.spark, self.events, orgs, self.at("live/silver"),
                self.at("live/quarantine"), self.at("checkpoints/live"),
                self.read(self.profile),
            )
        )
        silver = self.read(self.at("live/silver"))
        return LiveMarts(self.live, self.at("live/state")).refresh(silver, since)

    def newest_day(self) -> dt.date:
        daily = self.read(self.gold("org_daily_usage_by_service"))
        return daily.agg(F.max("event_date")).first()[0]

    def manifest(self) -> DataFrame:
        """Row counts of all zones and serving tables. Those of zones that batches write
        were counted when they were written.
        """
        masters = self.spark.range(0).select(F.lit(1))
        for name in MASTERS:
            snapshot = current_master(self.spark, self.bronze, name)
            masters = masters.union(snapshot.select(F.lit(1)))
        zones: dict[str, str | DataFrame] = {
            "bronze/masters": masters,
            "bronze/usage_events": self.bronze_events(),
            "silver/scored_usage": self.silver,
            "quarantine/rejected_usage": self.quarantine,
        }
        for name in TABLES:
            zones[f"gold/{name}"] = self.stored_at(self.gold(name))
        for name in TABLES:
            zones[f"serving/{name}"] = self.serving.path(name)
        return written_manifest(self.spark, zones)

    def run(self, ingest_date: dt.date | None = None) -> None:
        self.land_masters(ingest_date)
        self.land_events()
        self.build_silver()
        self.build_gold()
        self.load_serving()
