"""Each operator as a query over the test tables, whole tables in every case.

Results are given in plain types so that two engines can be compared value by value:
days as text, doubles rounded well below their last meaningful digit, maps and arrays
spelled out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, DoubleType

from meterlake.operators import marts, quality
from meterlake.operators.conform import conform, enrich
from meterlake.operators.dedupe import one_row_per_key
from meterlake.operators.outliers import (
    BAND,
    DETECTORS,
    flag_outside_band,
    score_against,
    service_profile,
)
from meterlake.operators.profiles import DEVIATION_RANK_ERROR, RANK_ERROR, merged_profile
from meterlake.operators.ranking import busiest
from meterlake.operators.upsert import READY, merged, note
from meterlake.plans import questions, reports
from meterlake.plans.history import refreshed_states
from meterlake.plans.live import LiveMarts
from meterlake.plans.serving import BUCKET, TABLES, ServingStore
from meterlake.session import pin_utc, scratch_path
from meterlake.sources import fixtures
from meterlake.sources.compaction import compact
from meterlake.sources.events import scan_lines, typed_events
from meterlake.sources.masters import (
    current_master,
    ingest_masters,
    rejected_master,
    scan_master,
    unread_cells,
)
from meterlake.sources.schemas import MASTERS
from meterlake.sources.zones import (
    WRITTEN,
    read_zone,
    slot_paths,
    write_mark,
    write_snapshot,
)
from meterlake.streaming.ingest import ingest_events
from meterlake.streaming.marts import (
    LEDGER,
    after_newest_file,
    complete_windows,
    refresh_mart,
    update_ledger,
    windowed_usage,
)
from meterlake.streaming.runs import append_to, finish
from meterlake.streaming.silver import start_silver, stream_zone
from meterlake.streaming.supervise import supervise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6
# invoices in USD have up to eight decimals; rounding earlier would meet exact ties
REVENUE_DIGITS = 8
# likewise scores: a ratio of two prices, scaled
SCORE_DIGITS = 10


def query(build: Callable[[Inputs], DataFrame]) -> Query:
    """Register a query under the name of its function."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Inputs(pin_utc(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def plain(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    def shown(name: str, kind) -> Column:
        if isinstance(kind, DoubleType):
            return F.round(name, digits).alias(name)
        if isinstance(kind, DateType) or name == "event_id":
            return F.col(name).cast("string").alias(name)
        return F.col(name)

    return df.select(*[shown(f.name, f.dataType) for f in df.schema])


# -- shared steps ---------------------------------------------------------------


class Inputs:
    """The test tables of one run, and the steps several queries start from. Each is
    planned at most once per run.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def store(self) -> ServingStore:
        """An empty serving store; the tables number their organisations."""
        return ServingStore(self.spark, self.scratch("serving"), 8, "bigint")

    @cached_property
    def usage(self) -> DataFrame:
        return fixtures.usage(self.spark, self.sf_dir)

    @cached_property
    def org(self) -> DataFrame:
        return fixtures.org(self.spark, self.sf_dir)

    @cached_property
    def tickets(self) -> DataFrame:
        return fixtures.tickets(self.spark, self.sf_dir)

    @cached_property
    def billing(self) -> DataFrame:
        return fixtures.billing(self.spark, self.sf_dir)

    @cached_property
    def conformed(self) -> DataFrame:
        return conform(self.usage)

    @cached_property
    def tagged(self) -> DataFrame:
        return quality.tag_quality(self.conformed)

    @cached_property
    def clean(self) -> DataFrame:
        return quality.accepted(self.tagged)

    @cached_property
    def rejected(self) -> DataFrame:
        return quality.rejected(self.tagged)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich(self.clean, self.org)

    @cached_property
    def profile(self) -> DataFrame:
        return service_profile(self.clean)

    @cached_property
    def silver(self) -> DataFrame:
        return score_against(self.enriched, self.profile)

    @cached_property
    def unscored(self) -> DataFrame:
        """For marts asked about cost alone."""
        return self.enriched.withColumn("cost_anomaly_flag", F.lit(False))

    @cached_property
    def daily_cost(self) -> DataFrame:
        return marts.daily_usage(self.unscored)

    @cached_property
    def cost_14d(self) -> DataFrame:
        return marts.trailing_cost(self.daily_cost, self.newest_usage)

    @cached_property
    def genai(self) -> DataFrame:
        return marts.genai_by_day(self.clean, fixtures.GENAI_SERVICE)

    @cached_property
    def ticket_days(self) -> DataFrame:
        return marts.tickets_by_day(self.tickets)

    @cached_property
    def anomalies(self) -> DataFrame:
        return marts.anomaly_by_day(self.silver)

    @property
    def newest_usage(self) -> Column:
        return marts.newest_day(self.clean)

    @property
    def newest_ticket(self) -> Column:
        return marts.newest_day(self.tickets, "created_at")

    @property
    def busiest_by_events(self) -> Column:
        events = self.clean.withColumn("one", F.lit(1))
        return busiest(events, "org_id", "one").select("org_id").scalar()


EVENT_COLUMNS = (
    "event_id", "org_id", "service", "metric", "event_date", "cost_usd", "requests",
    "genai_tokens", "carbon_kg",
)


# -- conformance, quality, enrichment -------------------------------------------


@query
def conform_usage(t: Inputs) -> DataFrame:
    return plain(t.conformed.select(*EVENT_COLUMNS, "schema_version"))


@query
def dq_clean(t: Inputs) -> DataFrame:
    return plain(t.clean.select(*EVENT_COLUMNS))


@query
def dq_quarantine(t: Inputs) -> DataFrame:
    bad = t.rejected
    return plain(bad.select(*EVENT_COLUMNS, "value", "unit", "dq_rule"))


@query
def dq_breakdown(t: Inputs) -> DataFrame:
    return quality.reason_breakdown(t.rejected)


@query
def dq_samples(t: Inputs) -> DataFrame:
    return plain(quality.reject_samples(t.rejected))


@query
def dq_conservation(t: Inputs) -> DataFrame:
    clean, bad = quality.split_quality(t.conformed)
    return quality.conservation(t.usage, clean, bad)


@query
def enrich_usage(t: Inputs) -> DataFrame:
    attributes = ("org_name", "plan_tier", "industry", "hq_region")
    return plain(t.enriched.select(*EVENT_COLUMNS, *attributes))


@query
def enrich_usage_spread(t: Inputs) -> DataFrame:
    """The shuffle join with heavy keys spread, whatever the size of the lookup."""
    attributes = ("org_name", "plan_tier", "industry", "hq_region")
    spread = enrich(t.clean, t.org, max_bytes=0)
    return plain(spread.select(*EVENT_COLUMNS, *attributes))


@query
def unknown_org_events(t: Inputs) -> DataFrame:
    lost = t.enriched.where("org_name is null")
    return plain(lost.select(*EVENT_COLUMNS))


# -- outliers -------------------------------------------------------------------


@query
def service_statistics(t: Inputs) -> DataFrame:
    return plain(t.profile)


@query
def service_statistics_levels(t: Inputs) -> DataFrame:
    """By sketches, counts and narrowing alone; all events once more without a service,
    which are counted and have no quantiles.
    """
    nameless = t.clean.withColumn("service", F.lit(None).cast("string"))
    return plain(service_profile(t.clean.unionByName(nameless), small_rows=0))


@query
def outlier_scores(t: Inputs) -> DataFrame:
    scores = [f"score_{m}" for m in DETECTORS]
    return plain(t.silver.select("event_id", "service", *scores), SCORE_DIGITS)


@query
def outlier_flags(t: Inputs) -> DataFrame:
    flags = [f"flag_{m}" for m in DETECTORS]
    return plain(t.silver.select("event_id", *flags, "cost_anomaly_flag"))


@query
def outlier_flags_levels(t: Inputs) -> DataFrame:
    """Flags against a profile taken in levels, joined by shuffle."""
    profile = service_profile(t.clean, small_rows=0)
    silver = score_against(t.enriched, profile, max_bytes=0)
    flags = [f"flag_{m}" for m in DETECTORS]
    return plain(silver.select("event_id", *flags, "cost_anomaly_flag"))


@query
def outlier_union_flag(t: Inputs) -> DataFrame:
    flagged = flag_outside_band(t.clean)
    return plain(flagged.select("event_id", "service", "cost_usd", "cost_anomaly_flag"))


# -- marts ----------------------------------------------------------------------


@query
def daily_usage(t: Inputs) -> DataFrame:
    return plain(marts.daily_usage(t.silver))


@query
def cost_rolling_14d(t: Inputs) -> DataFrame:
    return plain(t.cost_14d)


@query
def tickets_by_day(t: Inputs) -> DataFrame:
    return plain(t.ticket_days)


@query
def revenue_per_invoice(t: Inputs) -> DataFrame:
    invoices = marts.revenue_per_invoice(t.billing)
    return plain(invoices, REVENUE_DIGITS)


@query
def revenue_by_org_month(t: Inputs) -> DataFrame:
    months = marts.revenue_by_month(t.billing)
    return plain(months, REVENUE_DIGITS)


@query
def genai_by_day(t: Inputs) -> DataFrame:
    return plain(t.genai)


def _spelled_out(anomalies: DataFrame) -> DataFrame:
    methods = F.concat_ws(",", F.array_sort("methods")).alias("methods")
    scores = [F.col("scores")[m].alias(f"max_{m}") for m in DETECTORS]
    rest = [c for c in anomalies.columns if c not in ("methods", "scores")]
    return plain(anomalies.select(*rest, methods, *scores), SCORE_DIGITS)


@query
def anomaly_mart(t: Inputs) -> DataFrame:
    return _spelled_out(t.anomalies)


# -- questions ------------------------------------------------------------------


@query
def q_daily_range(t: Inputs) -> DataFrame:
    """Every organisation, first half of the newest month."""
    daily = t.daily_cost
    start = F.trunc(t.newest_usage, "month")
    return plain(questions.daily_range(daily, start, F.date_add(start, 14)))


@query
def q_daily_range_one_org(t: Inputs) -> DataFrame:
    """All days of the organisation with most events."""
    daily = t.daily_cost
    first = t.clean.select(F.min("event_date")).scalar()
    last = t.newest_usage
    org = t.busiest_by_events
    return plain(questions.daily_range(daily, first, last, org))


@query
def q_top_services(t: Inputs) -> DataFrame:
    return plain(questions.top_services(t.cost_14d, 3))


@query
def q_top_services_one_org(t: Inputs) -> DataFrame:
    return plain(questions.top_services(t.cost_14d, 3, t.busiest_by_events))


@query
def busiest_org_30d(t: Inputs) -> DataFrame:
    return questions.busiest_org(t.ticket_days, as_of=t.newest_ticket)


@query
def first_org(t: Inputs) -> DataFrame:
    return questions.first_org(t.daily_cost)


@query
def q_tickets(t: Inputs) -> DataFrame:
    since = F.date_sub(t.newest_ticket, 29)
    return plain(questions.ticket_evolution(t.ticket_days, since))


@query
def q_tickets_busiest_org(t: Inputs) -> DataFrame:
    tickets = t.ticket_days
    newest = t.newest_ticket
    org = questions.busiest_org(tickets, as_of=newest).select("org_id").scalar()
    since = F.date_sub(newest, 29)
    return plain(questions.ticket_evolution(tickets, since, org))


@query
def q_critical_tickets(t: Inputs) -> DataFrame:
    since = F.date_sub(t.newest_ticket, 29)
    return plain(questions.critical_tickets(t.ticket_days, since))


@query
def q_revenue(t: Inputs) -> DataFrame:
    revenue = marts.revenue_by_month(t.billing)
    return plain(questions.monthly_revenue(revenue), REVENUE_DIGITS)


@query
def q_genai(t: Inputs) -> DataFrame:
    since = F.date_sub(t.newest_usage, 13)
    return plain(questions.genai_usage(t.genai, since))


@query
def q_worst_anomalies(t: Inputs) -> DataFrame:
    return _spelled_out(questions.worst_anomalies(t.anomalies, 2))


@query
def q_worst_anomalies_one_org(t: Inputs) -> DataFrame:
    """The organisation whose anomalies have most flagged events."""
    anomalies = t.anomalies
    org = busiest(anomalies, "org_id", "event_count").select("org_id").scalar()
    return _spelled_out(questions.worst_anomalies(anomalies, 10, org))


# -- batch landing --------------------------------------------------------------


@query
def master_scan(t: Inputs) -> DataFrame:
    """Resources as CSV with JSON text in a cell, read back with their types."""
    landing = t.scratch("landing")
    t.table("orders").select(
        F.col("o_orderkey").alias("resource_id"),
        F.col("o_custkey").alias("org_id"),
        F.col("o_orderpriority").alias("service"),
        F.lit(None).cast("string").alias("region"),
        F.col("o_orderdate").cast("date").alias("created_at"),
        F.col("o_orderstatus").alias("state"),
        F.to_json(F.struct("o_orderpriority", "o_orderstatus")).alias("tags_json"),
    ).write.options(header=True, escape='"').csv(f"{landing}/resources.csv")
    return plain(scan_master(t.spark, MASTERS["resources"], landing))


@query
def master_dedupe(t: Inputs) -> DataFrame:
    """One line per order: the last shipped, of those the dearest."""
    lines = t.table("lineitem").select(
        "l_orderkey", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        "l_extendedprice", "l_linenumber", "l_partkey",
    )
    return plain(
        one_row_per_key(lines, ["l_orderkey"], ["l_shipdate", "l_extendedprice"])
    )


def _land_orgs(orgs: DataFrame, landing: str) -> None:
    orgs.select(
        "org_id", "org_name", "industry", "hq_region", "plan_tier",
        (F.col("org_id") % 2 == 0).alias("is_enterprise"),
        F.lit("2024-01-01").alias("signup_date"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in ("sales_rep", "lifecycle_stage", "marketing_source")
        ],
        F.when(F.col("org_id") % 5 != 0, F.col("org_id") % 10).alias("nps_score"),
    ).write.options(header=True, escape='"').csv(f"{landing}/customers_orgs.csv")


@query
def latest_snapshot(t: Inputs) -> DataFrame:
    """Two snapshots of the organisations, the newer without every tenth of them and
    delivered with each row twice; only the newer is read.
    """
    orgs = t.org
    bronze = t.scratch("bronze")
    kept = orgs.where("org_id % 10 <> 0").withColumn("plan_tier", F.lower("plan_tier"))
    for day, rows in ((1, orgs), (2, kept.unionByName(kept))):
        landing = t.scratch("landing")
        _land_orgs(rows, landing)
        ingest_masters(
            t.spark, landing, bronze, dt.date(2024, 2, day), ["customers_orgs"]
        )
    snapshot = current_master(t.spark, bronze, "customers_orgs")
    return plain(snapshot.drop("ingest_ts", "source_file"))


@query
def master_audit(t: Inputs) -> DataFrame:
    """What a snapshot says about where its rows came from."""
    landing, bronze = t.scratch("landing"), t.scratch("bronze")
    _land_orgs(t.org, landing)
    ingest_masters(t.spark, landing, bronze, dt.date(2024, 2, 1), ["customers_orgs"])
    snapshot = current_master(t.spark, bronze, "customers_orgs")
    folder = landing.rsplit("/", 1)[-1]
    return plain(
        snapshot.select(
            "org_id",
            "ingest_date",
            F.col("source_file").contains(f"{folder}/customers_orgs.csv").alias("landed"),
            F.col("ingest_ts").isNotNull().alias("stamped"),
        )
    )


@query
def master_quarantine(t: Inputs) -> DataFrame:
    """Every seventh organisation is delivered without its id; all of them are kept."""
    landing, bronze = t.scratch("landing"), t.scratch("bronze")
    _land_orgs(t.org.withColumn("org_id", F.expr("if(org_id % 7 = 0, null, org_id)")), landing)
    ingest_masters(t.spark, landing, bronze, dt.date(2024, 2, 1), ["customers_orgs"])
    accepted = current_master(t.spark, bronze, "customers_orgs").withColumn(
        "dq_rule", F.lit("accepted")
    )
    shown = ["org_name", "dq_rule", "ingest_date"]
    lost = rejected_master(t.spark, bronze, "customers_orgs")
    return plain(accepted.select(*shown).unionByName(lost.select(*shown)))


@query
def master_malformed(t: Inputs) -> DataFrame:
    """Resources delivered without some ids, with unreadable days, with line breaks and
    JSON inside cells, and with lines that end early: what became of every row, and of
    every cell that could not be read.
    """
    landing, bronze = t.scratch("landing"), t.scratch("bronze")
    path, options = f"{landing}/resources.csv", {"header": True, "escape": '"'}
    key, orders = F.col("o_orderkey"), t.table("orders")
    day = F.when(key % 7 == 0, F.lit("soon")).when(key % 11 == 0, F.lit("2024-13-45"))
    note = F.concat(F.lit('{"note": "a,\n'), "o_orderstatus", F.lit('"}'))
    cells = [
        F.when(key % 13 != 0, key).alias("resource_id"), F.col("o_custkey").alias("org_id"),
        F.lit("db").alias("service"), F.lit("eu").alias("region"),
        F.coalesce(day, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("created_at"),
        F.col("o_orderstatus").alias("state"), note.alias("tags_json"),
    ]
    whole = orders.where(key % 17 != 0).select(*cells)
    whole.write.options(**options).csv(path)
    cut = orders.where(key % 17 == 0).select(key, "o_custkey", F.lit("d"))
    cut.write.mode("append").options(**options).csv(path)
    ingest_masters(t.spark, landing, bronze, dt.date(2024, 2, 1), ["resources"])
    shown = ("resource_id", "org_id", "created_at", "tags_json")
    accepted = current_master(t.spark, bronze, "resources").select(
        F.lit("accepted").alias("outcome"), *shown, F.lit(None).cast("string").alias("text")
    )
    kept = F.col("broken_line").isNull()
    lost = rejected_master(t.spark, bronze, "resources").select(
        F.col("dq_rule").alias("outcome"),
        *[F.when(kept, F.col(c)).alias(c) for c in shown], F.col("broken_line").alias("text"),
    )
    unread = unread_cells(t.spark, bronze, "resources").select(
        F.col("dq_rule").alias("outcome"), F.col("row_key").alias("resource_id"),
        *[F.lit(None).cast(kind).alias(c) for c, kind in zip(shown[1:], ("string", "date", "string"))],
        F.concat("column", F.lit("="), "text").alias("text"),
    )
    return plain(accepted.unionByName(lost).unionByName(unread))


# -- streaming ------------------------------------------------------------------


def _land_events(t: Inputs, damaged: bool = False, copies: bool = False) -> str:
    """Usage as JSON lines. `copies` delivers every fifth event once more, in other
    files; `damaged` breaks cells and lines.
    """
    events = t.usage.withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    number, tokens = F.col("event_id"), F.col("genai_tokens").cast("string")
    if damaged:
        events = events.withColumns(
            {
                "value": F.when(number % 13 == 0, F.lit("n/a"))
                .when(number % 19 == 0, F.lit("NaN"))
                .when(number % 31 == 0, F.lit("-Infinity"))
                .otherwise(F.col("value").cast("string")),
                "schema_version": F.concat("schema_version", F.lit(".0")),
                "genai_tokens": F.when(
                    number % 7 == 0, F.concat(tokens, F.lit(".0"))
                ).otherwise(tokens),
            }
        )
    line = F.to_json(F.struct(*events.columns))
    if damaged:
        line = F.when(number % 101 == 0, F.left(line, F.lit(12))).otherwise(line)
    landing = t.scratch("landing")
    lines = events.select("event_id", line.alias("value"))
    lines.select("value").write.text(f"{landing}/first")
    if copies:
        again = lines.where("event_id % 5 = 0").select("value")
        again.write.text(f"{landing}/second")
    return landing


@query
def stream_dedupe(t: Inputs) -> DataFrame:
    """Intake of lines of which a fifth arrives twice."""
    landing = _land_events(t, copies=True)
    bronze = t.scratch("bronze")
    ingest_events(
        t.spark, f"{landing}/*", bronze, t.scratch("checkpoints"), files_per_trigger=32
    )
    events = read_zone(t.spark, bronze).where("event_id is not null")
    return plain(
        events.select(
            "event_id", "org_id", "service", "event_date", "cost_usd_increment",
            "genai_tokens",
        )
    )


@query
def stream_future_event(t: Inputs) -> DataFrame:
    """One file per batch, and first of all an event dated far in the future."""
    lines = t.spark.read.text(f"{_land_events(t)}/*")
    future = (
        '{"event_id": -1, "timestamp": "2099-01-01T00:00:00.000000", "org_id": 1,'
        ' "service": "signup", "cost_usd_increment": 1.0}'
    )
    landing, bronze = t.scratch("landing"), t.scratch("bronze")
    t.spark.range(1).select(F.lit(future).alias("value")).write.text(f"{landing}/first")
    lines.repartition(3, F.xxhash64("value")).write.text(f"{landing}/second")
    ingest_events(
        t.spark, f"{landing}/*", bronze, t.scratch("checkpoints"), files_per_trigger=1
    )
    events = read_zone(t.spark, bronze).where("event_id is not null")
    return plain(
        events.select(
            "event_id", "org_id", "service", "event_date", "cost_usd_increment",
            "genai_tokens",
        )
    )


@query
def malformed_rescue(t: Inputs) -> DataFrame:
    """Outcome of lines with quoted numbers, whole numbers with a point, cells that are
    unreadable or not finite, and cut-off lines.
    """
    lines = scan_lines(t.spark, f"{_land_events(t, damaged=True)}/*")
    tagged = quality.tag_quality(conform(typed_events(lines)))
    return plain(
        tagged.groupBy(F.coalesce("dq_rule", F.lit("accepted")).alias("outcome")).agg(
            F.count("*").alias("rows"),
            F.count("broken_line").alias("broken_lines"),
            F.sum("value").alias("value"),
            F.sum("genai_tokens").alias("genai_tokens"),
            F.sum("schema_version").cast("bigint").alias("schema_versions"),
        )
    )


def _bronze_zone(events: DataFrame) -> str:
    path = scratch_path(events.sparkSession, "bronze")
    _append_bronze(events, path)
    return path


def _append_bronze(events: DataFrame, path: str) -> None:
    timed = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    timed.write.mode("append").parquet(path)


@query
def stream_quality_split(t: Inputs) -> DataFrame:
    bronze = _bronze_zone(t.usage)
    silver, bad = t.scratch("silver"), t.scratch("quarantine")
    finish(
        *start_silver(
            t.spark, bronze, t.org, silver, bad, t.scratch("checkpoints")
        )
    )
    clean = read_zone(t.spark, silver).withColumn("dq_rule", F.lit("accepted"))
    shown = ("event_date", "dq_rule", "cost_usd")
    both = clean.select(*shown).unionByName(read_zone(t.spark, bad).select(*shown))
    return plain(
        both.groupBy("event_date", F.col("dq_rule").alias("outcome")).agg(
            F.count("*").alias("rows"), F.sum("cost_usd").alias("cost_usd")
        )
    )


@query
def stream_scored(t: Inputs) -> DataFrame:
    """Events scored on arrival against the stored profile."""
    bronze = _bronze_zone(t.usage)
    stored = t.scratch("profile")
    write_snapshot(t.profile, stored)
    silver, bad = t.scratch("silver"), t.scratch("quarantine")
    finish(
        *start_silver(
            t.spark, bronze, t.org, silver, bad,
            t.scratch("checkpoints"), read_zone(t.spark, stored),
        )
    )
    flags = [f"flag_{m}" for m in DETECTORS]
    return plain(
        read_zone(t.spark, silver).select("event_id", *flags, "cost_anomaly_flag")
    )


def _append_days(events: DataFrame, path: str) -> None:
    timed = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    dated = timed.withColumn("event_date", F.to_date("timestamp"))
    dated.write.mode("append").partitionBy("event_date").parquet(path)


def _rank_is(value: str, of: str, share: float, error: float) -> Column:
    """Whether `value` has the rank `share` among the values of a group, up to `error`."""
    n = F.count(of)
    below, upto = F.count_if(F.col(of) < F.col(value)), F.count_if(F.col(of) <= F.col(value))
    return (below <= (share + error) * n) & (upto >= (share - error) * n)


@query
def profile_by_state(t: Inputs) -> DataFrame:
    """The profile merged from states of days. Version 1 days are profiled, then the zone
    gets the rest and days that are already profiled get more files; the second refresh
    reads those days alone. Quantiles are checked by their ranks among all costs.
    """
    zone, state = t.scratch("bronze"), t.scratch("states")

    def states() -> DataFrame:
        return refreshed_states(
            t.spark, zone, state, lambda rows: quality.accepted(quality.tag_quality(conform(rows)))
        )

    early = (F.col("schema_version") == 1) & (F.coalesce("event_id", F.lit(0)) % 10 != 0)
    _append_days(t.usage.where(early), zone)
    states()
    _append_days(t.usage.where(~early), zone)
    profile = merged_profile(states()).withColumnRenamed("n_values", "n")
    rows = t.clean.select("service", "cost_usd").join(F.broadcast(profile), "service")
    rows = rows.withColumn("apart", F.abs(F.col("cost_usd") - F.col("p50")))
    ranks = [
        _rank_is(name, "cost_usd", p, RANK_ERROR).alias(f"{name}_within") for name, p in BAND.items()
    ]
    ranks.append(_rank_is("mad", "apart", 0.5, DEVIATION_RANK_ERROR).alias("mad_within"))
    keys = ("service", "n", "mean_cost", "std_cost", *BAND, "mad")
    checked = rows.groupBy(*keys).agg(*ranks)
    within = [f"{name}_within" for name in (*BAND, "mad")]
    return plain(
        checked.select("service", F.col("n").alias("n_values"), "mean_cost", "std_cost", *within)
    )


@query
def stream_daily_window(t: Inputs) -> DataFrame:
    """Totals per day and service. Files hold events of all days and come one by one, so
    most of them are late for the stream; the windows it lacks are completed.
    """
    zone = _bronze_zone(t.clean.repartition(4, F.xxhash64("event_id", "timestamp")))
    out = t.scratch("windows")
    stream = windowed_usage(stream_zone(t.spark, zone, files_per_trigger=1))
    finish(append_to(stream, out, t.scratch("checkpoints")))
    emitted = read_zone(t.spark, out, stream.schema)
    ledger = update_ledger(t.spark, zone, t.scratch("ledger"))
    return _shown_windows(complete_windows(emitted, ledger))


def _shown_windows(windows: DataFrame) -> DataFrame:
    return plain(
        windows.select(
            F.to_date("window_start").alias("event_date"), "service", "cost_usd",
            "genai_tokens", "event_count",
        )
    )


@query
def stream_late_windows(t: Inputs) -> DataFrame:
    """Totals per day and service over two rounds of the stream. The second brings events
    of all days, late for windows that were emitted; only its files are opened to count
    them. `opened_twice` says whether any file was counted in both rounds.
    """
    zone, out, checkpoints = t.scratch("silver"), t.scratch("windows"), t.scratch("checkpoints")
    ledger = t.scratch("ledger")
    late = F.coalesce("event_id", F.lit(0)) % 6 == 0
    for rows in (t.clean.where(~late), t.clean.where(late)):
        _append_bronze(rows, zone)
        stream = windowed_usage(stream_zone(t.spark, zone))
        finish(append_to(stream, out, checkpoints))
        sums = update_ledger(t.spark, zone, ledger)
    emitted = read_zone(t.spark, out, stream.schema)
    counted = read_zone(t.spark, ledger, LEDGER).where("window_start is null")
    opened_twice = counted.agg(F.count("*") > F.count_distinct("file")).scalar()
    return _shown_windows(complete_windows(emitted, sums)).withColumn("opened_twice", opened_twice)


@query
def stream_mart_refresh(t: Inputs) -> DataFrame:
    """Daily mart kept up by two runs of the stream: version 1 events, then the rest."""
    bronze, silver = t.scratch("bronze"), t.scratch("silver")
    bad, checkpoints = t.scratch("bad"), t.scratch("checkpoints")
    store = t.store()
    for version in (1, 2):
        _append_bronze(t.usage.where(F.col("schema_version") == version), bronze)
        since = after_newest_file(t.spark, silver)
        finish(
            *start_silver(t.spark, bronze, t.org, silver, bad, checkpoints, t.profile)
        )
        refresh_mart(
            store, "org_daily_usage_by_service", read_zone(t.spark, silver),
            marts.daily_usage_of_stored, since,
        )
    return plain(store.table("org_daily_usage_by_service"))


@query
def supervised_run(t: Inputs) -> DataFrame:
    """Silver by a supervised stream that breaks once, at one of its files, and is started
    again from its checkpoint: events by day, each once, the failures on record, and
    whether the record's batches have all rows.
    """
    zone, out, checkpoints = t.scratch("silver"), t.scratch("out"), t.scratch("checkpoints")
    t.clean.repartition(4, F.xxhash64("event_id", "timestamp")).write.parquet(zone)
    file = F.col("_metadata.file_path")
    last = read_zone(t.spark, zone).select(F.max(file)).first()[0]
    started: list[StreamingQuery] = []

    def start() -> StreamingQuery:
        rows = stream_zone(t.spark, zone, files_per_trigger=1)
        if not started:
            broken = F.when(file == last, F.raise_error(F.lit("injected")))
            rows = rows.withColumn("service", broken.otherwise(F.col("service")))
        started.append(append_to(rows, out, checkpoints, "event_date"))
        return started[-1]

    record = supervise(start, first_wait=0.1, poll=0.5).table(t.spark)
    failures = record.select(F.count("failure")).scalar()
    noted = record.select(F.sum("input_rows")).scalar()
    days = read_zone(t.spark, out).groupBy("event_date").agg(
        F.count("*").alias("rows"), F.sum("cost_usd").alias("cost_usd")
    )
    total = days.select(F.sum("rows")).scalar()
    return plain(days.select("*", failures.alias("failures"), (noted == total).alias("all_noted")))


# -- serving --------------------------------------------------------------------


@query
def upsert_merge(t: Inputs) -> DataFrame:
    """A mart without request events, then the version 2 days in full, loaded twice."""
    store = t.store()
    name = "org_daily_usage_by_service"
    store.load(name, marts.daily_usage(t.unscored.where("metric <> 'requests'")))
    later = marts.daily_usage(t.unscored.where("schema_version = 2"))
    store.load(name, later)
    store.load(name, later)
    return plain(
        store.table(name).select(
            "org_id", "event_date", "service", "cost_usd", "requests", "event_count"
        )
    )


@query
def upsert_retry(t: Inputs) -> DataFrame:
    """The same load, interrupted while its partitions were swapped: a bucket is gone,
    the merged rows are complete. The next load puts it right.
    """
    store = t.store()
    name = "org_daily_usage_by_service"
    path, staging = store.path(name), store.staging(name)
    before = marts.daily_usage(t.unscored.where("metric <> 'requests'"))
    later = marts.daily_usage(t.unscored.where("schema_version = 2"))
    store.load(name, before)
    whole = store.laid_out(name, before)
    torn = t.scratch("torn")
    whole.where(F.col(BUCKET) != 0).write.parquet(torn)
    merged(whole, store.laid_out(name, later), TABLES[name].keys).write.parquet(
        f"{staging}/interrupted/merged"
    )
    note(t.spark, staging, "interrupted", READY)
    write_snapshot(read_zone(t.spark, torn), path, TABLES[name].partitions)
    write_mark(t.spark, path, WRITTEN, "1")
    store.load(name, later)
    return plain(
        store.table(name).select(
            "org_id", "event_date", "service", "cost_usd", "requests", "event_count"
        )
    )


def _asked_twice(every: DataFrame, one: DataFrame) -> DataFrame:
    """Answers for all organisations and for one, side by side."""
    return every.withColumn("asked", F.lit("all")).unionByName(
        one.withColumn("asked", F.lit("one"))
    )


@query
def serving_daily_range(t: Inputs) -> DataFrame:
    store = t.store()
    store.load("org_daily_usage_by_service", marts.daily_usage(t.unscored))
    start = F.trunc(t.newest_usage, "month")
    first = t.clean.select(F.min("event_date")).scalar()
    return plain(
        _asked_twice(
            store.daily_range(None, start, F.date_add(start, 14)),
            store.daily_range(t.busiest_by_events, first, t.newest_usage),
        )
    )


@query
def serving_top_services(t: Inputs) -> DataFrame:
    store = t.store()
    store.load("org_service_cost_14d", t.cost_14d)
    one = store.top_services(t.busiest_by_events, 3)
    return plain(_asked_twice(store.top_services(None, 3), one))


@query
def serving_tickets(t: Inputs) -> DataFrame:
    store = t.store()
    store.load("tickets_by_org_date", t.ticket_days)
    since = F.date_sub(t.newest_ticket, 29)
    org = questions.busiest_org(t.ticket_days, as_of=t.newest_ticket)
    one = store.tickets(org.select("org_id").scalar(), since)
    return plain(_asked_twice(store.tickets(None, since), one))


@query
def serving_revenue(t: Inputs) -> DataFrame:
    store = t.store()
    store.load("revenue_by_org_month", marts.revenue_by_month(t.billing))
    answers = _asked_twice(store.revenue(None), store.revenue(t.busiest_by_events))
    return plain(answers, REVENUE_DIGITS)


@query
def serving_genai(t: Inputs) -> DataFrame:
    store = t.store()
    daily = marts.genai_from_daily(t.daily_cost, fixtures.GENAI_SERVICE)
    store.load("genai_tokens_by_org_date", daily)
    since = F.date_sub(t.newest_usage, 13)
    one = store.genai(t.busiest_by_events, since)
    return plain(_asked_twice(store.genai(None, since), one))


def _in_order(df: DataFrame, table: str, *shown: str) -> DataFrame:
    """Rows of a sorted answer with the place they come in."""
    place = F.monotonically_increasing_id() + 1
    text = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in shown])
    return df.coalesce(1).select(F.lit(table).alias("table"), place.alias("place"), text.alias("row"))


@query
def serving_newest_first(t: Inputs) -> DataFrame:
    """Answers about one organisation in the order they are given."""
    store, since = t.store(), F.date_sub(t.newest_ticket, 400)
    store.load("tickets_by_org_date", t.ticket_days)
    store.load("revenue_by_org_month", marts.revenue_by_month(t.billing))
    store.load("genai_tokens_by_org_date", t.genai)
    org = questions.busiest_org(t.ticket_days, as_of=t.newest_ticket).first()[0]
    user = t.genai.agg(F.min("org_id")).first()[0]
    first = t.clean.select(F.min("event_date")).scalar()
    tickets = _in_order(store.tickets(org, since), "tickets", "event_date", "severity")
    revenue = _in_order(store.revenue(org), "revenue", "month")
    genai = _in_order(store.genai(user, first), "genai", "event_date")
    return tickets.unionByName(revenue).unionByName(genai)


@query
def serving_anomalies(t: Inputs) -> DataFrame:
    store = t.store()
    store.load("cost_anomaly_by_org_date", t.anomalies)
    org = busiest(t.anomalies, "org_id", "event_count").select("org_id").scalar()
    return _spelled_out(
        _asked_twice(store.worst_anomalies(None, 2), store.worst_anomalies(org, 10))
    )


@query
def reload_snapshot(t: Inputs) -> DataFrame:
    """Trailing cost as of a week ago, replaced by that of the newest day."""
    store = t.store()
    name = "org_service_cost_14d"
    for as_of in (F.date_sub(t.newest_usage, 7), t.newest_usage):
        store.load(name, marts.trailing_cost(t.daily_cost, as_of))
    return plain(store.table(name))


@query
def reload_interrupted(t: Inputs) -> DataFrame:
    """Trailing cost as of a week ago; what a reload that is lost midway leaves behind, a
    part of the new rows without a mark; and the reload that follows. Answers in between
    are the old ones.
    """
    store = t.store()
    name = "org_service_cost_14d"
    store.load(name, marts.trailing_cost(t.daily_cost, F.date_sub(t.newest_usage, 7)))
    newest = store.laid_out(name, t.cost_14d)
    _, unfinished, _ = slot_paths(t.spark, store.base(name))
    write_snapshot(newest.where(F.col(BUCKET) < 3), unfinished, TABLES[name].partitions)
    between = t.scratch("between")
    store.table(name).write.parquet(between)
    store.load(name, t.cost_14d)
    answers = {"interrupted": read_zone(t.spark, between), "reloaded": store.table(name)}
    both = [df.withColumn("seen", F.lit(seen)) for seen, df in answers.items()]
    return plain(both[0].unionByName(both[1]))


def _stream_rounds(t: Inputs, *tables: str) -> ServingStore:
    """Live tables after three rounds of the stream: version 1 without every fourth event,
    those that were left out, and the days of version 2.
    """
    bronze, silver = t.scratch("bronze"), t.scratch("silver")
    bad, checkpoints = t.scratch("bad"), t.scratch("checkpoints")
    live = LiveMarts(t.store(), t.scratch("live"), tables, fixtures.GENAI_SERVICE)
    early = F.col("schema_version") == 1
    left_out = F.coalesce("event_id", F.lit(1)) % 4 == 0
    for rows in (early & ~left_out, early & left_out, ~early):
        _append_bronze(t.usage.where(rows), bronze)
        since = after_newest_file(t.spark, silver)
        finish(*start_silver(t.spark, bronze, t.org, silver, bad, checkpoints, t.profile))
        live.refresh(read_zone(t.spark, silver), since)
    return live.store


@query
def stream_cost_14d(t: Inputs) -> DataFrame:
    """Trailing cost, moved from round to round by what entered and left its window."""
    return plain(_stream_rounds(t, "org_service_cost_14d").table("org_service_cost_14d"))


@query
def stream_genai(t: Inputs) -> DataFrame:
    return plain(_stream_rounds(t, "genai_tokens_by_org_date").table("genai_tokens_by_org_date"))


@query
def stream_anomalies(t: Inputs) -> DataFrame:
    name = "cost_anomaly_by_org_date"
    return _spelled_out(_stream_rounds(t, name).table(name))


@query
def serving_counts(t: Inputs) -> DataFrame:
    """Rows of the serving tables after loading the marts into them."""
    store = t.store()
    loads = {
        "org_daily_usage_by_service": marts.daily_usage(t.silver),
        "org_service_cost_14d": t.cost_14d,
        "tickets_by_org_date": t.ticket_days,
        "revenue_by_org_month": marts.revenue_by_month(t.billing),
        "genai_tokens_by_org_date": t.genai,
        "cost_anomaly_by_org_date": t.anomalies,
    }
    for name, mart in loads.items():
        store.load(name, mart)
    return reports.zone_manifest({name: store.table(name) for name in loads})


# -- reports --------------------------------------------------------------------


def _zones(t: Inputs) -> dict[str, DataFrame]:
    clean, bad = quality.split_quality(t.conformed)
    return {
        "bronze": t.usage,
        "silver": clean,
        "quarantine": bad,
        "daily": t.daily_cost,
        "cost_14d": t.cost_14d,
        "tickets": t.ticket_days,
        "revenue": marts.revenue_by_month(t.billing),
        "genai": t.genai,
    }


@query
def zone_manifest(t: Inputs) -> DataFrame:
    return reports.zone_manifest(_zones(t))


@query
def written_counts(t: Inputs) -> DataFrame:
    """The zones' rows as counted while they were written, beside a count of what is
    there, and whether both sides of the quality split make up the whole.
    """
    base, paths = t.scratch("zones"), {}
    zones = {n: df for n, df in _zones(t).items() if n in ("bronze", "silver", "quarantine", "daily")}
    for name, df in zones.items():
        paths[name] = f"{base}/{name}"
        write_snapshot(df, paths[name], "event_date" if "event_date" in df.columns else None)
    told = reports.written_manifest(t.spark, paths)
    counted = reports.zone_manifest({n: read_zone(t.spark, p) for n, p in paths.items()})
    both = told.join(counted.withColumnRenamed("rows", "counted"), "zone")

    def of(name: str) -> Column:
        return told.where(F.col("zone") == name).select("rows").scalar()

    return both.withColumn("conserved", of("silver") + of("quarantine") == of("bronze"))


@query
def rerun_stability(t: Inputs) -> DataFrame:
    """Silver, quarantine and the daily mart written twice to the same place."""
    clean, bad = quality.split_quality(t.conformed)
    zones = {"silver": clean, "quarantine": bad, "daily": t.daily_cost}
    base = t.scratch("zones")
    manifests = []
    for run in (1, 2):
        for name, df in zones.items():
            write_snapshot(df, f"{base}/{name}", "event_date")
        counts = reports.zone_manifest(
            {name: read_zone(t.spark, f"{base}/{name}") for name in zones}
        )
        kept = t.scratch("manifest")
        counts.write.parquet(kept)
        manifests.append(read_zone(t.spark, kept))
    return reports.rerun_check(*manifests)


@query
def compaction(t: Inputs) -> DataFrame:
    """The silver zone with a dozen files for every day, brought together: its rows by
    day, whether every day has one file, and whether a second run finds nothing to do.
    """
    path, staging = t.scratch("silver"), t.scratch("staging")
    many = t.clean.repartition(12, F.xxhash64("event_id", "timestamp"))
    many.write.partitionBy("event_date").parquet(path)
    compact(t.spark, path, staging)
    again = compact(t.spark, path, staging).count()
    rows = read_zone(t.spark, path).groupBy("event_date").agg(
        F.count("*").alias("rows"), F.sum("cost_usd").alias("cost_usd"),
        F.count_distinct(F.col("_metadata.file_path")).alias("files"),
    )
    return plain(
        rows.select(
            "event_date", "rows", "cost_usd", (F.col("files") == 1).alias("one_file"),
            F.lit(again == 0).alias("settled"),
        )
    )


@query
def partition_report(t: Inputs) -> DataFrame:
    """Days of the silver zone with their rows, and whether they are stored."""
    path = t.scratch("silver")
    write_snapshot(t.clean, path, "event_date")
    rows = read_zone(t.spark, path).groupBy("event_date").agg(F.count("*").alias("rows"))
    sizes = reports.partition_report(t.spark, path, "event_date")
    return plain(
        sizes.join(rows, "event_date", "left").select(
            "event_date", "rows", F.expr("files > 0 and bytes > 0").alias("stored")
        )
    )


@query
def zone_size(t: Inputs) -> DataFrame:
    """Partitions of the silver zone, and whether its files and bytes, which depend on
    the writer, are those of its partitions together.
    """
    path = t.scratch("silver")
    write_snapshot(t.clean, path, "event_date")
    report = reports.partition_report(t.spark, path, "event_date")
    added = report.select(F.sum("bytes")).scalar() == F.col("bytes")
    some = F.col("files") >= F.col("partitions")
    return reports.zone_size(report).select("partitions", (added & some).alias("adds_up"))
