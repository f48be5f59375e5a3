"""Silver to gold by stream: windowed totals, and refreshing marts for changed days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.plans.serving import TABLES, ServingStore
from meterlake.session import cut_lineage
from meterlake.sources.zones import null_safe, read_zone, table_exists


def windowed_usage(
    silver: DataFrame, window: str = "1 day", lateness: str = "1 hour"
) -> DataFrame:
    """Cost, tokens and events per service and time window, as an append stream.

    A window is emitted once the watermark has passed its end. The newest stays open
    until later events arrive, and events later than `lateness` come too late for the
    stream: `complete_windows` has both. Partial sums are built before the shuffle.
    """
    return _by_window(silver.withWatermark("timestamp", lateness), window)


# Sums of one file's events in one window, and when the file was written.
LEDGER = (
    "window_start timestamp, window_end timestamp, service string, cost_usd double,"
    " genai_tokens bigint, event_count bigint, file string, written timestamp"
)


def unseen_files(spark: SparkSession, silver: str, ledger: str) -> DataFrame:
    """Files of a zone, from their listing, that the ledger has no sums of."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(silver)
        .select(F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("at"))
    )
    if not table_exists(spark, ledger):
        return files
    seen = read_zone(spark, ledger, LEDGER).select("file").distinct()
    return files.join(seen, "file", "left_anti")


def rows_of_files(silver: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the files listed in `files`, a stored table, and what file they are from.

    The oldest of them is a scan filter on the time of writing, so the scan opens no file
    that is older; a join leaves out those that were written meanwhile but are not listed.
    """
    oldest = files.agg(F.min("at")).first()[0]
    rows = silver.withColumns(
        {"file": F.col("_metadata.file_path"), "written": F.col("_metadata.file_modification_time")}
    )
    return rows.where(F.col("written") >= F.lit(oldest)).join(files.select("file"), "file", "left_semi")


def update_ledger(
    spark: SparkSession,
    silver: str,
    ledger: str,
    window: str = "1 day",
    schema: StructType | None = None,
) -> DataFrame:
    """Sums per window, service and file of a zone, brought up to date; those of the files
    that the zone has now are returned.

    Only files without sums are opened. Files of a zone never change, so a repeated call
    counts nothing twice, and a file that is replaced by another, as by compaction, takes
    its sums with it. A service's file has a row for each window its events fall into. A
    ledger is of one window length: another needs another folder. One update at a time may
    write a ledger.
    """
    files = cut_lineage(unseen_files(spark, silver, ledger))
    if not files.isEmpty():
        rows = rows_of_files(read_zone(spark, silver, schema), files)
        sums = _by_window(rows, window, ["file", "written"])
        # a file without rows is noted as well, with no window
        noted = files.select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in sums.schema if f.name not in ("file", "written")],
            "file", F.col("at").alias("written"),
        )
        both = sums.unionByName(noted.select(*sums.columns))
        both.hint("rebalance").write.mode("append").parquet(ledger)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(silver)
    current = listed.select(F.col("_metadata.file_path").alias("file"))
    kept = read_zone(spark, ledger, LEDGER).where("window_start is not null")
    return kept.join(current, "file", "left_semi")


def complete_windows(emitted: DataFrame, ledger: DataFrame) -> DataFrame:
    """All windows: those the stream has emitted whole, and the others from the ledger.

    The ledger, see `update_ledger`, has the sums of all events, late ones too. Where it
    counts more events than the stream has emitted for a window, or the stream has none,
    its sums are taken. No event is read here.
    """
    keys = ["window_start", "service"]
    summed = ledger.groupBy("window_start", "window_end", "service").agg(
        *[F.sum(c).alias(c) for c in ("cost_usd", "genai_tokens", "event_count")]
    )
    same = null_safe("s", "e", keys) & F.expr("e.event_count = s.event_count")
    both = summed.alias("s").join(emitted.alias("e"), same, "left")
    return both.select(
        *[f"s.{c}" for c in ("window_start", "window_end", "service")],
        *[F.coalesce(f"e.{c}", f"s.{c}").alias(c) for c in ("cost_usd", "genai_tokens")],
        "s.event_count",
    )


def _by_window(rows: DataFrame, window: str, also: list[str] | None = None) -> DataFrame:
    return (
        rows.groupBy(F.window("timestamp", window), "service", *(also or []))
        .agg(
            F.sum("cost_usd").alias("cost_usd"),
            F.sum("genai_tokens").alias("genai_tokens"),
            F.count("*").alias("event_count"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "service",
            "cost_usd",
            "genai_tokens",
            "event_count",
            *(also or []),
        )
    )


def changed_days(
    silver: DataFrame, since: dt.datetime | None, column: str = "event_date"
) -> list[dt.date | None]:
    """Days with files written at or after `since`: one value per changed partition,
    None for events without a time.
    """
    rows = silver
    if since is not None:
        rows = rows.where(F.col("_metadata.file_modification_time") >= F.lit(since))
    return [r[0] for r in rows.select(column).distinct().collect()]


def after_newest_file(spark: SparkSession, zone: str) -> dt.datetime | None:
    """The first time, in milliseconds, after the newest file of a zone was written, from
    the listing; None if there is none.

    Asked before a round adds to the zone, and with no other writer, this is the `since`
    of that round: its files are newer, as a stream takes longer to start than files'
    times are apart, and days that only earlier rounds wrote are left out. All times are
    those of files, so no other clock needs slack.
    """
    if not table_exists(spark, zone):
        return None
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(zone)
    newest = files.agg(F.max("modificationTime")).first()[0]
    return None if newest is None else newest + dt.timedelta(milliseconds=1)


def refresh_mart(
    store: ServingStore,
    name: str,
    silver: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    since: dt.datetime | None = None,
) -> list[dt.date | None]:
    """Rebuild a day-grained mart for the days that changed, and merge it by key. Keys of
    those days that the mart no longer has go.

    Whole days are recomputed from silver instead of adding increments, so repeating
    a refresh, or overlapping two, cannot count an event twice: choose `since` with
    some slack for clocks that differ.
    """
    if TABLES[name].measured_key:
        raise ValueError(f"{name} has a measure in its key and is reloaded as a whole")
    days = changed_days(silver, since)
    if days:
        in_days = F.col("event_date").isin([d for d in days if d is not None])
        if None in days:
            in_days = in_days | F.col("event_date").isNull()
        store.load(name, build(silver.where(in_days)), replaces=in_days)
    return days
