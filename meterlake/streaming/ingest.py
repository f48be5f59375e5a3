"""Event intake: JSON lines to bronze, each event id once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.sources.events import (
    SOURCE_LANE,
    stream_lines,
    typed_events,
    with_source_lane,
)
from meterlake.streaming.runs import append_to, finish

# How long after an event's arrival its copies are still recognised.
WATERMARK = "60 days"
ARRIVAL = "arrived_at"
COPY_LANES = 256
FILES_PER_TRIGGER = 4


def once_per_event(
    events: DataFrame, watermark: str = WATERMARK, lane: str | None = SOURCE_LANE
) -> DataFrame:
    """Drop repeated event ids that arrive within the watermark.

    The watermark follows the time of arrival, not the time that events claim: files
    come in any order, and a single event dated in the future would make everything
    after it late and lost. So no event is ever late, whatever its timestamp.

    Rows are first deduplicated per id *and* lane, then per id: an id delivered a
    million times is spread over the lanes, and at most one copy per lane and batch
    meets in one task. Rows without an id cannot be told apart and all stay; the
    quality rules reject them later, with a reason. They take a branch of their own,
    without state, which reads the new files a second time.
    """
    timed = events.withColumn(ARRIVAL, F.current_timestamp()).withWatermark(
        ARRIVAL, watermark
    )
    keyed = timed.where("event_id is not null")
    if lane is not None:
        keyed = keyed.dropDuplicatesWithinWatermark(["event_id", lane])
    keyed = keyed.dropDuplicatesWithinWatermark(["event_id"])
    both = keyed.unionByName(timed.where("event_id is null"))
    return both.drop(ARRIVAL, *([lane] if lane is not None else []))


def bronze_events(
    spark: SparkSession,
    landing: str,
    watermark: str = WATERMARK,
    files_per_trigger: int = FILES_PER_TRIGGER,
    copy_lanes: int = COPY_LANES,
    bytes_per_trigger: str | None = None,
) -> DataFrame:
    """The stream of typed, deduplicated events with their day."""
    lines = stream_lines(spark, landing, files_per_trigger, bytes_per_trigger)
    lines = with_source_lane(lines, copy_lanes)
    return once_per_event(typed_events(lines), watermark).withColumn(
        "event_date", F.to_date("timestamp")
    )


def gathered_by_day(events: DataFrame, files_per_day: int) -> DataFrame:
    """Bring the rows of a day to a few tasks before they are written. After the
    deduplication every task holds rows of every day, and would write a file for each.
    """
    lane = F.pmod(F.xxhash64("event_id", F.spark_partition_id()), F.lit(files_per_day))
    return (
        events.withColumn("_lane", lane).repartition("event_date", "_lane").drop("_lane")
    )


def start_intake(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoints: str,
    every: str | None = None,
    files_per_trigger: int = FILES_PER_TRIGGER,
    **options,
) -> StreamingQuery:
    """Start the intake; `options` are those of `bronze_events`. A batch writes at most
    as many files per day as it reads in all.
    """
    events = bronze_events(
        spark, landing, files_per_trigger=files_per_trigger, **options
    )
    return append_to(
        gathered_by_day(events, files_per_trigger),
        bronze,
        f"{checkpoints.rstrip('/')}/usage_intake",
        "event_date",
        every,
    )


def ingest_events(
    spark: SparkSession, landing: str, bronze: str, checkpoints: str, **options
) -> None:
    """Take in every file not seen before, then stop."""
    finish(start_intake(spark, landing, bronze, checkpoints, **options))
