"""Bronze to silver as a stream: quality split, enrichment, scoring against a
stored profile. Nothing here keeps state, so it scales with the input alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.operators.conform import conform, enrich
from meterlake.operators.outliers import score_against
from meterlake.operators.quality import accepted, rejected, tag_quality
from meterlake.sources.zones import balanced
from meterlake.streaming.runs import append_to

# Heavy keys of a large lookup are looked for in so many days.
HISTORY_DAYS = 7


def stream_zone(
    spark: SparkSession, path: str, files_per_trigger: int | None = 64
) -> DataFrame:
    """A Parquet zone as a stream of the rows added to it, all waiting files at once if
    `files_per_trigger` is None. Its schema comes from the files already there.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def newest_rows(zone: DataFrame, days: int = HISTORY_DAYS, day: str = "event_date") -> DataFrame:
    """Rows of a zone's last days, found by its partitions; all of a zone without days."""
    if day not in zone.columns:
        return zone
    newest = zone.select(F.max(day)).scalar()
    return zone.where(F.col(day) > F.date_sub(newest, days))


def split_and_score(
    bronze: DataFrame,
    orgs: DataFrame,
    profile: DataFrame | None = None,
    history: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(silver, quarantine) streams. With a profile, silver rows are scored and flagged
    as in the batch job; statistics move slowly, so the last stored ones will do.
    `history` is a bounded view of the same rows, to find heavy keys in.
    """
    tagged = tag_quality(conform(bronze))
    silver = enrich(accepted(tagged), orgs, history=history)
    if profile is not None:
        silver = score_against(silver, profile, history=history)
    return silver, rejected(tagged)


def start_silver(
    spark: SparkSession,
    bronze: str,
    orgs: DataFrame,
    silver: str,
    quarantine: str,
    checkpoints: str,
    profile: DataFrame | None = None,
    every: str | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both sides of the split. Each has its own checkpoint, so either can be
    rerun alone; both add nothing for input they have seen. The rows of a day are brought
    together before they are written: as read or joined, every task holds rows of every
    day, and would write a file for each.
    """
    clean, bad = split_and_score(
        stream_zone(spark, bronze), orgs, profile, newest_rows(spark.read.parquet(bronze))
    )
    base = checkpoints.rstrip("/")
    return (
        append_to(balanced(clean, "event_date"), silver, f"{base}/silver", "event_date", every),
        append_to(balanced(bad, "event_date"), quarantine, f"{base}/quarantine", "event_date", every),
    )
