"""Keeping up what is derived from a zone by day, reading only the days that changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.operators.profiles import STATE, day_states
from meterlake.session import cut_lineage
from meterlake.sources.zones import (
    among,
    null_safe,
    partition_listing,
    read_zone,
    table_exists,
    write_partitions,
)

DAY = "event_date"
# What tells one content of a day's folder from another: files of a zone are never changed.
SEEN = ("files", "bytes", "newest")
_LAYOUT = f"{STATE}, files bigint, bytes bigint, newest timestamp"


def refreshed_states(
    spark: SparkSession,
    zone: str,
    state: str,
    clean: Callable[[DataFrame], DataFrame],
    schema: StructType | None = None,
) -> DataFrame:
    """The profile states of all days of `zone`, brought up to date in the table `state`.

    A day's states carry the number, size and newest time of the files they were made
    from, as listed before those were read. Days whose listing differs, and no others, are
    read, passed through `clean` and replaced; the others' states stay as they are. So a
    refresh that is repeated reads nothing, one that was interrupted goes on, and files
    that arrive meanwhile are seen by the next. Days that are gone from the zone, or
    changed since, are left out of the result. What is collected and broadcast is a row
    for each day. A day without a clean row has no state and is looked at every time.
    """
    columns = [DAY, *SEEN]
    listing = cut_lineage(partition_listing(spark, zone, DAY))
    fresh = listing
    if table_exists(spark, state):
        known = read_zone(spark, state, _LAYOUT).select(columns).distinct()
        same = null_safe("l", "k", columns)
        fresh = cut_lineage(listing.alias("l").join(known.alias("k"), same, "left_anti"))
    days = [r[DAY] for r in fresh.select(DAY).collect()]
    if days:
        rows = clean(read_zone(spark, zone, schema).where(among(DAY, days)))
        marked = day_states(rows, DAY).alias("s").join(
            F.broadcast(fresh.alias("l")), null_safe("s", "l", [DAY])
        )
        made = marked.select("s.*", *[f"l.{c}" for c in SEEN])
        write_partitions(made, state, DAY)
    states = read_zone(spark, state, _LAYOUT) if table_exists(spark, state) else None
    if states is None:
        return spark.createDataFrame([], _LAYOUT)
    current = F.broadcast(listing.alias("l"))
    return states.alias("s").join(current, null_safe("s", "l", columns), "left_semi")
