"""Left lookup joins that stay balanced at any size of either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
)

from meterlake.session import cut_lineage, stored

BROADCAST_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = (BooleanType, DateType, DoubleType, IntegerType, LongType)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as a join would hold them, from one aggregate over `df`."""
    per_row: Column = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, _FIXED_WIDTH):
            per_row = per_row + F.lit(8)
        else:
            text = F.col(field.name).cast("string")
            per_row = per_row + F.lit(8) + F.coalesce(F.octet_length(text), F.lit(0))
    return df.select(F.sum(per_row.cast("long"))).first()[0] or 0


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: str | list[str],
    max_bytes: int = BROADCAST_BYTES,
    history: DataFrame | None = None,
) -> DataFrame:
    """LEFT equi-join of `facts` to `lookup`, which has one row per key.

    A lookup measured to be small is broadcast and `facts` is not shuffled. A larger
    one is joined by shuffle, with heavy keys spread: see `spread_join`. Which keys
    are heavy is counted on `facts`, or on `history` if `facts` is a stream.
    """
    keys = [keys] if isinstance(keys, str) else keys
    if measured_bytes(lookup) <= max_bytes:
        return facts.join(F.broadcast(lookup), keys, "left")
    return spread_join(facts, lookup, keys, history)


def heavy_keys(facts: DataFrame, keys: list[str], share: int) -> DataFrame:
    """Keys holding more than one `share`-th of all rows, with how many lanes each
    needs to be no heavier than that. There are fewer than `share` such keys, and
    their lanes add up to at most twice `share`, whatever the data.
    """
    counts = stored(
        facts.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_n")), "keys"
    )
    fair = max((counts.agg(F.sum("_n")).first()[0] or 0) / share, 1.0)
    return cut_lineage(
        counts.where(F.col("_n") > fair).select(
            *keys, F.ceil(F.col("_n") / F.lit(fair)).cast("int").alias("_lanes")
        )
    )


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    history: DataFrame | None = None,
) -> DataFrame:
    """LEFT shuffle join on (keys, lane).

    Rows of heavy keys are dealt over lanes, and only the lookup rows of those keys
    are repeated, once per lane. Rows without a key match nothing but would all hash
    to one partition, so they get lanes too. The lane is a hash of the row and of the
    partition it is read in: the same on a retry, different for copies elsewhere.
    """
    width = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if history is None:
        if facts.isStreaming:
            raise ValueError("a stream needs `history` to join a large lookup")
        history = facts
    heavy = heavy_keys(history, keys, width)
    hashed = [f.name for f in facts.schema if not isinstance(f.dataType, MapType)]
    row_hash = F.xxhash64(F.spark_partition_id(), *hashed)
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    lanes = F.when(missing, F.lit(width)).otherwise(F.coalesce("_lanes", F.lit(1)))
    left = (
        facts.join(F.broadcast(heavy), keys, "left")
        .withColumn("_lane", F.pmod(row_hash, lanes).cast("int"))
        .drop("_lanes")
    )
    last_lane = F.coalesce("_lanes", F.lit(1)) - F.lit(1)
    right = (
        lookup.join(F.broadcast(heavy), keys, "left")
        .withColumn("_lane", F.explode(F.sequence(F.lit(0), last_lane)))
        .drop("_lanes")
    )
    return left.join(right, [*keys, "_lane"], "left").drop("_lane")
