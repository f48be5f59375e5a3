"""Evidence about zones: row counts, partitions and sizes, stability of re-runs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.sources.zones import partition_listing, read_zone, rows_written


def zone_manifest(zones: Mapping[str, DataFrame]) -> DataFrame:
    """One row per zone with its row count."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("zone"), "rows")
        for name, df in zones.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def written_manifest(spark: SparkSession, zones: Mapping[str, str | DataFrame]) -> DataFrame:
    """The same from the counts that writers left beside the zones, given by their paths.
    Zones that have none, and those given as rows, are counted.
    """
    known, others = [], {}
    for name, zone in zones.items():
        rows = rows_written(spark, zone) if isinstance(zone, str) else None
        if rows is not None:
            known.append((name, rows))
        else:
            others[name] = read_zone(spark, zone) if isinstance(zone, str) else zone
    told = spark.createDataFrame(known, "zone string, rows bigint")
    return told.unionByName(zone_manifest(others)) if others else told


def partition_report(spark: SparkSession, path: str, partition_by: str) -> DataFrame:
    """Files and bytes per partition of a zone, from the listing of its files."""
    return partition_listing(spark, path, partition_by).drop("newest")


def zone_size(report: DataFrame) -> DataFrame:
    """Totals over a partition report."""
    return report.agg(
        F.count("*").alias("partitions"),
        F.sum("files").alias("files"),
        F.sum("bytes").alias("bytes"),
    )


def rerun_check(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two manifests side by side; a zone missing from one of them is not stable."""
    left = first.withColumnRenamed("rows", "first_rows")
    right = second.withColumnRenamed("rows", "second_rows")
    return left.join(right, "zone", "full").withColumn(
        "stable", F.col("first_rows").eqNullSafe(F.col("second_rows"))
    )
