"""Bringing the small files of a zone together, day by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.operators.joins import lookup_join
from meterlake.operators.upsert import LOAD, READY, finish_loads, note, swap_in
from meterlake.session import cut_lineage
from meterlake.sources.zones import among, null_safe, read_zone

TARGET_BYTES = 128 << 20
# Files at least this share of the target are left to themselves.
FULL_SHARE = 0.75


def file_listing(spark: SparkSession, path: str, partition_by: str) -> DataFrame:
    """Files of a zone with their partition and length. No content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(
        partition_by, F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes")
    )


def compaction_plan(
    files: DataFrame, partition_by: str, target_bytes: int = TARGET_BYTES
) -> DataFrame:
    """partition, file, bytes, bin of the partitions that would have fewer files.

    In each partition the small files, by falling size, are put one after the other into
    bins of the target size; a file that is nearly full has a bin of its own. A partition
    is left out if that saves no file. A window sees the files of one partition, a row
    each.
    """
    full = F.col("bytes") >= FULL_SHARE * target_bytes
    small = W.partitionBy(partition_by, full).orderBy(F.desc("bytes"), "file")
    ahead = F.coalesce(F.sum("bytes").over(small.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(small)
    slot = F.when(full, -own).otherwise(F.floor(ahead / target_bytes)).cast("int")
    binned = files.withColumn("bin", slot)
    sizes = binned.groupBy(partition_by).agg(
        F.count("*").alias("n_files"), F.count_distinct("bin").alias("n_bins")
    )
    fewer = sizes.where("n_bins < n_files").select(partition_by)
    return binned.alias("b").join(
        fewer.alias("f"), null_safe("b", "f", [partition_by]), "left_semi"
    )


def compact(
    spark: SparkSession,
    path: str,
    staging: str,
    partition_by: str = "event_date",
    target_bytes: int = TARGET_BYTES,
    schema: StructType | None = None,
    sort_within: list[Column | str] | None = None,
) -> DataFrame:
    """Rewrite the partitions of a zone that have too many files, and return the plan
    followed: `compaction_plan`.

    Only those partitions are read, and each bin is written by one task, so sizes follow
    the files' lengths. The days to rewrite are collected, and what bin a file is in is
    joined by whatever way its counted size allows. New files are complete below `staging` and noted in its journal
    before partitions are swapped, as for an upsert; a run that was cut off is finished by
    the next. The zone is one that batches write: a stream's own sink keeps a list of its
    files, which a rewrite would not be on. Nothing else may write the zone meanwhile.
    """
    finish_loads(spark, path, staging, partition_by, sort_within, rebalance=False)
    plan = cut_lineage(
        compaction_plan(file_listing(spark, path, partition_by), partition_by, target_bytes)
    )
    days = [r[0] for r in plan.select(partition_by).distinct().collect()]
    if not days:
        return plan
    rows = read_zone(spark, path, schema).where(among(partition_by, days))
    columns = rows.columns
    bins = plan.select(F.col("file").alias("_file"), F.col("bin").alias("_bin"))
    dealt = lookup_join(rows.withColumn("_file", F.col("_metadata.file_path")), bins, "_file")
    whole = dealt.repartition(partition_by, "_bin").select(*columns)
    writer = whole.write.mode("overwrite").partitionBy(partition_by)
    writer.parquet(f"{staging}/{LOAD}/merged")
    note(spark, staging, LOAD, READY)
    swap_in(spark, path, staging, LOAD, partition_by, sort_within, rebalance=False)
    return plan
