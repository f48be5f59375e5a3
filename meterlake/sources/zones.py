"""Parquet zones: writing whole tables and replacing single partitions."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Readers pass over names that begin with an underscore.
LAYOUT = "_layout"
ROWS = "_rows"


def read_zone(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """A zone. A partitioned zone without rows has no file to take its schema from; then
    it is the one `write_snapshot` left beside the data.
    """
    if schema is None:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
        text = spark.read.text(f"{path.rstrip('/')}/{LAYOUT}").first()[0]
        schema = StructType.fromJson(json.loads(text))
    return spark.read.schema(schema).parquet(path)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Shuffle rows into well-sized output files.

    The rebalance hint lets adaptive execution split an oversized key (a day with
    a third of the rows) over several writers and merge the small ones, so file
    size follows `spark.sql.adaptive.advisoryPartitionSizeInBytes`.
    """
    return df.hint("rebalance", *columns)


def listed(columns: str | list[str] | None) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns or [])


def write_snapshot(
    df: DataFrame,
    path: str,
    partition_by: str | list[str] | None = None,
    sort_within: list[Column | str] | None = None,
) -> int:
    """Replace the whole table: partitions absent from `df` disappear as well. The schema
    of a partitioned table is kept with it, for when it has no rows. The number of rows
    is counted by the tasks that write them, kept with the table, and returned.
    """
    lead = listed(partition_by)
    out = balanced(df, *lead)
    if sort_within:
        out = out.sortWithinPartitions(*lead, *sort_within)
    counted = Observation()
    # behind the last shuffle: there every partition's rows count once, retries or not
    out = out.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*lead) if lead else writer).parquet(path)
    if lead:
        layout = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
        layout.coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/{LAYOUT}")
    rows = counted.get["rows"]
    write_mark(df.sparkSession, path, ROWS, str(rows))
    return rows


def rows_written(spark: SparkSession, path: str) -> int | None:
    """How many rows the last `write_snapshot` of a zone wrote; None if it was written
    otherwise. No row is read.
    """
    mark = read_mark(spark, path, ROWS)
    return int(mark) if mark else None


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: str | list[str],
    sort_within: list[Column | str] | None = None,
    rebalance: bool = True,
    mode: str = "overwrite",
) -> None:
    """Replace only the partitions `df` has rows for; the others stay untouched. With the
    mode "append" these keep the rows they have, too. Without `rebalance` rows are written
    by the tasks that have them. A number of rows that was kept with the table no longer
    holds.
    """
    lead = listed(partition_by)
    if read_mark(df.sparkSession, path, ROWS):
        write_mark(df.sparkSession, path, ROWS, "")
    out = balanced(df, *lead) if rebalance else df
    if sort_within:
        out = out.sortWithinPartitions(*lead, *sort_within)
    (
        out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*lead)
        .parquet(path)
    )


# -- whole tables that readers see before or after a reload, never in between ----------

SLOTS = ("a", "b")
WRITTEN = "_written"


def write_mark(spark: SparkSession, path: str, name: str, text: str) -> None:
    """Leave a line of text beside the data of a folder."""
    line = spark.range(1).select(F.lit(text).alias("value"))
    line.coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/{name}")


def read_mark(spark: SparkSession, path: str, name: str) -> str | None:
    """The line left beside the data, if it was written to its end."""
    try:
        row = spark.read.text(f"{path.rstrip('/')}/{name}").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row[0] if row else None


def complete_slots(spark: SparkSession, path: str) -> dict[str, int]:
    """The slots of a switched table that are written, and in which order they were."""
    marks = {s: read_mark(spark, f"{path.rstrip('/')}/{s}", WRITTEN) for s in SLOTS}
    return {s: int(n) for s, n in marks.items() if n}


Slots = tuple[str | None, str, int]


def slot_paths(spark: SparkSession, path: str) -> Slots:
    """Of a switched table: the folder to read, if there is one, the folder that the next
    reload writes, and that reload's number.
    """
    done = complete_slots(spark, path)
    current = max(done, key=done.get, default=None)
    other = next(s for s in SLOTS if s != current)
    base = path.rstrip("/")
    return current and f"{base}/{current}", f"{base}/{other}", max(done.values(), default=0) + 1


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a switched table are; of a plain zone, the zone itself."""
    return slot_paths(spark, path)[0] or path


def write_switched(
    df: DataFrame,
    path: str,
    partition_by: str | list[str] | None = None,
    sort_within: list[Column | str] | None = None,
    mark: tuple[str, str] | None = None,
    slots: Slots | None = None,
) -> None:
    """Replace a whole table that goes on answering with its old rows until the new ones
    are complete, and with them a `mark` (name, text), if given.

    A table has two slots. A reload empties and writes the one that readers do not use,
    and marks it with its number as the last thing it does; readers take the slot with
    the greatest number. A reload that is lost midway leaves a slot without a mark, which
    the next one overwrites; nothing has to be cleaned up. `df` may read the table itself.
    A reader that started before a reload can finish, unless two reloads pass meanwhile.
    `slots` spares looking for them, if that has just been done.
    """
    spark = df.sparkSession
    _, target, number = slots or slot_paths(spark, path)
    write_snapshot(df, target, partition_by, sort_within)
    if mark:
        write_mark(spark, target, *mark)
    write_mark(spark, target, WRITTEN, str(number))


def latest_snapshot(df: DataFrame, column: str = "ingest_date") -> DataFrame:
    """Rows of the newest snapshot only.

    A table keeps one snapshot per ingest date; joining to all of them would
    multiply rows. The date is a scalar subquery on the partition column, so the
    scan opens the newest partition alone.
    """
    return df.where(F.col(column) == df.select(F.max(column)).scalar())


def among(column: str, values: list | set) -> Column:
    """The column is one of the values, of which null may be one."""
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


def null_safe(left: str, right: str, columns: list[str]) -> Column:
    """Equality of columns of two aliased tables, nulls equal to nulls."""
    same = F.lit(True)
    for column in columns:
        same = same & F.col(f"{left}.`{column}`").eqNullSafe(F.col(f"{right}.`{column}`"))
    return same


def partition_listing(spark: SparkSession, path: str, partition_by: str) -> DataFrame:
    """Files, bytes and newest file of each partition of a zone.

    Works on the listing of the files: the binary source reads no content as long as
    the content column is not selected.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.groupBy(partition_by).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("newest"),
    )


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("probe int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
