"""Batch landing of the master CSVs into dated snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterlake.operators.dedupe import one_row_per_key
from meterlake.operators.quality import MALFORMED_RULE, REASON
from meterlake.sources.events import BROKEN_LINE, parsed_cell
from meterlake.sources.schemas import MASTERS, Master
from meterlake.sources.zones import latest_snapshot, read_zone, write_partitions


MALFORMED_REASON = next(iter(MALFORMED_RULE))
AUDIT_LAYOUT = "ingest_ts timestamp, source_file string, ingest_date date"


# What is kept about a row's defects between the scan and the split.
MALFORMED = "malformed_cells"


def scan_text(spark: SparkSession, master: Master, landing: str) -> DataFrame:
    """CSV scan with every cell as text, and the text of lines that have too few cells or
    too many. A doubled quote inside a quoted cell is a literal quote, so JSON text
    survives; line breaks inside quotes belong to the cell where the master allows them.
    """
    fields = [StructField(f.name, StringType()) for f in master.schema]
    schema = StructType([*fields, StructField(BROKEN_LINE, StringType())])
    options = {
        "header": True, "escape": '"', "mode": "PERMISSIVE", "multiLine": master.multiline,
        # else a line is judged by the columns that a query happens to need
        "columnPruning": False, "columnNameOfCorruptRecord": BROKEN_LINE,
    }
    reader = spark.read.schema(schema).options(**options)
    return reader.csv(f"{landing.rstrip('/')}/{master.filename}")


def typed_master(lines: DataFrame, master: Master) -> DataFrame:
    """Cells with their types. One that does not fit its type becomes null, and its name
    and text are kept in `malformed_cells`, so that it can be told from a missing one.
    """
    cells = {f.name: parsed_cell(F.col(f.name), f.dataType) for f in master.schema}
    bad = [
        F.when(
            F.col(name).isNotNull() & value.isNull(),
            F.struct(F.lit(name).alias("column"), F.col(name).alias("text")),
        )
        for name, value in cells.items()
    ]
    # withColumns evaluates every expression against the text columns
    return lines.withColumns({MALFORMED: F.array_compact(F.array(*bad)), **cells})


def scan_master(spark: SparkSession, master: Master, landing: str) -> DataFrame:
    """Typed CSV scan of the rows as they can be read: a cell that does not fit its type
    is null here, as are those that a cut line lacks. `split_master` tells them apart.
    """
    rows = typed_master(scan_text(spark, master, landing), master)
    return rows.drop(BROKEN_LINE, MALFORMED)


def with_audit(df: DataFrame, ingest_date: dt.date | None = None) -> DataFrame:
    """Stamp rows with when, from which file and for which snapshot they came.

    The file name is taken from the scan itself and must therefore be added
    before anything shuffles.
    """
    day = F.lit(ingest_date) if ingest_date else F.current_date()
    return df.withColumns(
        {
            "ingest_ts": F.current_timestamp(),
            "source_file": F.col("_metadata.file_path"),
            "ingest_date": day.cast("date"),
        }
    )


def stamped_master(
    spark: SparkSession, master: Master, landing: str, ingest_date: dt.date | None = None
) -> DataFrame:
    """All rows of a master, typed and stamped, with what is wrong with them: the line if
    it is broken, the cells of another type, and the reason to keep the row apart.
    """
    rows = typed_master(with_audit(scan_text(spark, master, landing), ingest_date), master)
    missing = [F.when(F.col(k).isNull(), F.lit(f"{k}_null")) for k in master.keys]
    broken = F.when(F.col(BROKEN_LINE).isNotNull(), F.lit(BROKEN_LINE))
    return rows.withColumn(REASON, F.coalesce(broken, *missing))


def snapshot_rows(rows: DataFrame, master: Master) -> DataFrame:
    """The deduplicated snapshot out of stamped rows: those without a reason against them.
    A row with an unreadable cell stays, without that cell.
    """
    kept = rows.where(F.col(REASON).isNull()).drop(REASON, BROKEN_LINE, MALFORMED)
    return one_row_per_key(kept, list(master.keys))


def snapshot_master(
    spark: SparkSession,
    master: Master,
    landing: str,
    ingest_date: dt.date | None = None,
) -> DataFrame:
    """The deduplicated, stamped snapshot of one master; rows without a key and broken
    lines are not in it, see `rejected_rows`.
    """
    return snapshot_rows(stamped_master(spark, master, landing, ingest_date), master)


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Stamped rows that the snapshot leaves out, every one of them, with the reason."""
    return rows.where(F.col(REASON).isNotNull()).drop(MALFORMED)


def rescued_cells(rows: DataFrame, master: Master) -> DataFrame:
    """A row for every cell that could not be read: the keys of its row, as far as they
    could, its column and text. Cells of broken lines are not told one by one.
    """
    cells = rows.where(F.col(BROKEN_LINE).isNull()).withColumn("cell", F.explode(MALFORMED))
    keys = F.array(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in master.keys])
    return cells.select(
        F.to_json(keys).alias("row_key"), F.col("cell.column").alias("column"),
        F.col("cell.text").alias("text"), F.lit(MALFORMED_REASON).alias(REASON),
        "ingest_ts", "source_file", "ingest_date",
    )


def ingest_masters(
    spark: SparkSession,
    landing: str,
    bronze: str,
    ingest_date: dt.date | None = None,
    names: list[str] | None = None,
) -> list[str]:
    """Write one dated snapshot per master; a second run on a day replaces it. Rows that
    are rejected, and cells that could not be read, are kept apart by day, until a run on
    that day has others.
    """
    done = []
    for name in names or list(MASTERS):
        master = MASTERS[name]
        rows = stamped_master(spark, master, landing, ingest_date)
        for part, path in (
            (rejected_rows(rows), rejected_path(bronze, name)),
            (rescued_cells(rows, master), rescued_path(bronze, name)),
            (snapshot_rows(rows, master), master_path(bronze, name)),
        ):
            write_partitions(part, path, "ingest_date")
        done.append(name)
    return done


def master_path(bronze: str, name: str) -> str:
    return f"{bronze.rstrip('/')}/masters/{name}"


def rejected_path(bronze: str, name: str) -> str:
    return f"{bronze.rstrip('/')}/masters_rejected/{name}"


def rescued_path(bronze: str, name: str) -> str:
    return f"{bronze.rstrip('/')}/masters_unread_cells/{name}"


def rejected_master(spark: SparkSession, bronze: str, name: str) -> DataFrame:
    """Rows of all snapshots that were left out: broken lines, and rows without a key."""
    layout = f"{MASTERS[name].layout}, {BROKEN_LINE} string, {AUDIT_LAYOUT}, {REASON} string"
    return read_zone(spark, rejected_path(bronze, name), layout)


def unread_cells(spark: SparkSession, bronze: str, name: str) -> DataFrame:
    """Cells of all snapshots that did not fit their type."""
    layout = f"row_key string, column string, text string, {REASON} string, {AUDIT_LAYOUT}"
    return read_zone(spark, rescued_path(bronze, name), layout)


def current_master(spark: SparkSession, bronze: str, name: str) -> DataFrame:
    layout = f"{MASTERS[name].layout}, {AUDIT_LAYOUT}"
    return latest_snapshot(read_zone(spark, master_path(bronze, name), layout))
