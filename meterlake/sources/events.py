"""Usage events as JSON lines: read as text, typed with a record of what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from meterlake.sources.schemas import event_schema

BROKEN_LINE = "broken_line"
SOURCE_LANE = "source_lane"


def text_schema() -> StructType:
    """Every event column as text, plus the raw text of unreadable lines."""
    names = [f.name for f in event_schema()] + [BROKEN_LINE]
    return StructType([StructField(n, StringType()) for n in names])


def bronze_schema() -> StructType:
    """Typed events as they are stored, with what is known about their defects."""
    return (
        event_schema()
        .add(BROKEN_LINE, "string")
        .add("malformed_fields", ArrayType(StringType()))
        .add("event_date", "date")
    )


def scan_lines(spark: SparkSession, landing: str) -> DataFrame:
    """Bounded scan, for replays."""
    reader = spark.read.schema(text_schema())
    return reader.option("columnNameOfCorruptRecord", BROKEN_LINE).json(landing)


def stream_lines(
    spark: SparkSession,
    landing: str,
    files_per_trigger: int = 4,
    bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Unbounded scan of a directory that keeps receiving files. A batch takes in so many
    files or, for large deliveries, so many bytes ("64g").
    """
    limit = ("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        limit = ("maxBytesPerTrigger", bytes_per_trigger)
    return (
        spark.readStream.schema(text_schema())
        .option("columnNameOfCorruptRecord", BROKEN_LINE)
        .option(*limit)
        .json(landing)
    )


def with_source_lane(lines: DataFrame, lanes: int) -> DataFrame:
    """Number the file split a row came from, `0 .. lanes-1`.

    Stable under retries, and different for copies delivered by different splits,
    which makes it the salt for deduplicating heavily repeated ids.
    """
    split = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
    return lines.withColumn(SOURCE_LANE, F.pmod(split, F.lit(lanes)))


def _text(name: str) -> Column:
    """A cell of a readable line. Cells parsed before the break of a cut-off line do
    not count; wrapping the column also keeps filters on it from being applied inside
    the JSON reader, which would judge such a line by those cells and drop it.
    """
    return F.when(F.col(BROKEN_LINE).isNull(), F.col(name))


def parsed_cell(raw: Column, kind: DataType) -> Column:
    """A cell's text as a value of its type, null if it is none."""
    if isinstance(kind, StringType):
        return raw
    if isinstance(kind, (LongType, IntegerType)):
        # "5.0" is still the whole number five
        number = raw.try_cast("decimal(38,6)")
        whole = F.when(number == F.floor(number), number.try_cast(kind))
        return F.coalesce(raw.try_cast(kind), whole)
    if isinstance(kind, DoubleType):
        # "NaN" and "Infinity" are no measurements
        number = raw.try_cast("double")
        return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    return raw.try_cast(kind)


def _parsed(field: StructField) -> Column:
    return parsed_cell(_text(field.name), field.dataType)


def typed_events(lines: DataFrame) -> DataFrame:
    """Cast text columns to the event schema.

    A cell whose text does not parse becomes null and its column name is listed in
    `malformed_fields`, so that the quality rules can tell it from a missing one.
    """
    fields = event_schema().fields
    failed = [
        F.when(_text(f.name).isNotNull() & _parsed(f).isNull(), F.lit(f.name))
        for f in fields
        if not isinstance(f.dataType, StringType)
    ]
    # withColumns evaluates every expression against the text columns
    return lines.withColumns(
        {
            "malformed_fields": F.array_compact(F.array(*failed)),
            **{f.name: _parsed(f) for f in fields},
        }
    )
