"""Keyed merges over plain Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.dedupe import one_row_per_key
from meterlake.sources.zones import among, listed, read_zone, table_exists, write_partitions


def latest_per_key(
    incoming: DataFrame, keys: list[str], version: str | None = None
) -> DataFrame:
    """One row per key; of several, the one with the greatest `version` wins."""
    return one_row_per_key(incoming, keys, [version] if version else None)


def without(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows whose key is not in `incoming`.

    Both sides hold a key at most once, so no shuffle partition can be heavy. The
    match is null-safe: a null in a key is a value like any other.
    """
    left, right = existing.alias("old"), incoming.alias("new")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}"))
    return left.join(right, same, "left_anti")


def merged(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows whose key is not in `incoming`, plus `incoming`."""
    return without(existing, incoming, keys).unionByName(incoming)


# A load's rows are below this folder; the next load replaces them.
LOAD = "load"
JOURNAL = "load string, state string, incoming string, keys array<string>"
READY, ADDING, DONE = "ready", "adding", "done"


def note(
    spark: SparkSession,
    staging: str,
    load: str,
    state: str,
    incoming: str | None = None,
    keys: list[str] | None = None,
) -> None:
    """Write down how far the last load has come. There is one load at a time, so this
    takes the place of what was noted. Lost between the two, the note of a load that was
    not ready, or is done, says nothing that matters.

    A load's folder `merged` holds its rows whole. With `incoming`, the rows are those of
    that folder and of the load's folder `kept`. A load that is `ADDING` has the rows of
    `incoming` alone, of which some may be in the table; its `keys` find them there.
    """
    row = spark.createDataFrame([(load, state, incoming, keys)], JOURNAL)
    row.coalesce(1).write.mode("overwrite").parquet(f"{staging}/journal")


def _unfinished(spark: SparkSession, staging: str) -> list[Row]:
    if not table_exists(spark, f"{staging}/journal"):
        return []
    # older notes may lack the last columns, which are null then
    notes = spark.read.schema(JOURNAL).parquet(f"{staging}/journal").collect()
    return [r for r in notes if r["state"] in (READY, ADDING)]


def unfinished_loads(spark: SparkSession, staging: str) -> list[str]:
    """The load, if any, whose rows are complete but may not be in the table."""
    return [r["load"] for r in _unfinished(spark, staging)]


def finish_loads(
    spark: SparkSession,
    path: str,
    staging: str,
    partition_by: str | list[str],
    sort_within: list[Column | str] | None = None,
    rebalance: bool = True,
) -> None:
    """Write the rows of a load that was interrupted. They hold their partitions whole, so
    this puts right a table that was left without some of them. Rows that were being added
    to partitions are merged into them by key.
    """
    for row in _unfinished(spark, staging):
        if row["state"] == ADDING:
            fresh = read_zone(spark, row["incoming"])
            existing = read_zone(spark, path, fresh.schema)
            lead = listed(partition_by)
            found = fresh.select(*lead).distinct().collect()
            kept = without(_touched(existing, found, lead), fresh, row["keys"])
            _stage_kept(kept, staging, row["load"], row["incoming"])
        swap_in(
            spark, path, staging, row["load"], partition_by, sort_within, rebalance,
            row["incoming"],
        )


def swap_in(
    spark: SparkSession,
    path: str,
    staging: str,
    load: str,
    partition_by: str | list[str],
    sort_within: list[Column | str] | None = None,
    rebalance: bool = True,
    incoming: str | None = None,
) -> None:
    """Replace partitions by a load's rows, which are where `note` says."""
    if incoming is None:
        rows = read_zone(spark, f"{staging}/{load}/merged")
    else:
        fresh = read_zone(spark, incoming)
        rows = read_zone(spark, f"{staging}/{load}/kept", fresh.schema).unionByName(fresh)
    write_partitions(rows, path, partition_by, sort_within, rebalance)
    note(spark, staging, load, DONE)


def _in_partitions(rows: DataFrame, parts: DataFrame, columns: list[str]) -> DataFrame:
    same = F.lit(True)
    for column in columns:
        same = same & F.col(f"rows.{column}").eqNullSafe(F.col(f"parts.{column}"))
    return rows.alias("rows").join(F.broadcast(parts.alias("parts")), same, "left_semi")


def _touched(existing: DataFrame, found: list[Row], lead: list[str]) -> DataFrame:
    """Rows of the partitions that are listed in `found`."""
    affected = existing
    for column in lead:
        affected = affected.where(among(column, {r[column] for r in found}))
    if len(lead) > 1:
        # the conditions above open the files; this leaves the touched combinations
        rows = [tuple(r[column] for column in lead) for r in found]
        touched = existing.sparkSession.createDataFrame(rows, existing.select(*lead).schema)
        affected = _in_partitions(affected, touched.distinct(), lead)
    return affected


def _stage_kept(kept: DataFrame, staging: str, load: str, incoming: str) -> None:
    """Complete a load: the rows that stay beside those that come in."""
    kept.write.mode("overwrite").parquet(f"{staging}/{load}/kept")
    note(kept.sparkSession, staging, load, READY, incoming)


def _answers(condition: Column, rows: DataFrame, columns: list[str]) -> bool:
    """Whether these columns of `rows` are all that a condition asks about."""
    try:
        rows.select(*columns).select(condition)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
        return False
    return True


def upsert(
    incoming: DataFrame,
    path: str,
    staging: str,
    keys: list[str],
    partition_by: str | list[str],
    version: str | None = None,
    sort_within: list[Column | str] | None = None,
    unique: bool = False,
    replaces: Column | None = None,
    stored_at: str | None = None,
) -> None:
    """Merge `incoming` into the table at `path`; the last write per key stays.

    `unique` states that `incoming` has each key once, as grouped results do, and
    saves looking for repeated ones. `replaces` is a condition on stored rows that
    `incoming` recomputes: those of them it no longer has go. `stored_at` names the folder
    that `incoming` is read from as it is, which saves a copy of it; then that folder must
    stay until the load is done, or finished by the next.

    Only partitions that `incoming` touches are read and rewritten, or all with rows
    that it replaces. A key is in one partition. The rows of these partitions that stay go
    to a folder of their own below `staging` first, because a table cannot be overwritten
    while it is read, and a journal there says when they are complete. Swapping partitions
    is not atomic: a load that was interrupted is finished by the next one before it reads
    the table. One load at a time may write a table; what it leaves below `staging`, the
    next one replaces. The touched partitions are collected and broadcast, a row for each.

    Where `replaces` asks about the key alone, it answers alike for all rows of a key. So
    no stored row that is left has the key of an incoming row that it holds for, and only
    the other incoming rows, usually none, are joined to find keys that they overwrite.
    If it holds for all incoming rows and for no stored one, no row goes, and the incoming
    ones are added to their partitions as further files; the next load that replaces rows
    there brings the files together.
    """
    spark = incoming.sparkSession
    finish_loads(spark, path, staging, partition_by, sort_within)
    fresh = incoming if unique else latest_per_key(incoming, keys, version)
    if not table_exists(spark, path):
        write_partitions(fresh, path, partition_by, sort_within)
        return
    if stored_at is None or not unique:
        # computed once, then read twice: for the touched partitions and for the swap
        stored_at = f"{staging}/{LOAD}/incoming"
        fresh.write.mode("overwrite").parquet(stored_at)
    fresh = read_zone(spark, stored_at, fresh.schema)
    existing = read_zone(spark, path, fresh.schema)
    lead = listed(partition_by)
    held = F.lit(False)
    if replaces is not None:
        replaces = F.coalesce(replaces, F.lit(False))
        if _answers(replaces, fresh, [*dict.fromkeys([*keys, *lead])]):
            held = replaces
    parts = fresh.select(*lead, held.alias("_held"), F.lit(False).alias("_goes"))
    if replaces is not None:
        gone = existing.where(replaces).select(*lead, F.lit(True), F.lit(True))
        parts = parts.union(gone)
    # three rows at most per touched partition: bounded by the number of partitions
    found = parts.distinct().collect()
    if not found:
        return
    if all(r["_held"] and not r["_goes"] for r in found):
        note(spark, staging, LOAD, ADDING, stored_at, keys)
        write_partitions(fresh, path, partition_by, sort_within, mode="append")
        note(spark, staging, LOAD, DONE)
        return
    affected = _touched(existing, found, lead)
    if replaces is not None:
        affected = affected.where(~replaces)
    if not all(r["_held"] for r in found):
        affected = without(affected, fresh.where(~held), keys)
    _stage_kept(affected, staging, LOAD, stored_at)
    swap_in(spark, path, staging, LOAD, partition_by, sort_within, incoming=stored_at)
