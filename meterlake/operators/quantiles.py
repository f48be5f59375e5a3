"""Exact per-group quantiles without bringing a large group together.

Spark's exact percentile holds the values of a group in one task. That is fine for
inputs counted to be small, and out of the question for a group with a third of a
huge table. Beyond the limit each level

1. sketches every group (KLL, merged in two steps) to bracket the wanted ranks,
2. counts rows below, at and between the bracket ends, which proves where the
   rank lies, and
3. keeps for the next level only rows strictly inside an unresolved bracket.

A level keeps about a hundredth of the rows, so a few are enough for any table.
The sketch only steers; the answer rests on the counts, so it does not depend on
the sketch, on the partitioning, or on the order of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake.operators.joins import lookup_join
from meterlake.session import cut_lineage, stored

# Values a single ranking task may be handed; always compared with exact counts.
SMALL_ROWS = 1_000_000
SKETCH_K = 4000
GRID = 2000
MARGIN = 3  # grid cells added on each side: about twice the error of the sketch
MERGE_LANES = 64


def exact_quantiles(
    df: DataFrame,
    by: str,
    value: str,
    probs: dict[str, float],
    also: list[Column] | None = None,
    small_rows: int = SMALL_ROWS,
    groups: DataFrame | None = None,
) -> DataFrame:
    """One row per group: `by`, the aggregates in `also`, the number of values as
    `n_values`, and one column per entry of `probs`, each the least value whose rank
    reaches p * n_values.

    Null and NaN values are skipped. The null group is counted but gets no quantiles,
    whatever the size, since nothing can be joined to it anyway. `groups` may give
    the counts (`by`, `n_values`) if they are known, and saves a pass.
    """
    x = F.when(~F.isnan(value), F.col(value).cast("double"))
    measured = df.withColumn("_x", x).groupBy(by)
    counted = [*(also or []), F.count("_x").alias("n_values")]
    if groups is None:
        groups = cut_lineage(measured.agg(*counted))
    if (groups.agg(F.sum("n_values")).first()[0] or 0) <= small_rows:
        sorted_lists = [
            F.expr(f"percentile_disc({p}D) within group (order by _x)").alias(name)
            for name, p in probs.items()
        ]
        named = F.col(by).isNotNull()
        return measured.agg(*counted, *sorted_lists).withColumns(
            {name: F.when(named, F.col(name)) for name in probs}
        )

    wanted = groups.dropna(subset=[by]).select(
        F.col(by).alias("_g"),
        F.explode(F.array(*[_want(n, p) for n, p in probs.items()])).alias("_w"),
    ).select("_g", "_w.*")
    values = df.select(F.col(by).alias("_g"), x.alias("_x")).dropna()
    answers = (
        _narrow_and_pick(values, wanted, len(probs), small_rows)
        .groupBy(F.col("_g").alias(by))
        .agg(
            *[
                F.max(F.when(F.col("_target") == name, F.col("_x"))).alias(name)
                for name in probs
            ]
        )
    )
    return groups.join(answers, by, "left")


def _want(name: str, p: float) -> Column:
    n = F.col("n_values")
    rank = F.greatest(F.lit(1).cast("bigint"), n - F.floor(n - F.lit(float(p)) * n))
    return F.struct(F.lit(name).alias("_target"), rank.alias("_rank"))


def _sort_and_pick(values: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Sort and take; only for inputs whose counted size is small."""
    order = W.partitionBy(*keys).orderBy("_x")
    ranked = values.withColumn("_rank", F.row_number().over(order).cast("bigint"))
    return ranked.join(wanted, [*keys, "_rank"]).select("_g", "_target", "_x")


def _narrow_and_pick(
    rows: DataFrame, wanted: DataFrame, targets: int, small_rows: int
) -> DataFrame:
    keys, slots = ["_g"], targets
    found: list[DataFrame] = []
    while True:
        # fixed before use: a second evaluation of a sketch may differ
        brackets = cut_lineage(_brackets(rows, wanted, keys))
        counted = cut_lineage(_count_against(rows, brackets, keys, slots))
        found.append(counted.dropna(subset=["_x"]).select("_g", "_target", "_x"))
        unresolved = counted.where("_x is null")
        remaining = unresolved.agg(F.sum("_inside")).first()[0] or 0
        if not remaining:
            break
        rows = stored(_rows_inside(rows, unresolved, keys, slots), "inside")
        wanted = unresolved.select("_g", "_target", "_rank")
        # from now on every target has rows of its own
        keys, slots = ["_g", "_target"], 1
        if remaining <= small_rows:
            found.append(_sort_and_pick(rows, wanted, keys))
            break
    return reduce(DataFrame.unionByName, found)


def _brackets(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Two values per wanted rank that very likely enclose it."""
    lane = F.pmod(F.spark_partition_id(), F.lit(MERGE_LANES))
    partial = rows.groupBy(*keys, lane.alias("_lane")).agg(
        F.kll_sketch_agg_double("_x", SKETCH_K).alias("_sketch"),
        F.count("*").alias("_n"),
    )
    marks = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    grids = (
        partial.groupBy(*keys)
        .agg(
            F.kll_merge_agg_double("_sketch", SKETCH_K).alias("_sketch"),
            F.sum("_n").alias("_n"),
        )
        .select(
            *keys, "_n", F.kll_sketch_get_quantile_double("_sketch", marks).alias("_at")
        )
    )
    cell = F.col("_rank") / F.col("_n") * F.lit(GRID)
    low = F.greatest(F.floor(cell) - F.lit(MARGIN), F.lit(0))
    high = F.least(F.ceil(cell) + F.lit(MARGIN), F.lit(GRID))
    return wanted.join(grids, keys).select(
        "_g",
        "_target",
        "_rank",
        F.get("_at", low.cast("int")).alias("_low"),
        F.get("_at", high.cast("int")).alias("_high"),
    )


def _beside(
    rows: DataFrame, table: DataFrame, keys: list[str], slots: int
) -> tuple[DataFrame, DataFrame]:
    """Every row next to what `table` says about the targets of its key, one set of
    columns per target (`_low0`, `_low1`, ...), so that rows need not be multiplied.
    Also the table itself with the targets of a key as a list, in the same order.
    """
    fields = [c for c in table.columns if c not in keys]
    fields.sort(key=lambda c: c != "_target")  # the order within the list
    listed = table.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("_slots")
    )
    flat = [
        F.get("_slots", F.lit(i))[c].alias(f"{c}{i}")
        for i in range(slots)
        for c in fields
    ]
    return lookup_join(rows, listed.select(*keys, *flat), keys), listed


def _count_against(
    rows: DataFrame, brackets: DataFrame, keys: list[str], slots: int
) -> DataFrame:
    """Settle a rank that falls on a bracket end; else give the open interval that
    holds it, how many rows are inside, and the rank counted from there.
    """
    beside, listed = _beside(rows, brackets, keys, slots)
    x = F.col("_x")
    tallies = [
        F.struct(
            F.count_if(x < F.col(f"_low{i}")).alias("_lt_low"),
            F.count_if(x <= F.col(f"_low{i}")).alias("_le_low"),
            F.count_if(x < F.col(f"_high{i}")).alias("_lt_high"),
            F.count_if(x <= F.col(f"_high{i}")).alias("_le_high"),
        )
        for i in range(slots)
    ]
    tallied = beside.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.array(*tallies).alias("_tallies")
    )
    counts = (
        tallied.join(listed, keys)
        .select(*keys, "_n", "_tallies", F.posexplode("_slots").alias("_i", "_slot"))
        .select(*keys, "_n", "_slot.*", F.get("_tallies", F.col("_i")).alias("_t"))
        .select("*", "_t.*")
    )
    settled = F.expr(
        "case when _rank between _lt_low + 1 and _le_low then _low"
        " when _rank between _lt_high + 1 and _le_high then _high end"
    )
    unbounded = F.lit(None).cast("double")

    def interval(skipped: Column, start: Column, end: Column, size: Column) -> Column:
        return F.struct(
            (F.col("_rank") - skipped).alias("_rank"),
            start.alias("_from"),
            end.alias("_to"),
            size.alias("_inside"),
        )

    low, high, n = F.col("_low"), F.col("_high"), F.col("_n")
    up_to_low, up_to_high = F.col("_le_low"), F.col("_le_high")
    below_low, below_high = F.col("_lt_low"), F.col("_lt_high")
    no_rows = F.lit(0).cast("bigint")
    where_next = (
        F.when(F.col("_rank") <= below_low, interval(no_rows, unbounded, low, below_low))
        .when(
            F.col("_rank") <= below_high,
            interval(up_to_low, low, high, below_high - up_to_low),
        )
        .otherwise(interval(up_to_high, high, unbounded, n - up_to_high))
    )
    return counts.select(
        "_g", "_target", settled.alias("_x"), where_next.alias("_next")
    ).select("_g", "_target", "_x", "_next.*")


def _rows_inside(
    rows: DataFrame, unresolved: DataFrame, keys: list[str], slots: int
) -> DataFrame:
    """Rows in the open interval of a target, once for each such target."""
    limits = unresolved.select("_g", "_target", "_from", "_to")
    if "_target" in keys:
        limits = limits.withColumn("_name", F.col("_target"))
    else:
        limits = limits.withColumnRenamed("_target", "_name")
    beside, _ = _beside(rows, limits, keys, slots)
    inside = [
        F.expr(
            f"_name{i} is not null and (_from{i} is null or _x > _from{i})"
            f" and (_to{i} is null or _x < _to{i})"
        )
        for i in range(slots)
    ]
    hits = F.array(*[F.when(test, F.col(f"_name{i}")) for i, test in enumerate(inside)])
    return (
        beside.where(reduce(Column.__or__, inside))
        .select("_g", "_x", F.explode(F.array_compact(hits)).alias("_target"))
    )
