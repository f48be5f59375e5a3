"""Cost profiles from mergeable state: a row for each service and day, merged by union.

A day's state is its number of costs, their mean and squared deviations, and a KLL sketch.
None of them depends on other days, so a history is profiled by reading the days that are
new, and merging small rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake.operators.outliers import BAND, PROFILE, costs_of

SKETCH_K = 4000
# Ranks of a sketch of this size are off by no more than this share of the values, with
# 99 % confidence; a merged sketch is no worse. The deviation is found between two ranks,
# among the quantiles of a grid.
RANK_ERROR = 0.0015
GRID = 2000
DEVIATION_RANK_ERROR = 2 * RANK_ERROR + 1 / GRID

STATE = "service string, n_values bigint, mean double, m2 double, sketch binary, event_date date"


def day_states(events: DataFrame, day: str = "event_date") -> DataFrame:
    """State of every service and day. Map tasks merge what they have of a group, so a day
    or service with most of the rows comes to its reducer as one row from each task.
    """
    x = F.col("cost_usd")
    spread = F.var_pop(x) * F.count(x)
    return (
        costs_of(events, day)
        .groupBy("service", day)
        .agg(
            F.count(x).alias("n_values"),
            F.avg(x).alias("mean"),
            spread.alias("m2"),
            F.kll_sketch_agg_double(x, F.lit(SKETCH_K)).alias("sketch"),
        )
    )


def merged_profile(states: DataFrame) -> DataFrame:
    """Cost statistics per service from the states of its days: `n_values` and the columns
    of a profile.

    Count, mean and standard deviation are those of all rows, up to rounding. Quantiles
    are values whose rank is off by `RANK_ERROR` of the values at most, the deviation one
    by `DEVIATION_RANK_ERROR`. The service without a name has no quantiles, as nothing can
    be joined to it. A service has no more rows here than there are days.
    """
    n, mean = F.col("n_values"), F.col("mean")
    own = W.partitionBy("service")
    whole = F.sum(n * mean).over(own) / F.sum(n).over(own)
    merged = (
        states.withColumn("apart", F.coalesce(F.col("m2") + n * (mean - whole) ** 2, F.lit(0.0)))
        .withColumn("whole", whole)
        .groupBy("service")
        .agg(
            F.sum(n).alias("n_values"),
            F.max("whole").alias("mean_cost"),
            F.sum("apart").alias("apart"),
            F.kll_merge_agg_double(
                F.when(F.col("service").isNotNull() & (n > 0), F.col("sketch"))
            ).alias("sketch"),
        )
    )
    measured = F.col("service").isNotNull() & (n > 0)

    def at(rank: float | Column) -> Column:
        return F.when(measured, F.kll_sketch_get_quantile_double("sketch", rank))

    ranks = F.array(*[F.lit(p) for p in BAND.values()])
    found = (
        merged.withColumn("std_cost", F.when(n > 1, F.sqrt(F.col("apart") / (n - 1))))
        .withColumn("band", at(ranks))
        .withColumns({name: F.col("band")[i] for i, name in enumerate(BAND)})
        .withColumn("mad", F.when(measured, _median_deviation(at)))
    )
    return found.select("service", "n_values", *PROFILE)


def _median_deviation(at) -> Column:
    """The distance from the median within which half of a grid of quantiles lie; each of
    them stands for as many values.
    """
    grid = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    middle = F.col("p50")
    distances = F.array_sort(F.transform(at(grid), lambda q: F.abs(q - middle)))
    return F.get(distances, F.lit(GRID // 2 - 1))
