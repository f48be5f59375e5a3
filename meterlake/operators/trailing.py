"""Totals over a moving window, by adding what enters and taking away what leaves."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Running sums are kept as decimals: what was added can be taken away without a rest.
EXACT = "decimal(38,12)"


def window_days(as_of: dt.date | None, days: int) -> set[dt.date]:
    """The days of a trailing window, none if there is no newest day."""
    return set() if as_of is None else {as_of - dt.timedelta(days=i) for i in range(days)}


def summed(rows: DataFrame, keys: list[str], sums: list[str], largest: list[str]) -> DataFrame:
    """Totals from nothing: `keys`, the sums and how many values each adds up, the
    greatest values, and `_rows`. A sum of no values is zero here; see `shown`.
    """
    return rows.groupBy(*keys).agg(
        *[_total(F.col(c).cast(EXACT)).alias(c) for c in sums],
        *[F.count(c).alias(f"_n_{c}") for c in sums],
        *[F.max(c).alias(c) for c in largest],
        F.count("*").alias("_rows"),
    )


def shown(column: str) -> Column:
    """A running sum as a double, null if nothing was added up."""
    return F.when(F.col(f"_n_{column}") > 0, F.col(column).cast("double"))


def _total(x: Column) -> Column:
    return F.coalesce(F.sum(x), F.lit(0)).cast(EXACT)


def moved(
    totals: DataFrame,
    removed: DataFrame,
    added: DataFrame,
    window: DataFrame,
    keys: list[str],
    sums: list[str],
    largest: list[str],
) -> DataFrame:
    """`totals`, as from `summed`, after rows left their window and others entered it.

    Sums and numbers of rows change by the difference; keys without rows go. A greatest
    value can only fall for keys whose removed rows held it and no added row replaces it:
    for these alone it is looked up in `window`, the rows as they are now. Nulls add
    nothing and rank lowest; keys may be null.
    """

    def signed(rows: DataFrame, sign: int, role: str) -> DataFrame:
        return rows.select(
            *keys,
            *[(F.col(c).cast(EXACT) * sign).cast(EXACT).alias(c) for c in sums],
            *[(F.col(c).isNotNull().cast("bigint") * sign).alias(f"_n_{c}") for c in sums],
            F.lit(sign).cast("bigint").alias("_rows"),
            *[_in_role(c, role) for c in largest],
        )

    def _in_role(column: str, role: str) -> Column:
        value = F.struct(F.col(column).alias("v"))
        return F.struct(
            *[F.when(F.lit(r == role), value).alias(r) for r in ("held", "gone", "new")]
        ).alias(column)

    counts = [f"_n_{c}" for c in sums]
    state = totals.select(
        *keys, *sums, *counts, "_rows", *[_in_role(c, "held") for c in largest]
    )
    both = state.unionByName(signed(removed, -1, "gone")).unionByName(signed(added, 1, "new"))
    roles = [
        F.max(F.col(f"{c}.{r}.v")).alias(f"_{r}_{c}") for c in largest for r in ("held", "gone", "new")
    ]
    changed = (
        both.groupBy(*keys)
        .agg(
            *[_total(F.col(c)).alias(c) for c in sums],
            *[F.sum(c).alias(c) for c in (*counts, "_rows")],
            *roles,
        )
        .where("_rows > 0")
    )
    for c in largest:
        best = F.greatest(f"_held_{c}", f"_new_{c}")
        left = F.col(f"_gone_{c}") >= best
        # a value that is added again holds its place
        left = left & ~(F.col(f"_new_{c}") >= F.col(f"_gone_{c}")).eqNullSafe(True)
        changed = changed.withColumn(c, best).withColumn(f"_left_{c}", left.eqNullSafe(True))
    if not largest:
        return changed.select(*keys, *sums, *counts, "_rows")
    lost = F.lit(False)
    for c in largest:
        lost = lost | F.col(f"_left_{c}")
    changed = changed.withColumn("_lost", lost)

    def same(right: str) -> Column:
        met = F.lit(True)
        for k in keys:
            met = met & F.col(f"c.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
        return met

    again = (
        window.alias("w")
        .join(changed.where("_lost").select(*keys).alias("c"), same("w"), "left_semi")
        .groupBy(*keys)
        .agg(*[F.max(c).alias(f"_again_{c}") for c in largest])
    )
    found = changed.alias("c").join(again.alias("a"), same("a"), "left")
    return found.select(
        *[F.col(f"c.`{k}`").alias(k) for k in keys],
        *sums,
        *counts,
        *[F.when(F.col(f"_left_{c}"), F.col(f"_again_{c}")).otherwise(F.col(c)).alias(c) for c in largest],
        "_rows",
    )
