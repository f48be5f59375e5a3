"""Cost outliers: a profile per service, four detectors, and a consensus."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.operators.joins import BROADCAST_BYTES, lookup_join
from meterlake.operators.quantiles import SMALL_ROWS, exact_quantiles
from meterlake.session import cut_lineage, stored

# Thresholds of the detectors and the quantiles of the band.
NEGATIVE_COST = -0.01
Z_LIMIT = 3.0
MODIFIED_Z_LIMIT = 3.5
MODIFIED_Z_SCALE = 0.6745
BAND = {"p01": 0.01, "p50": 0.5, "p99": 0.99}
VOTES_NEEDED = 2
# Detector names, as stored in the marts. The first three vote.
STATISTICAL = ("zscore", "mad", "ptiles")
DETECTORS = (*STATISTICAL, "negative")

PROFILE = ("mean_cost", "std_cost", "p01", "p50", "p99", "mad")


def service_band(
    events: DataFrame, exact: bool = True, small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Mean, sample standard deviation and band quantiles per service, materialised."""
    costs = costs_of(events)
    moments = [
        F.avg("cost_usd").alias("mean_cost"),
        F.stddev_samp("cost_usd").alias("std_cost"),
    ]
    if exact:
        band = exact_quantiles(costs, "service", "cost_usd", BAND, moments, small_rows)
    else:
        quantiles = [
            F.percentile_approx("cost_usd", p).alias(name) for name, p in BAND.items()
        ]
        n_values = F.count("cost_usd").alias("n_values")
        band = costs.groupBy("service").agg(*moments, n_values, *quantiles)
    return cut_lineage(band)


def costs_of(events: DataFrame, *columns: str) -> DataFrame:
    """Service and cost, and other columns; a cost that is no number is none, here as in
    the quantiles.
    """
    cost = F.col("cost_usd").cast("double")
    return events.select("service", *columns, F.when(~F.isnan(cost), cost).alias("cost_usd"))


def service_profile(
    events: DataFrame, exact: bool = True, small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Cost statistics per service over the whole history, materialised.

    The band, plus the median absolute deviation from the median. `exact=False`
    takes quantiles from Spark's approximate aggregate instead: fewer passes, and a
    bounded rank error. The exact ones take several passes, over a stored table of the
    two columns they need.
    """
    if exact:
        events = stored(costs_of(events), "costs")
    band = service_band(events, exact, small_rows)
    medians = band.select("service", "p50")
    spread = lookup_join(costs_of(events), medians, "service").select(
        "service", F.abs(F.col("cost_usd") - F.col("p50")).alias("deviation")
    )
    if exact:
        # a deviation exists exactly where a cost does, so the counts carry over
        mad = exact_quantiles(
            spread, "service", "deviation", {"mad": 0.5}, small_rows=small_rows,
            groups=band.select("service", "n_values"),
        )
    else:
        mad = spread.groupBy("service").agg(
            F.percentile_approx("deviation", 0.5).alias("mad")
        )
    full = band.join(mad.select("service", "mad"), "service", "left")
    return cut_lineage(full.select("service", "n_values", *PROFILE))


def _scores(negative_below: float) -> Mapping[str, str]:
    """How far out a row is, per detector; null where the detector has no opinion."""
    return {
        "zscore": "case when std_cost > 0"
        " then abs(cost_usd - mean_cost) / std_cost end",
        "mad": f"case when mad > 0"
        f" then {MODIFIED_Z_SCALE}D * abs(cost_usd - p50) / mad end",
        "ptiles": "greatest(cost_usd - p99, p01 - cost_usd, 0D)",
        "negative": f"case when cost_usd_increment < {negative_below}D"
        " then abs(cost_usd_increment) end",
    }


def _flags(negative_below: float) -> Mapping[str, str]:
    return {
        "zscore": f"score_zscore > {Z_LIMIT}D",
        "mad": f"score_mad > {MODIFIED_Z_LIMIT}D",
        "ptiles": "cost_usd < p01 or cost_usd > p99",
        "negative": f"cost_usd_increment < {negative_below}D",
    }


def score_against(
    events: DataFrame,
    profile: DataFrame,
    negative_below: float = NEGATIVE_COST,
    max_bytes: int = BROADCAST_BYTES,
    history: DataFrame | None = None,
) -> DataFrame:
    """Scores, flags and verdict of every event against a given profile.

    A row is an anomaly when two statistical detectors agree or its cost is negative
    on its own. A detector without an opinion counts as not flagged.
    """
    stats = profile.select("service", *PROFILE)
    scored = lookup_join(
        events, stats, "service", max_bytes, history
    ).withColumns(
        {f"score_{m}": F.expr(e) for m, e in _scores(negative_below).items()}
    )
    flagged = scored.withColumns(
        {
            f"flag_{m}": F.coalesce(F.expr(e), F.lit(False))
            for m, e in _flags(negative_below).items()
        }
    )
    votes = " + ".join(f"int(flag_{m})" for m in STATISTICAL)
    verdict = F.expr(f"flag_negative or {votes} >= {VOTES_NEEDED}")
    return flagged.withColumn("cost_anomaly_flag", verdict).drop(*PROFILE)


def flag_outliers(
    events: DataFrame,
    negative_below: float = NEGATIVE_COST,
    exact: bool = True,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Profile the events, then score each of them against it."""
    profile = service_profile(events, exact, small_rows)
    return score_against(events, profile, negative_below)


def flag_outside_band(
    events: DataFrame,
    negative_below: float = NEGATIVE_COST,
    band: DataFrame | None = None,
) -> DataFrame:
    """The simpler, earlier verdict: negative, or outside the percentile band.

    Null where nothing fires and a comparison is unknown.
    """
    if band is None:
        band = service_band(events)
    banded = lookup_join(events, band.select("service", "p01", "p99"), "service")
    verdict = F.expr(
        f"cost_usd_increment < {negative_below}D or cost_usd < p01 or cost_usd > p99"
    )
    return banded.withColumn("cost_anomaly_flag", verdict).drop("p01", "p99")
