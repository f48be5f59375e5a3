"""Exact quantiles against brute force, on the direct and on the narrowing path."""

import math
import random

import pytest
from pyspark.sql import functions as F

from meterlake.operators.quantiles import exact_quantiles

PROBS = {"p01": 0.01, "p50": 0.5, "p99": 0.99}


def brute(values, p):
    rank = max(1, len(values) - math.floor(len(values) - p * len(values)))
    return sorted(values)[rank - 1]


def check(spark, data, small_rows):
    rows = [(g, x) for g, xs in data.items() for x in xs]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    got = exact_quantiles(df, "g", "x", PROBS, [F.count("*").alias("n")], small_rows)
    for row in got.collect():
        kept = [x for x in data[row.g] if x is not None and not math.isnan(x)]
        assert row.n_values == len(kept) and row.n == len(data[row.g])
        for name, p in PROBS.items():
            assert row[name] == (brute(kept, p) if kept else None), (row.g, name)
    assert got.count() == len(data)


def make_data():
    r = random.Random(11)
    return {
        # a third of the rows, two thirds of them one value
        "heavy": [0.0] * 6000 + [r.lognormvariate(0, 3) for _ in range(3000)],
        "halves": [1.0] * 500 + [2.0] * 500,
        "constant": [4.25] * 700,
        "spread": [r.uniform(-1e6, 1e6) for _ in range(8000)],
        "single": [3.5],
        "pair": [2.0, -1.0],
        "holes": [None, float("nan"), 5.0, None, 6.0],
        "empty": [None, None],
    }


@pytest.mark.parametrize("small_rows", [10**6, 2000, 5])
def test_against_brute_force(spark, small_rows):
    check(spark, make_data(), small_rows)


@pytest.mark.parametrize("small_rows", [100, 0])
def test_null_group_is_counted(spark, small_rows):
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "g string, x double")
    got = exact_quantiles(df, "g", "x", {"p50": 0.5}, small_rows=small_rows)
    rows = {r.g: r for r in got.collect()}
    assert rows["a"].p50 == 2.0 and rows[None].n_values == 1
    assert rows[None].p50 is None


def test_a_bad_bracket_is_noticed(spark, monkeypatch):
    """Counts, not the sketch, decide: brackets off the mark only cost more levels."""
    from meterlake.operators import quantiles

    honest = quantiles._brackets
    calls = []

    def misleading(rows, wanted, keys):
        calls.append(1)
        found = honest(rows, wanted, keys)
        if len(calls) > 2:
            return found
        # first all brackets too high, then all too low
        shift = F.lit(1e3 if len(calls) == 1 else -1e3)
        return found.withColumns(
            {"_low": F.col("_low") + shift, "_high": F.col("_high") + shift}
        )

    monkeypatch.setattr(quantiles, "_brackets", misleading)
    r = random.Random(3)
    data = {"a": [r.gauss(0, 10) for _ in range(4000)], "b": [7.0] * 900}
    check(spark, data, 5)
    assert len(calls) > 2
