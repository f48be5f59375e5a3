"""Orderings with a limit, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame, group: str, order: list[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first `n` rows of each group in the given order, numbered from 1.

    Filtering on `row_number() <= n` lets Spark cut every group to `n` rows before
    the shuffle as well as after it, so a heavy group arrives already small.
    """
    position = F.row_number().over(W.partitionBy(group).orderBy(*order))
    return df.withColumn(rank, position).where(F.col(rank) <= n)


def busiest(
    df: DataFrame, group: str, measure: str, n: int = 1, total: str = "total"
) -> DataFrame:
    """Groups with the greatest sum of `measure`; equal sums go by group."""
    return (
        df.groupBy(group)
        .agg(F.sum(measure).alias(total))
        .orderBy(F.desc(total), F.asc(group))
        .limit(n)
    )
