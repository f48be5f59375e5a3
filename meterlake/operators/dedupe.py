"""Key deduplication for batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(
    df: DataFrame, keys: list[str], prefer: list[str] | None = None
) -> DataFrame:
    """Keep, per key, the row that is greatest in `prefer`, then in the other columns.

    Written as an aggregate over structs instead of a ranking window: map tasks
    already reduce a key to one candidate, so a key with very many copies never
    travels as a whole. Null keys count as one key. Nulls rank lowest.
    """
    lead = list(prefer or [])
    rest = [c for c in df.columns if c not in keys and c not in lead]
    ranked = lead + rest
    if not ranked:
        return df.distinct()
    best = F.max(F.struct(*ranked)).alias("_best")
    return (
        df.groupBy(*keys)
        .agg(best)
        .select(*keys, *[F.col("_best")[c].alias(c) for c in ranked])
        .select(*df.columns)
    )
