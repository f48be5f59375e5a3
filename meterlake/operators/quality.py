"""Row quality: named rules, the clean/quarantine split and its accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Reason names, and what makes a row fall under each, by precedence.
# A negative cost is not here: such rows stay and are flagged as outliers.
REJECT_RULES = {
    "event_id_null": "event_id is null",
    "unit_missing_with_value": "value is not null and unit is null",
}
# For events read as text: cells present in the source but not of their type.
MALFORMED_RULE = {"malformed_value": "size(malformed_fields) > 0"}
REASON = "dq_rule"


def tag_quality(df: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """Add the reason a row is rejected for (null when it is fine).

    The first rule that holds names the reason. Rules about malformed cells apply
    when the source kept track of them.
    """
    if rules is None:
        rules = dict(REJECT_RULES)
        if "malformed_fields" in df.columns:
            rules |= MALFORMED_RULE
    verdicts = [F.when(F.expr(test), F.lit(name)) for name, test in rules.items()]
    return df.withColumn(REASON, F.coalesce(*verdicts))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def split_quality(
    df: DataFrame, rules: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine); the reason column stays on the quarantine side only."""
    tagged = tag_quality(df, rules)
    return accepted(tagged), rejected(tagged)


def reason_breakdown(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy(REASON).agg(F.count("*").alias("rows"))


def reject_samples(quarantine: DataFrame, n: int = 5) -> DataFrame:
    """A few rejected rows with the columns the rules look at, in a stable order."""
    shown = ["event_id", "service", "metric", "value", "unit", REASON]
    return quarantine.select(*shown).orderBy(REASON, *shown[:-1]).limit(n)


def conservation(bronze: DataFrame, clean: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row: are all bronze rows accounted for by the two sides of the split?"""
    counts = [
        side.agg(F.count("*").alias("n")).withColumn("side", F.lit(name))
        for name, side in (("b", bronze), ("c", clean), ("q", quarantine))
    ]

    def of(name: str):
        return F.sum(F.when(F.col("side") == name, F.col("n")))

    return (
        counts[0]
        .unionByName(counts[1])
        .unionByName(counts[2])
        .agg(
            of("b").alias("bronze_rows"),
            of("c").alias("clean_rows"),
            of("q").alias("quarantine_rows"),
        )
        .withColumn(
            "conserved",
            F.expr("bronze_rows = clean_rows + quarantine_rows"),
        )
    )
