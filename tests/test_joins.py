"""The shuffle join with spread keys must equal a plain one."""

import pytest
from pyspark.sql import functions as F

from meterlake.operators.joins import (
    heavy_keys,
    lookup_join,
    measured_bytes,
    spread_join,
)


@pytest.fixture
def facts(spark):
    # key 1 holds a third of the rows, a tenth have no key, 900+ are not in the lookup
    key = F.expr(
        "case when id % 3 = 0 then 1 when id % 10 = 1 then null else id % 1000 end"
    )
    return spark.range(6000).select("id", key.alias("k"), F.lit("same").alias("copy"))


@pytest.fixture
def lookup(spark):
    return spark.range(900).select(
        F.col("id").alias("k"), F.concat(F.lit("name "), "id").alias("name")
    )


def test_equal_to_plain_join(facts, lookup):
    plain = facts.join(lookup, "k", "left").select("id", "k", "copy", "name")
    spread = spread_join(facts, lookup, ["k"]).select(*plain.columns)
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    assert spread.count() == 6000


def test_size_decides(facts, lookup):
    small = lookup_join(facts, lookup, "k")._jdf.queryExecution().toString()
    large = lookup_join(facts, lookup, "k", max_bytes=10)._jdf.queryExecution().toString()
    assert "_lane" not in small and "strategy=broadcast" in small
    assert "_lane" in large


def test_heavy_keys_are_few_and_get_lanes(facts):
    heavy = {r.k: r._lanes for r in heavy_keys(facts, ["k"], 16).collect()}
    assert heavy == {1: 6}  # 2000 of 5400 keyed rows, at 337.5 per lane


def test_lanes_level_the_partitions(spark, facts, lookup):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = spread_join(facts, lookup.where("k > 10000"), ["k"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 6000 / 5
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_measured_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "a bigint, b string")
    assert measured_bytes(df) == 2 * (16 + 8 + 8) + 3
    assert measured_bytes(df.limit(0)) == 0


def test_two_keys(facts, lookup):
    wide = lookup.withColumn("copy", F.lit("same"))
    joined = lookup_join(facts, wide, ["k", "copy"], max_bytes=0)
    assert joined.where("name is not null").count() == (
        facts.join(lookup, "k", "left_semi").count()
    )


def test_stream_needs_history(spark, lookup):
    stream = spark.readStream.format("rate").load().withColumnRenamed("value", "k")
    with pytest.raises(ValueError, match="history"):
        lookup_join(stream, lookup, "k", max_bytes=0)
