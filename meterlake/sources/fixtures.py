"""The driver's test tables seen as usage, organisation, ticket and billing data.

The tables are clean, so defects are injected by arithmetic on keys: every row is
decided by its own values and the same rules can be stated in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION_2_START = "timestamp_ntz '2024-01-16 00:00:00'"
GENAI_SERVICE = "signup"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage events, with null ids, missing units, negative costs, unknown orgs."""
    v2 = f"ts >= {VERSION_2_START}"
    return table(spark, sf_dir, "events").selectExpr(
        "case when event_id % 211 <> 0 then event_id end as event_id",
        "ts as timestamp",
        "user_id + case when user_id % 29 = 0 then 1000000 else 0 end as org_id",
        "event_type as service",
        "case when event_id % 3 = 0 then 'requests' else 'cpu_hours' end as metric",
        "case when event_id % 17 <> 0 then value end as value",
        "case when event_id % 23 <> 0 then 'count' end as unit",
        "case when event_id % 191 = 0 then -value else value end"
        " as cost_usd_increment",
        f"case when {v2} then 2 else 1 end as schema_version",
        f"case when {v2} then value / 100 end as carbon_kg",
        f"case when {v2} and event_type = '{GENAI_SERVICE}'"
        " then cast(get_json_object(props, '$.k') as bigint) end as genai_tokens",
    )


def org(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisations: a customer with its nation, region and market segment."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name"
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nation, "c_nationkey", "left")
        .join(region, "n_regionkey", "left")
        .select(
            F.col("c_custkey").alias("org_id"),
            F.col("c_name").alias("org_name"),
            F.col("n_name").alias("industry"),
            F.col("r_name").alias("hq_region"),
            F.col("c_mktsegment").alias("plan_tier"),
        )
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as ticket_id",
        "o_custkey as org_id",
        "case o_orderpriority when '1-URGENT' then 'critical' when '2-HIGH'"
        " then 'high' when '3-MEDIUM' then 'medium' else 'low' end as severity",
        "cast(o_orderdate as date) as created_at",
        "case when o_orderkey % 4 <> 0 then cast(o_orderkey % 5 + 1 as double) end"
        " as csat",
        "case o_orderstatus when 'F' then true when 'O' then false end"
        " as sla_breached",
    )


def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as invoice_id",
        "o_custkey as org_id",
        "cast(date_trunc('month', o_orderdate) as date) as month",
        "o_totalprice as subtotal",
        "case when o_orderkey % 7 = 0 then o_totalprice * 0.1D end as credits",
        "case when o_orderkey % 11 <> 0 then o_totalprice * 0.21D end as taxes",
        "case o_orderkey % 3 when 0 then 'ARS' when 1 then 'EUR' else 'USD' end"
        " as currency",
        "case o_orderkey % 3 when 0 then 0.0016D when 1 then 1.08D else 1.0D end"
        " as exchange_rate_to_usd",
    )
