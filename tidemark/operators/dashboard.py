"""Aggregates over the published snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import rules

EXPLORER_COLUMNS = [
    "customer_id", "contract_type", "internet_service", "payment_method", "monthly_charges", "tenure_months",
    "churn_probability", "risk_tier", "predicted_clv",
]


def kpi_row(snapshot: DataFrame) -> DataFrame:
    high = F.when(F.col("risk_tier") == "High", F.col("monthly_charges")).otherwise(0)
    return snapshot.agg(
        F.count("*").alias("customers"),
        F.coalesce(F.sum("monthly_charges"), F.lit(0)).alias("mrr"),
        F.avg(F.when(F.col("risk_tier") == "Low", 0).otherwise(1)).alias("share_not_low"),
        F.avg("churn_probability").alias("avg_churn_probability"),
        F.coalesce(F.sum(high), F.lit(0)).alias("revenue_at_risk"),
        F.avg("predicted_clv").alias("avg_predicted_clv"),
    )


def probability_by_contract(snapshot: DataFrame) -> DataFrame:
    return (
        snapshot.groupBy("contract_type")
        .agg(F.avg("churn_probability").alias("avg_churn_probability"))
        .orderBy(F.col("avg_churn_probability").desc(), "contract_type")
    )


def explore(
    snapshot: DataFrame,
    tiers: tuple[str, ...] = rules.RISK_TIERS[-1:],
    contracts: tuple[str, ...] | None = None,
    min_clv: float = 0,
) -> DataFrame:
    """Customers of the chosen tiers and contracts (None: all) with at least that value."""
    chosen = F.col("risk_tier").isin(*tiers) & (F.col("predicted_clv") >= min_clv)
    if contracts is not None:
        chosen = chosen & F.col("contract_type").isin(*contracts)
    return snapshot.where(chosen)


def explorer_rows(filtered: DataFrame) -> DataFrame:
    """The explorer's columns, highest probability first."""
    return filtered.select(*EXPLORER_COLUMNS).orderBy(F.col("churn_probability").desc(), "customer_id")


def explorer_footer(filtered: DataFrame) -> DataFrame:
    return filtered.agg(
        F.count("*").alias("customers"),
        F.coalesce(F.sum("monthly_charges"), F.lit(0)).alias("monthly_revenue"),
    )


def segment_summary(snapshot: DataFrame) -> DataFrame:
    """Size and means per segment, two decimals, half to even."""
    return (
        snapshot.groupBy("segment_label")
        .agg(
            F.count("customer_id").alias("customers"),
            rules.half_even(F.avg("predicted_clv"), 2).alias("avg_clv"),
            rules.half_even(F.avg("tenure_months"), 2).alias("avg_tenure"),
            rules.half_even(F.avg("churn_probability"), 2).alias("avg_churn_prob"),
        )
        .orderBy("segment_label")
    )


def filter_domains(snapshot: DataFrame) -> DataFrame:
    """Values offered by the explorer's filters: contract types, and the largest value in whole units."""
    per_contract = snapshot.groupBy("contract_type").agg(F.max("predicted_clv").alias("top"))
    contracts = per_contract.select(F.lit("contract_type").alias("filter"), F.col("contract_type").alias("value"))
    largest = per_contract.agg(F.max("top").cast("bigint").cast("string").alias("value"))
    return contracts.unionByName(largest.select(F.lit("max_predicted_clv").alias("filter"), "value"))
