"""Customer feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.schemas import ADD_ONS

# Model columns in model order, and the stand-in for unknown satisfaction.
CATEGORICAL = [
    "gender", "contract_type", "payment_method", "internet_service", "multiple_lines", *ADD_ONS,
]
NUMERIC = [
    "senior_citizen", "partner", "dependents", "paperless_billing", "phone_service",
    "monthly_charges", "tenure_months", "ticket_count", "avg_satisfaction",
]
NUMERIC_NO_TENURE = [c for c in NUMERIC if c != "tenure_months"]
NEUTRAL_SATISFACTION = 3.0


def feature_table(customers: DataFrame, subscriptions: DataFrame, tickets: DataFrame) -> DataFrame:
    """One row per subscription with customer attributes, ticket load and the 0/1 churn label.

    Tickets are totalled per customer and joined to the customers first, so that the wide table
    of subscriptions meets a single join whose other side has one row per customer. Adaptive
    execution splits a customer who owns a large share of the subscriptions, but only in a join
    where both sides come straight from a shuffle. The second join key sees to that: the customer
    side, already partitioned by customer, is shuffled by both keys.
    """
    load = tickets.groupBy("customer_id").agg(
        F.count("*").alias("ticket_count"), F.avg("satisfaction_score").alias("avg_satisfaction")
    )
    people = customers.select("customer_id", "gender", "senior_citizen", "partner", "dependents").join(
        load, "customer_id", "left"
    )
    both_keys = {"_hash": F.hash("customer_id")}
    joined = subscriptions.withColumns(both_keys).join(people.withColumns(both_keys), ["customer_id", "_hash"])
    return joined.select(
        "customer_id", "gender", "senior_citizen", "partner", "dependents",
        "contract_type", "payment_method", "paperless_billing", "internet_service",
        "phone_service", "multiple_lines", *ADD_ONS,
        "monthly_charges", "tenure_months", "is_active",
        F.coalesce("ticket_count", F.lit(0)).cast("bigint").alias("ticket_count"),
        F.coalesce("avg_satisfaction", F.lit(NEUTRAL_SATISFACTION)).alias("avg_satisfaction"),
        (1 - F.col("is_active")).alias("churned"),
    )


def overall_churn_rate(features: DataFrame) -> DataFrame:
    """Mean of the churn label, as a percentage with one decimal, and the row count."""
    return features.agg(
        F.count("*").alias("n_rows"), F.round(F.avg("churned") * 100, 1).alias("churn_rate_pct")
    )
