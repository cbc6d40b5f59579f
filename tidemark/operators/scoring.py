"""Scores, the prediction table and the published snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tidemark.functions import rules
from tidemark.operators.explain import LOGIT, additive_contributions
from tidemark.operators.models import with_probability

MODEL_VERSION = "v1.0"
# Columns of the published snapshot.
SNAPSHOT_COLUMNS = [
    "customer_id", "contract_type", "internet_service", "payment_method", "monthly_charges", "tenure_months",
    "ticket_count", "churn_probability", "risk_tier", "predicted_clv", "segment_cluster",
]


def with_risk(rows: DataFrame, probability: str = "churn_probability") -> DataFrame:
    """Round the probability to five decimals, half to even, and take the tier from the rounded value."""
    return rows.withColumn(probability, rules.half_even(probability, 5)).withColumn(
        "risk_tier", rules.risk_tier(probability)
    )


def score_customers(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Probability and tier for all rows, those the model was trained on included."""
    return with_risk(with_probability(model, rows))


def prediction_table(scored: DataFrame, scored_at: dt.datetime, model_version: str = MODEL_VERSION) -> DataFrame:
    """Rows of the published prediction table."""
    return scored.select(
        "customer_id",
        F.col("churn_probability").cast("decimal(6,5)").alias("churn_probability"),
        "risk_tier",
        F.col("predicted_clv").cast("decimal(12,2)").alias("predicted_clv"),
        F.col("segment_cluster").cast("int").alias("segment_cluster"),
        F.lit(model_version).alias("model_version"),
        # As text, so that the session's time zone reads it back as the same wall clock.
        F.lit(f"{scored_at:%Y-%m-%d %H:%M:%S}").cast("timestamp").alias("scored_at"),
    )


def snapshot(scored: DataFrame) -> DataFrame:
    """Columns of the published snapshot; the label follows from the segment number."""
    return scored.select(*SNAPSHOT_COLUMNS, rules.segment_label("segment_cluster").alias("segment_label"))


def risk_total(scored: DataFrame) -> DataFrame:
    """Monthly charges of all high-risk rows, active or not."""
    high = F.when(F.col("risk_tier") == "High", F.col("monthly_charges"))
    return scored.agg(F.coalesce(F.sum(high), F.lit(0)).alias("monthly_revenue_at_risk"))


def tier_counts(scored: DataFrame) -> DataFrame:
    """Customers per tier in the fixed order of tiers; NULL for a tier that does not occur."""
    tiers = scored.sparkSession.createDataFrame(list(enumerate(rules.RISK_TIERS)), "_position int, risk_tier string")
    counts = scored.groupBy("risk_tier").agg(F.count("*").alias("customers"))
    return tiers.join(counts, "risk_tier", "left").orderBy("_position").select("risk_tier", "customers")


def score_profiles(
    model: PipelineModel, profiles: DataFrame, background: DataFrame, key: str = "profile_id"
) -> tuple[DataFrame, DataFrame]:
    """What-if scoring of any frame of profiles: (probability and tier, contributions in long form).

    Here the tier comes from the unrounded probability. `base_value` plus the contributions of a profile is its score on
    the scale named in `score_scale`: the logit of the probability, or for a forest the probability. `base_logit` is the
    base where the scale is the logit, else NULL.
    """
    contributions, base, scale = additive_contributions(model, profiles, background, key)
    scored = with_probability(model, profiles).withColumns({
        "risk_tier": rules.risk_tier("churn_probability"),
        "base_logit": F.lit(base if scale == LOGIT else None).cast("double"),
        "base_value": F.lit(base).cast("double"),
        "score_scale": F.lit(scale),
    })
    return scored, contributions
