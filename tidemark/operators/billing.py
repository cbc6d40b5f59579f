"""Billing schedule and churn events of subscriptions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import calendar


def billing_schedule(subscriptions: DataFrame) -> DataFrame:
    """One row per subscription and 30-day period, from the start date for `tenure_months` periods."""
    return (
        subscriptions.where(F.col("tenure_months") > 0)
        .select(
            "subscription_id", "customer_id", "start_date", "monthly_charges",
            F.explode(F.sequence(F.lit(0), F.col("tenure_months") - 1)).alias("period"),
        )
        .select(
            "subscription_id", "customer_id", "period",
            calendar.plus_periods(F.col("start_date"), F.col("period")).alias("billing_date"),
            "monthly_charges",
        )
    )


def capped_tenure(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Limit `tenure_months` to the 30-day periods elapsed since the start, one at least, and derive the end.

    `scheduled_end` is where that many periods run out, at the latest the day before `as_of`.
    """
    today = F.lit(as_of)
    elapsed = F.greatest(calendar.periods_of_30_days(F.col("start_date"), today), F.lit(1))
    tenure = F.least(F.col("tenure_months"), elapsed)
    scheduled = F.least(calendar.plus_periods(F.col("start_date"), tenure), F.date_sub(today, 1))
    return subscriptions.withColumns({"scheduled_end": scheduled, "tenure_months": tenure})


def churn_events_extract(subscriptions: DataFrame, reason: Column | None = None) -> DataFrame:
    """Ended subscriptions as churn events; the subscription number serves as the event key."""
    return subscriptions.where(F.col("is_active") == 0).select(
        F.col("subscription_id").alias("churn_id"),
        "customer_id",
        F.col("end_date").alias("churn_date"),
        F.lit(1).alias("churn_flag"),
        (F.lit(None).cast("string") if reason is None else reason).alias("churn_reason"),
    )
