"""Churn metrics by month, segment, tenure, cohort and ticket load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import calendar, rules


def _churn_counts() -> list[Column]:
    churned = F.sum(1 - F.col("is_active"))
    return [
        F.count("*").alias("total_customers"),
        churned.alias("churned_customers"),
        rules.percentage(churned, F.count("*")).alias("churn_rate_pct"),
    ]


def churned_by_month(churn_events: DataFrame) -> DataFrame:
    """Churn events per calendar month: a count, not a rate."""
    return (
        churn_events.groupBy(calendar.month_label("churn_date").alias("month"))
        .agg(F.count("*").alias("churned_customers"))
        .orderBy("month")
    )


def churn_rate_by(subscriptions: DataFrame, column: str) -> DataFrame:
    """Subscriptions, ended subscriptions and their share per value of `column`."""
    return subscriptions.groupBy(column).agg(*_churn_counts())


def tenure_buckets(subscriptions: DataFrame) -> DataFrame:
    """Churn and mean charge per tenure bucket, shortest tenure first."""
    return (
        subscriptions.groupBy(rules.tenure_bucket("tenure_months").alias("tenure_bucket"))
        .agg(
            *_churn_counts(),
            F.round(F.avg("monthly_charges"), 2).alias("avg_monthly_charges"),
            F.min("tenure_months").alias("_shortest"),
        )
        .orderBy("_shortest")
        .drop("_shortest")
    )


def cohort_lifetime(
    customers: DataFrame, subscriptions: DataFrame, churn_events: DataFrame, as_of: dt.date
) -> DataFrame:
    """Histogram of lifetimes by signup month, in completed months until churn or `as_of`.

    `customers_active_at_month` counts the lives that ended, or were cut by `as_of`, at that many
    months; it is not cumulative. A customer counts once per subscription and churn event. All
    sides are counted per customer before the join.
    """
    people = customers.groupBy("customer_id", "signup_date").agg(F.count("*").alias("n_people"))
    accounts = subscriptions.groupBy("customer_id").agg(F.count("*").alias("n_accounts"))
    ends = churn_events.groupBy("customer_id", "churn_date").agg(F.count("*").alias("n_ends"))
    lived = calendar.whole_months(F.col("signup_date"), F.coalesce("churn_date", F.lit(as_of)))
    lives = F.col("n_people") * F.col("n_accounts") * F.coalesce("n_ends", F.lit(1))
    return (
        people.join(accounts, "customer_id")
        .join(ends, "customer_id", "left")
        .groupBy(calendar.month_label("signup_date").alias("cohort_month"), lived.alias("months_since_signup"))
        .agg(F.sum(lives).alias("customers_active_at_month"))
        .orderBy("cohort_month", "months_since_signup")
    )


def tickets_vs_churn(subscriptions: DataFrame, tickets: DataFrame) -> DataFrame:
    """Customers, tickets per customer and mean satisfaction, for ended and active subscriptions.

    Tickets are totalled per customer before the join; means ignore missing scores.
    """
    load = tickets.groupBy("customer_id").agg(
        F.count("ticket_id").alias("n_tickets"),
        F.sum("satisfaction_score").alias("score"),
        F.count("satisfaction_score").alias("n_scores"),
    )
    accounts = subscriptions.groupBy("customer_id", "is_active").agg(F.count("*").alias("n"))
    customers = F.count("customer_id")

    def pairs(per_customer: str) -> Column:
        """Sum over pairs of subscription and ticket; as doubles, for one customer may own very many of both."""
        return F.sum(F.col("n").cast("double") * F.coalesce(per_customer, F.lit(0)).cast("double"))

    return (
        accounts.join(load, "customer_id", "left")
        .groupBy("is_active")
        .agg(
            customers.alias("customers"),
            F.round(F.try_divide(pairs("n_tickets"), customers), 2).alias("avg_tickets_per_customer"),
            F.round(F.try_divide(pairs("score"), pairs("n_scores")), 2).alias("avg_satisfaction"),
        )
    )
