"""The metric views under their names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidemark.operators import churn, revenue


def metric_views(tables: dict[str, DataFrame], predictions: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    """The ten metric views, not yet run."""
    customers, subscriptions = tables["customers"], tables["subscriptions"]
    transactions, events = tables["transactions"], tables["churn_events"]
    return {
        "vw_mrr_by_month": revenue.mrr_by_month(subscriptions, transactions),
        "vw_churn_rate_by_month": churn.churned_by_month(events),
        "vw_churn_rate_by_contract": churn.churn_rate_by(subscriptions, "contract_type"),
        "vw_churn_rate_by_internet": churn.churn_rate_by(subscriptions, "internet_service"),
        "vw_churn_rate_by_payment": churn.churn_rate_by(subscriptions, "payment_method"),
        "vw_tenure_buckets": churn.tenure_buckets(subscriptions),
        "vw_customer_clv": revenue.customer_clv(customers, subscriptions, transactions),
        "vw_cohort_retention": churn.cohort_lifetime(customers, subscriptions, events, as_of),
        "vw_revenue_at_risk": revenue.revenue_at_risk(predictions, subscriptions),
        "vw_tickets_vs_churn": churn.tickets_vs_churn(subscriptions, tables["support_tickets"]),
    }


def register_views(tables: dict[str, DataFrame], predictions: DataFrame, as_of: dt.date) -> list[str]:
    """Register the views in the session for use in SQL; returns their names."""
    views = metric_views(tables, predictions, as_of)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
