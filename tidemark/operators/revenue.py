"""Revenue metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import calendar


def mrr_by_month(subscriptions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Monthly recurring revenue on the first day of every month that has a transaction.

    A subscription counts on a first-of-month that lies within start and end, so one that starts
    inside a month counts from the next one. Each (first, last) month pair becomes a rise and a
    fall, and the revenue of a month is the running sum of both. That replaces the join of
    subscriptions with months: the data is aggregated once, and from there on every table is
    bounded by the calendar, which also bounds the one ordered window.
    """
    domain = transactions.groupBy(calendar.month_start("transaction_date").alias("month_date")).agg(
        F.lit(1).alias("in_domain")
    )
    spans = (
        subscriptions.select(
            calendar.first_month_on_or_after(F.col("start_date")).alias("rise"),
            F.add_months(calendar.month_start("end_date"), 1).alias("fall"),
            "monthly_charges",
        )
        .where(F.col("rise").isNotNull() & (F.col("fall").isNull() | (F.col("rise") < F.col("fall"))))
        .groupBy("rise", "fall")
        .agg(
            F.count("*").alias("n"),
            F.count("monthly_charges").alias("n_charges"),
            F.coalesce(F.sum("monthly_charges"), F.lit(0)).alias("charges"),
        )
    )
    sums = ("n", "n_charges", "charges")
    rises = F.struct(F.col("rise").alias("month_date"), *sums)
    falls = F.struct(F.col("fall").alias("month_date"), *[(-F.col(c)).alias(c) for c in sums])
    steps = spans.select(F.inline(F.array(rises, falls))).withColumn("in_domain", F.lit(0))
    marks = domain.select("month_date", *[F.lit(0).alias(c) for c in sums], "in_domain")
    per_month = (
        steps.unionByName(marks)
        .where(F.col("month_date").isNotNull())
        .groupBy("month_date")
        .agg(*[F.sum(c).alias(c) for c in sums], F.max("in_domain").alias("in_domain"))
    )
    so_far = Window.orderBy("month_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        per_month.withColumns({c: F.sum(c).over(so_far) for c in sums})
        .where((F.col("in_domain") == 1) & (F.col("n") > 0))
        .select(
            calendar.month_label("month_date").alias("month"),
            F.when(F.col("n_charges") > 0, F.col("charges")).alias("mrr"),
        )
        .orderBy("month")
    )


def customer_clv(customers: DataFrame, subscriptions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Realised lifetime value: paid charges, and refunds of any status (negative amounts).

    Transactions belong to the customer, so each of several subscriptions of one customer gets all
    of them, and subscriptions that agree in contract, tenure and state add up. Every side is
    aggregated to its grouping before the join, so no customer carries raw rows into it.
    """
    charge = (F.col("transaction_type") == "charge") & (F.col("status") == "paid")
    ledger = transactions.groupBy("customer_id").agg(
        F.sum(F.when(charge, F.col("amount")).otherwise(0)).alias("revenue"),
        F.sum(F.when(F.col("transaction_type") == "refund", F.col("amount")).otherwise(0)).alias("refunds"),
    )
    people = customers.groupBy("customer_id").agg(F.count("*").alias("n_people"))
    accounts = subscriptions.groupBy("customer_id", "contract_type", "tenure_months", "is_active").agg(
        F.count("*").alias("n_accounts")
    )
    copies = F.col("n_people") * F.col("n_accounts")
    return (
        people.join(ledger, "customer_id", "left")
        .join(accounts, "customer_id")
        .select(
            "customer_id", "contract_type", "tenure_months", "is_active",
            F.round(F.coalesce("revenue", F.lit(0)) * copies, 2).alias("lifetime_revenue"),
            F.round(F.coalesce("refunds", F.lit(0)) * copies, 2).alias("total_refunds"),
        )
    )


def revenue_at_risk(predictions: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Active subscriptions and their monthly charges per risk tier, both sides totalled per customer first."""
    active = (
        subscriptions.where(F.col("is_active") == 1)
        .groupBy("customer_id")
        .agg(F.count("*").alias("n_accounts"), F.sum("monthly_charges").alias("charges"))
    )
    tiers = predictions.groupBy("customer_id", "risk_tier").agg(F.count("*").alias("n_tiers"))
    return (
        tiers.join(active, "customer_id")
        .groupBy("risk_tier")
        .agg(
            F.sum(F.col("n_tiers") * F.col("n_accounts")).alias("customers"),
            F.round(F.sum(F.col("n_tiers") * F.col("charges")), 2).alias("monthly_revenue_at_risk"),
        )
    )
