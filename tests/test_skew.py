"""One customer owns a third of all rows: the joins that carry raw rows are split, and nothing is lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import churn, features, revenue

N = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "50",
}


@pytest.fixture(scope="module")
def small_thresholds(spark):
    """Adaptive execution reacts to kilobytes here as it does to hundreds of megabytes on a cluster."""
    former = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in former.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="module")
def hot(spark, star, small_thresholds):
    """Subscriptions, tickets and customers; customer 0 owns every third subscription and ticket."""
    owner = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    template = star.subscriptions.limit(1).drop("subscription_id", "customer_id").first().asDict()
    filled = [F.lit(v).cast(star.subscriptions.schema[n].dataType).alias(n) for n, v in template.items()]
    subscriptions = spark.range(0, N, 1, 16).select(
        F.col("id").alias("subscription_id"), owner.alias("customer_id"), *filled
    ).withColumn("payment_method", F.md5(F.col("subscription_id").cast("string")))
    tickets = spark.range(0, N, 1, 16).select(
        F.col("id").alias("ticket_id"), owner.alias("customer_id"), (F.col("id") % 5 + 1).cast("int").alias("satisfaction_score")
    )
    customers = spark.range(0, N, 1, 16).select(
        F.col("id").alias("customer_id"), F.lit("Male").alias("gender"),
        *[F.lit(0).alias(c) for c in ("senior_citizen", "partner", "dependents")],
    )
    return customers, subscriptions, tickets


def test_feature_table_splits_the_hot_customer(hot):
    table = features.feature_table(*hot).select("customer_id", "payment_method", "ticket_count")
    rows = table.collect()
    assert len(rows) == len({r.payment_method for r in rows}) == N
    assert {r.ticket_count for r in rows if r.customer_id == 0} == {N // 3}
    assert sum(r.customer_id == 0 for r in rows) == N // 3
    assert {r.ticket_count for r in rows if r.customer_id != 0} == {1}
    assert "skew=true" in table._jdf.queryExecution().toString()


def test_totals_meet_the_hot_customer_once(hot):
    customers, subscriptions, tickets = hot
    row = churn.tickets_vs_churn(subscriptions, tickets).first()
    # Every one of the hot customer's subscriptions meets every one of its tickets: 20,000 x 20,000.
    pairs = (N // 3) ** 2 + (N - N // 3)
    assert row.customers == 1 + N - N // 3
    assert row.avg_tickets_per_customer == round(pairs / row.customers, 2)

    transactions = tickets.select(
        "customer_id", F.lit(1).cast("decimal(12,2)").alias("amount"),
        F.lit("charge").alias("transaction_type"), F.lit("paid").alias("status"),
    )
    clv = revenue.customer_clv(customers, subscriptions, transactions)
    assert clv.where("customer_id = 0").first().lifetime_revenue == (N // 3) ** 2
    assert clv.count() == 1 + N - N // 3
