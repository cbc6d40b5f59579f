from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators import billing, churn, dashboard, features, revenue


def d(text):
    return dt.date.fromisoformat(text) if text else None


SUBS = "subscription_id bigint, customer_id bigint, contract_type string, monthly_charges decimal(10,2), " \
       "tenure_months int, start_date date, end_date date, is_active int"


def subs(spark, *rows):
    return spark.createDataFrame(
        [(i, c, k, None if m is None else Decimal(m), t, d(s), d(e), a) for i, c, k, m, t, s, e, a in rows], SUBS
    )


def transactions(spark, *rows):
    return spark.createDataFrame(
        [(c, d(day), Decimal(amount), kind, status) for c, day, amount, kind, status in rows],
        "customer_id bigint, transaction_date date, amount decimal(12,2), transaction_type string, status string",
    )


def month_marks(spark, *days):
    return transactions(spark, *[(1, day, "1", "charge", "paid") for day in days])


def test_mrr_eligibility(spark):
    s = subs(
        spark,
        (1, 1, "A", "10", 1, "2024-01-01", None, 1),          # from its first day on
        (2, 2, "A", "20", 1, "2024-01-15", None, 1),          # from February on
        (3, 3, "A", "40", 1, "2024-01-10", "2024-01-20", 0),  # never on a first-of-month
        (4, 4, "A", "80", 1, "2023-12-05", "2024-02-01", 0),  # January and February
    )
    marks = month_marks(spark, "2023-11-30", "2024-01-31", "2024-02-02", "2024-04-09", "2024-04-10")
    got = [tuple(r) for r in revenue.mrr_by_month(s, marks).collect()]
    assert got == [
        ("2024-01-01", Decimal("90.00")), ("2024-02-01", Decimal("110.00")), ("2024-04-01", Decimal("30.00")),
    ]


def test_mrr_without_known_charges_is_null(spark):
    s = subs(spark, (1, 1, "A", None, 1, "2024-01-01", None, 1))
    assert [tuple(r) for r in revenue.mrr_by_month(s, month_marks(spark, "2024-01-05")).collect()] == [
        ("2024-01-01", None)
    ]


def test_mrr_equals_the_range_join(spark):
    rng = random.Random(5)
    base = dt.date(2020, 1, 1)
    rows = []
    for i in range(300):
        start = base + dt.timedelta(days=rng.randrange(900))
        end = start + dt.timedelta(days=rng.randrange(400)) if rng.random() < 0.6 else None
        rows.append((i, i, "A", str(rng.randrange(100, 9999) / 100), 1, start.isoformat(), end and end.isoformat(), 1))
    s = subs(spark, *rows)
    t = month_marks(spark, *[(base + dt.timedelta(days=rng.randrange(1500))).isoformat() for _ in range(30)])
    months = t.select(F.trunc("transaction_date", "MM").alias("m")).distinct()
    theta = (
        s.join(months, (F.col("start_date") <= F.col("m")) & (F.col("end_date").isNull() | (F.col("end_date") >= F.col("m"))))
        .groupBy(F.date_format("m", "yyyy-MM-dd").alias("month"))
        .agg(F.sum("monthly_charges").alias("mrr"))
        .orderBy("month")
    )
    assert [tuple(r) for r in revenue.mrr_by_month(s, t).collect()] == [tuple(r) for r in theta.collect()]


def test_clv_doubles_for_equal_subscriptions(spark):
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id bigint")
    s = subs(
        spark,
        (1, 1, "A", "10", 5, "2024-01-01", None, 1),
        (2, 1, "A", "10", 5, "2024-01-01", None, 1),
        (3, 1, "B", "10", 5, "2024-01-01", None, 1),
        (4, 2, "A", "10", 5, "2024-01-01", None, 1),
        (5, 99, "A", "10", 5, "2024-01-01", None, 1),
    )
    t = transactions(
        spark,
        (1, "2024-01-01", "100.25", "charge", "paid"),
        (1, "2024-01-01", "50", "charge", "failed"),
        (1, "2024-01-01", "-7.5", "refund", "pending"),
        (1, "2024-01-01", "-9", "credit", "paid"),
    )
    got = {(r.customer_id, r.contract_type): (r.lifetime_revenue, r.total_refunds)
           for r in revenue.customer_clv(customers, s, t).collect()}
    assert got == {
        (1, "A"): (Decimal("200.50"), Decimal("-15.00")),
        (1, "B"): (Decimal("100.25"), Decimal("-7.50")),
        (2, "A"): (Decimal("0.00"), Decimal("0.00")),
    }


def test_hot_customer_with_a_third_of_all_rows(spark):
    n = 30_000
    t = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("customer_id"),
        F.lit(1).cast("decimal(12,2)").alias("amount"),
        F.lit("charge").alias("transaction_type"), F.lit("paid").alias("status"),
    )
    customers = spark.range(n).select(F.col("id").alias("customer_id"))
    s = customers.select(
        "customer_id", F.lit("A").alias("contract_type"), F.lit(1).alias("tenure_months"), F.lit(1).alias("is_active")
    )
    clv = revenue.customer_clv(customers, s, t)
    assert clv.count() == n
    assert clv.where("customer_id = 0").first().lifetime_revenue == n // 3
    assert clv.agg(F.sum("lifetime_revenue")).first()[0] == n


def test_risk_counts_every_pair_of_prediction_and_subscription(spark):
    s = subs(
        spark,
        (1, 1, "A", "10", 5, "2024-01-01", None, 1),
        (2, 1, "A", "5.5", 5, "2024-01-01", None, 1),
        (3, 2, "A", "7", 5, "2024-01-01", "2024-02-01", 0),
    )
    predictions = spark.createDataFrame([(1, "High"), (1, "High"), (1, "Low"), (2, "High")], "customer_id bigint, risk_tier string")
    got = {r.risk_tier: tuple(r)[1:] for r in revenue.revenue_at_risk(predictions, s).collect()}
    assert got == {"High": (4, Decimal("31.00")), "Low": (2, Decimal("15.50"))}


def test_tickets_count_per_subscription(spark):
    s = subs(
        spark,
        (1, 1, "A", "10", 5, "2024-01-01", None, 1),
        (2, 1, "A", "10", 5, "2024-01-01", None, 1),
        (3, 2, "A", "10", 5, "2024-01-01", None, 1),
        (4, 3, "A", "10", 5, "2024-01-01", "2024-02-01", 0),
    )
    tickets = spark.createDataFrame(
        [(1, 1, 5), (2, 1, None), (3, 2, 2)], "ticket_id bigint, customer_id bigint, satisfaction_score int"
    )
    got = {r.is_active: tuple(r)[1:] for r in churn.tickets_vs_churn(s, tickets).collect()}
    assert got == {1: (2, 2.5, 4.0), 0: (1, 0.0, None)}


def test_cohort_multiplicity(spark):
    customers = spark.createDataFrame([(1, d("2024-01-31")), (2, d("2024-01-05"))], "customer_id bigint, signup_date date")
    s = spark.createDataFrame([(1,), (1,), (2,)], "customer_id bigint")
    events = spark.createDataFrame([(1, d("2024-02-29"))], "customer_id bigint, churn_date date")
    got = [tuple(r) for r in churn.cohort_lifetime(customers, s, events, d("2024-04-01")).collect()]
    assert got == [("2024-01-01", 0, 2), ("2024-01-01", 2, 1)]


def test_empty_inputs(spark):
    s = subs(spark)
    assert churn.churn_rate_by(s, "contract_type").count() == 0
    assert churn.tenure_buckets(s).count() == 0
    assert revenue.mrr_by_month(s, transactions(spark)).count() == 0


def test_tenure_bucket_order_and_null_tenure(spark):
    rows = [(i, i, "A", "10", t, "2024-01-01", None, 1) for i, t in enumerate([50, 3, None, 10])]
    got = [(r.tenure_bucket, r.total_customers) for r in churn.tenure_buckets(subs(spark, *rows)).collect()]
    assert got == [("0-6 mo", 1), ("7-12 mo", 1), ("48+ mo", 2)]


def test_features_without_scores_get_three(star, spark):
    s = star.subscriptions.where("subscription_id < 3")
    tickets = spark.createDataFrame(
        [(0, None), (0, None), (1, 4)], "customer_id bigint, satisfaction_score int"
    )
    got = {r.customer_id: (r.ticket_count, r.avg_satisfaction)
           for r in features.feature_table(star.customers, s, tickets).collect()}
    assert got == {0: (2, 3.0), 1: (1, 4.0), 2: (0, 3.0)}


def test_billing_and_capped_tenure(spark):
    s = subs(
        spark,
        (1, 1, "A", "10", 3, "2024-01-01", None, 1),
        (2, 2, "A", "10", 0, "2024-01-01", None, 1),
        (3, 3, "A", "10", 9, "2024-01-10", "2024-01-20", 0),
    )
    days = [str(r.billing_date) for r in billing.billing_schedule(s).where("subscription_id = 1").orderBy("period").collect()]
    assert days == ["2024-01-01", "2024-01-31", "2024-03-01"]
    assert billing.billing_schedule(s).where("subscription_id = 2").count() == 0
    capped = {r.subscription_id: (r.tenure_months, str(r.scheduled_end))
              for r in billing.capped_tenure(s, d("2024-02-15")).collect()}
    assert capped == {1: (1, "2024-01-31"), 2: (0, "2024-01-01"), 3: (1, "2024-02-09")}
    assert [tuple(r) for r in billing.churn_events_extract(s).collect()] == [(3, 3, d("2024-01-20"), 1, None)]


def test_explorer_filters(spark):
    rows = [
        (i, "A" if i % 2 else "B", "DSL", "Mailed check", Decimal("10"), 5, 0, p, t, float(v), 0, "x")
        for i, (p, t, v) in enumerate([(0.9, "High", 10), (0.7, "High", 90), (0.4, "Medium", 50), (0.1, "Low", 70)])
    ]
    snap = spark.createDataFrame(
        rows,
        "customer_id bigint, contract_type string, internet_service string, payment_method string, "
        "monthly_charges decimal(10,2), tenure_months int, ticket_count bigint, churn_probability double, "
        "risk_tier string, predicted_clv double, segment_cluster int, segment_label string",
    )
    assert [r.customer_id for r in dashboard.explorer_rows(dashboard.explore(snap)).collect()] == [0, 1]
    assert [r.customer_id for r in dashboard.explore(snap, ("High", "Medium"), ("B",), 20).collect()] == [2]
    footer = dashboard.explorer_footer(dashboard.explore(snap, (), None)).first()
    assert tuple(footer) == (0, Decimal("0.00"))
    assert dashboard.kpi_row(snap).first().share_not_low == 0.75
