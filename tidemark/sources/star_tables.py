"""The domain tables, derived from a star schema of customers, orders, line items and events.

FIXTURES.md describes the mapping. Customer keys are BIGINT here.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import calendar, hashing, rules
from tidemark.operators.billing import churn_events_extract

# Fixed values of the mapping.
AS_OF = dt.date(2001, 8, 1)
CHURN_CUTOFF = dt.date(2000, 10, 1)
PAYMENT_METHODS = ("Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)")
INTERNET_SERVICES = ("DSL", "Fiber optic", "No")
TICKET_CATEGORIES = ("billing", "technical", "cancellation", "general")
TICKET_PRIORITIES = ("low", "medium", "high")
CHURN_REASONS = ("Price", "Better offer", "Service quality", "Moved", "Other")
ADD_ON_YES = {
    "online_security": (13, 4),
    "online_backup": (17, 6),
    "device_protection": (19, 6),
    "tech_support": (23, 7),
    "streaming_tv": (29, 11),
    "streaming_movies": (31, 12),
}
# Tenure runs longer here than in telephone data, so its weight is smaller.
SCORECARD_WEIGHTS = {"tenure_months": -0.02}


def _pick(number: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


# Columns in use; declared, so that no job has to read them from the files first.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


class StarTables:
    """Domain tables over one folder of star-schema Parquet files; every property is lazy.

    A customer without orders has a subscription and no dates: signup_date and start_date are NULL.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @property
    def _life(self) -> DataFrame:
        return self._read("orders").groupBy("o_custkey").agg(
            F.min("o_orderdate").cast("date").alias("first_day"),
            F.max("o_orderdate").cast("date").alias("last_day"),
        )

    @property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        nations = self._read("nation").join(
            self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        # Nations first: the rows then leave the join with the orders partitioned by customer.
        return (
            self._read("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(self._life, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(
                key.alias("customer_id"),
                _pick(F.floor(key / 4), ("Male", "Female")).alias("gender"),
                _flag(key % 6 == 0).alias("senior_citizen"),
                (F.floor(key / 8) % 2).cast("int").alias("partner"),
                _flag(key % 10 < 3).alias("dependents"),
                F.col("first_day").alias("signup_date"),
                F.lit("").alias("city"),
                F.col("n_name").alias("state"),
                F.col("r_name").alias("country"),
            )
        )

    @property
    def subscriptions(self) -> DataFrame:
        key, segment = F.col("c_custkey"), F.col("c_mktsegment")
        internet = _pick(F.col("c_nationkey"), INTERNET_SERVICES)
        phone = _flag(key % 11 != 0)
        end = F.when(F.col("last_day") < F.lit(CHURN_CUTOFF), F.col("last_day"))
        cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
        charge = (F.floor((cents + 100000) / 100) + 1800).cast("decimal(10,0)") * F.lit(Decimal("0.01"))
        until = F.coalesce(end, F.lit(AS_OF))
        return (
            self._read("customer")
            .join(self._life, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(
                key.alias("subscription_id"),
                key.alias("customer_id"),
                F.when(segment.isin("BUILDING", "AUTOMOBILE", "HOUSEHOLD"), "Month-to-month")
                .when(segment == "FURNITURE", "One year")
                .otherwise("Two year")
                .alias("contract_type"),
                _pick(key, PAYMENT_METHODS).alias("payment_method"),
                _flag(key % 5 < 3).alias("paperless_billing"),
                internet.alias("internet_service"),
                phone.alias("phone_service"),
                F.when(phone == 0, "No phone service")
                .when(key % 7 < 3, "Yes")
                .otherwise("No")
                .alias("multiple_lines"),
                *[
                    F.when(internet == "No", "No internet service")
                    .when(key % modulus < below, "Yes")
                    .otherwise("No")
                    .alias(name)
                    for name, (modulus, below) in ADD_ON_YES.items()
                ],
                charge.cast("decimal(10,2)").alias("monthly_charges"),
                F.greatest(calendar.whole_months(F.col("first_day"), until), F.lit(1)).alias("tenure_months"),
                F.col("first_day").alias("start_date"),
                end.alias("end_date"),
                _flag(end.isNull()).alias("is_active"),
            )
        )

    @property
    def transactions(self) -> DataFrame:
        """Orders as charges and returned line items as refunds (negative amounts).

        A refund whose order is missing stays, without a customer; the checks report it.
        Refund ids repeat where an order repeats a line number.
        """
        orders = self._read("orders")
        charges = orders.select(
            (F.col("o_orderkey") * 16).alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_custkey").alias("subscription_id"),
            F.col("o_orderdate").cast("date").alias("transaction_date"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
            F.lit("charge").alias("transaction_type"),
            F.when(F.col("o_orderstatus") == "F", "paid")
            .when(F.col("o_orderstatus") == "O", "pending")
            .otherwise("failed")
            .alias("status"),
        )
        refunds = (
            self._read("lineitem")
            .where(F.col("l_returnflag") == "R")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .select(
                (F.col("l_orderkey") * 16 + 1 + F.col("l_linenumber")).alias("transaction_id"),
                F.col("o_custkey").alias("customer_id"),
                F.col("o_custkey").alias("subscription_id"),
                F.col("l_shipdate").cast("date").alias("transaction_date"),
                (-F.col("l_extendedprice").cast("decimal(12,2)")).cast("decimal(12,2)").alias("amount"),
                F.lit("refund").alias("transaction_type"),
                F.lit("paid").alias("status"),
            )
        )
        return charges.unionByName(refunds)

    @property
    def transaction_dates(self) -> DataFrame:
        """`transaction_date` of all transactions; needs no join of refunds with their orders."""
        charges = self._read("orders").select(F.col("o_orderdate").cast("date").alias("transaction_date"))
        refunds = self._read("lineitem").where(F.col("l_returnflag") == "R")
        return charges.unionByName(refunds.select(F.col("l_shipdate").cast("date").alias("transaction_date")))

    @property
    def support_tickets(self) -> DataFrame:
        answered = F.col("event_type") == "error"
        opened = F.col("ts").cast("date")
        return (
            self._read("events")
            .where(F.col("event_type").isin("error", "signup"))
            .select(
                F.col("event_id").alias("ticket_id"),
                F.col("user_id").alias("customer_id"),
                opened.alias("opened_date"),
                F.when(answered, F.date_add(opened, (F.col("event_id") % 14).cast("int"))).alias("closed_date"),
                _pick(F.col("event_id"), TICKET_CATEGORIES).alias("category"),
                _pick(F.col("event_id"), TICKET_PRIORITIES).alias("priority"),
                F.when(answered, (F.floor("value") % 5 + 1).cast("int")).alias("satisfaction_score"),
            )
        )

    @property
    def churn_events(self) -> DataFrame:
        reason = _pick(F.col("customer_id"), CHURN_REASONS)
        return churn_events_extract(self.subscriptions, reason)

    def all_tables(self) -> dict[str, DataFrame]:
        names = ("customers", "subscriptions", "transactions", "support_tickets", "churn_events")
        return {name: getattr(self, name) for name in names}


def planted_label(features: DataFrame, seed: int = 7) -> DataFrame:
    """Replace `churned` by a draw from the scorecard, so that the drivers of churn are known.

    The seed must differ from that of the splits, or the draw would decide the side as well.
    """
    draw = hashing.unit_interval("customer_id", seed) < rules.scorecard_probability(SCORECARD_WEIGHTS)
    return features.withColumn("churned", _flag(draw))
