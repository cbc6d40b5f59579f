"""Declared schemas of the domain tables; no reader infers types."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _INT, _LONG, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
_MONEY = T.DecimalType(10, 2)

ADD_ONS = ("online_security", "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies")


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CUSTOMERS = _table(
    customer_id=_TEXT, gender=_TEXT, senior_citizen=_INT, partner=_INT, dependents=_INT,
    signup_date=_DATE, city=_TEXT, state=_TEXT, country=_TEXT,
)

SUBSCRIPTIONS = _table(
    subscription_id=_LONG, customer_id=_TEXT, contract_type=_TEXT, payment_method=_TEXT,
    paperless_billing=_INT, internet_service=_TEXT, phone_service=_INT, multiple_lines=_TEXT,
    **dict.fromkeys(ADD_ONS, _TEXT),
    monthly_charges=_MONEY, tenure_months=_INT, start_date=_DATE, end_date=_DATE, is_active=_INT,
)

TRANSACTIONS = _table(
    transaction_id=_LONG, customer_id=_TEXT, subscription_id=_LONG, transaction_date=_DATE,
    amount=T.DecimalType(12, 2), transaction_type=_TEXT, status=_TEXT,
)

SUPPORT_TICKETS = _table(
    ticket_id=_LONG, customer_id=_TEXT, opened_date=_DATE, closed_date=_DATE, category=_TEXT,
    priority=_TEXT, satisfaction_score=_INT,
)

CHURN_EVENTS = _table(
    churn_id=_LONG, customer_id=_TEXT, churn_date=_DATE, churn_flag=_INT, churn_reason=_TEXT,
)

PREDICTIONS = _table(
    customer_id=_TEXT, churn_probability=T.DecimalType(6, 5), risk_tier=_TEXT,
    predicted_clv=T.DecimalType(12, 2), segment_cluster=_INT, model_version=_TEXT,
    scored_at=T.TimestampType(),
)

FEATURES = _table(
    customer_id=_TEXT, gender=_TEXT, senior_citizen=_INT, partner=_INT, dependents=_INT,
    contract_type=_TEXT, payment_method=_TEXT, paperless_billing=_INT, internet_service=_TEXT,
    phone_service=_INT, multiple_lines=_TEXT, **dict.fromkeys(ADD_ONS, _TEXT),
    monthly_charges=_MONEY, tenure_months=_INT, is_active=_INT, ticket_count=_LONG,
    avg_satisfaction=T.DoubleType(), churned=_INT,
)

FEATURES_SCORED = T.StructType([
    *FEATURES.fields,
    *_table(
        predicted_total_tenure_months=T.DoubleType(), predicted_clv=T.DoubleType(), segment_cluster=_INT,
        segment_label=_TEXT,
    ),
])

MODEL_COMPARISON = _table(
    model=_TEXT, **dict.fromkeys(("roc_auc", "precision", "recall", "f1"), T.DoubleType()),
)

SNAPSHOT = _table(
    customer_id=_TEXT, contract_type=_TEXT, internet_service=_TEXT, payment_method=_TEXT,
    monthly_charges=_MONEY, tenure_months=_INT, ticket_count=_LONG,
    churn_probability=T.DoubleType(), risk_tier=_TEXT, predicted_clv=T.DoubleType(),
    segment_cluster=_INT, segment_label=_TEXT,
)

MODEL_METADATA = _table(
    best_model=_TEXT, categorical=T.ArrayType(_TEXT), numeric=T.ArrayType(_TEXT), model_version=_TEXT,
)

# Load order: parents before children.
RAW_TABLES = {
    "customers": CUSTOMERS,
    "subscriptions": SUBSCRIPTIONS,
    "transactions": TRANSACTIONS,
    "support_tickets": SUPPORT_TICKETS,
    "churn_events": CHURN_EVENTS,
}


def with_key_type(schema: T.StructType, key: T.DataType, column: str = "customer_id") -> T.StructType:
    """Same schema with another type for the customer key (for example BIGINT keys)."""
    return T.StructType([T.StructField(f.name, key if f.name == column else f.dataType) for f in schema])

SEGMENT_ORDER = T.StructType([T.StructField("raw_cluster", T.IntegerType()), T.StructField("segment_cluster", T.IntegerType())])
