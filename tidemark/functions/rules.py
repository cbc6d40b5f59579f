"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Risk tier bounds, tenure buckets, segment names, scorecard weights.
RISK_TIERS = ("Low", "Medium", "High")
LOW_BELOW = 0.3
MEDIUM_BELOW = 0.6
TENURE_BUCKETS = ((6, "0-6 mo"), (12, "7-12 mo"), (24, "13-24 mo"), (48, "25-48 mo"))
LAST_TENURE_BUCKET = "48+ mo"
SEGMENT_LABELS = ("High-Value Loyal", "Growing / Mid-Value", "Price-Sensitive", "Low-Value / New")
SCORECARD = {
    "tenure_months": -0.06,
    "monthly_charges": 0.032,
    "month_to_month": 1.35,
    "two_year": -1.1,
    "no_tech_support": 0.55,
    "electronic_check": 0.45,
    "senior_citizen": 0.35,
    "fiber_optic": 0.35,
    "no_partner": 0.2,
}
SCORECARD_INTERCEPT = -3.15


def risk_tier(probability: Column | str) -> Column:
    p = F.col(probability) if isinstance(probability, str) else probability
    low, medium, high = RISK_TIERS
    return F.when(p < LOW_BELOW, low).when(p < MEDIUM_BELOW, medium).otherwise(high)


def tenure_bucket(months: Column | str) -> Column:
    """Bucket label; an unknown tenure falls in the last bucket."""
    months = F.col(months) if isinstance(months, str) else months
    bucket = F.when(F.lit(False), F.lit(None).cast("string"))
    for upper, label in TENURE_BUCKETS:
        bucket = bucket.when(months <= upper, label)
    return bucket.otherwise(LAST_TENURE_BUCKET)


def segment_label(cluster: Column | str) -> Column:
    """Name of an ordered segment; an unknown number gives NULL."""
    cluster = F.col(cluster) if isinstance(cluster, str) else cluster
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for number, name in enumerate(SEGMENT_LABELS):
        label = label.when(cluster == number, name)
    return label


def at_least_half(probability: Column | str) -> Column:
    """1 when the probability is 0.5 or more, else 0."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return (p >= 0.5).cast("int")


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def customer_code(number: Column | str) -> Column:
    """Printed customer number, zero-padded to five digits."""
    return F.format_string("CU-%05d", number)


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def half_even(value: Column | str, digits: int) -> Column:
    """Rounded as data frame libraries do: scale, nearest whole number with ties to even, scale back."""
    value = F.col(value) if isinstance(value, str) else value
    scale = float(10**digits)
    return F.rint(value.cast("double") * scale) / scale


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole in percent, half up; NULL when whole is 0."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def scorecard_terms() -> dict[str, Column]:
    """The nine driver terms of the scorecard, by name, as doubles."""

    def flag(column: str, value: object) -> Column:
        return F.when(F.col(column) == F.lit(value), 1.0).otherwise(0.0)

    return {
        "tenure_months": F.col("tenure_months").cast("double"),
        "monthly_charges": F.col("monthly_charges").cast("double"),
        "month_to_month": flag("contract_type", "Month-to-month"),
        "two_year": flag("contract_type", "Two year"),
        "no_tech_support": flag("tech_support", "No"),
        "electronic_check": flag("payment_method", "Electronic check"),
        "senior_citizen": flag("senior_citizen", 1),
        "fiber_optic": flag("internet_service", "Fiber optic"),
        "no_partner": flag("partner", 0),
    }


def scorecard_logit(weights: dict[str, float] | None = None, intercept: float = SCORECARD_INTERCEPT) -> Column:
    weights = {**SCORECARD, **(weights or {})}
    total = F.lit(float(intercept))
    for name, term in scorecard_terms().items():
        total = total + F.lit(float(weights[name])) * term
    return total


def scorecard_probability(weights: dict[str, float] | None = None, intercept: float = SCORECARD_INTERCEPT) -> Column:
    """Churn probability of the fixed-coefficient scorecard."""
    return logistic(scorecard_logit(weights, intercept))
