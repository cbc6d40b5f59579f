"""Model quality. Scored rows are grouped by score first; no step orders raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import rules
from tidemark.functions.running import running_totals

# Probabilities with this many decimals take at most 100,001 values, so one ordered window is safe.
PUBLISHED_DECIMALS = 5


def _grouped(scored: DataFrame, label: str, score: str, decimals: int | None) -> tuple[DataFrame, bool]:
    """Rows per score and class, and whether the number of scores has a proven bound.

    A missing score or a label other than 0 and 1 stops the computation, and so does a score outside [0, 1] where the
    bound on the number of scores rests on that range.
    """
    value, small = F.col(score).cast("double"), decimals is not None and decimals <= PUBLISHED_DECIMALS
    wrong = value.isNull() | F.isnan(value) | ~F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    if small:
        wrong = wrong | (value < 0) | (value > 1)
    what = F.concat_ws(" ", F.lit("cannot rank score"), F.coalesce(value.cast("string"), F.lit("NULL")), F.lit("with label"),
                       F.coalesce(F.col(label).cast("string"), F.lit("NULL")))
    checked = F.when(wrong, F.raise_error(what).cast("double")).otherwise(value)
    value = checked if decimals is None else rules.half_even(checked, decimals)
    positive = F.sum(F.col(label).cast("bigint"))
    counts = scored.groupBy(value.alias("score")).agg(
        positive.alias("positives"), (F.count(label) - positive).alias("negatives")
    )
    return counts, small


def binary_metrics(
    scored: DataFrame, label: str = "churned", score: str = "churn_probability", decimals: int | None = None
) -> DataFrame:
    """ROC-AUC, precision, recall and F1 at probability 0.5, to four decimals, in one row.

    Ties in the score count half. Without both classes the AUC is NULL; precision, recall and F1
    are 0 where their denominator is 0. `decimals` states that the scores carry so many decimals.
    """
    counts, small = _grouped(scored, label, score, decimals)
    cumulated = running_totals(counts, "score", ["positives", "negatives"], small=small)
    predicted = rules.at_least_half("score") == 1
    below = F.col("negatives_total") - F.col("negatives") / 2
    sums = cumulated.agg(
        F.sum("positives").alias("p"),
        F.sum("negatives").alias("n"),
        F.sum(F.col("positives") * below).alias("pairs"),
        F.coalesce(F.sum(F.when(predicted, F.col("positives"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(predicted, F.col("negatives"))), F.lit(0)).alias("fp"),
    )

    def ratio(part, whole):
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    tp, fp, p, n = F.col("tp"), F.col("fp"), F.col("p"), F.col("n")
    pairs = p.cast("double") * n.cast("double")
    return sums.select(
        F.round(F.try_divide(F.col("pairs").cast("double"), pairs), 4).alias("roc_auc"),
        F.round(ratio(tp, tp + fp), 4).alias("precision"),
        F.round(ratio(tp, p), 4).alias("recall"),
        F.round(ratio(tp * 2, tp + fp + p), 4).alias("f1"),
    )


def roc_points(
    scored: DataFrame,
    label: str = "churned",
    score: str = "churn_probability",
    decimals: int | None = None,
    drop_intermediate: bool = True,
) -> DataFrame:
    """Points (threshold, fpr, tpr) of the ROC curve, from (0, 0) at an infinite threshold.

    With `drop_intermediate` a point between two equal steps is left out; the curve is the same.
    """
    counts, small = _grouped(scored, label, score, decimals)
    points = running_totals(counts, "score", ["positives", "negatives"], descending=True, small=small)
    steps = [(F.col(c), F.col(f"{c}_next"), F.col(f"{c}_total")) for c in ("positives", "negatives")]
    first = (steps[0][0] == steps[0][2]) & (steps[1][0] == steps[1][2])
    start = points.where(first).withColumns({
        "score": F.lit(float("inf")),
        "positives_total": F.lit(0).cast("bigint"),
        "negatives_total": F.lit(0).cast("bigint"),
    })
    if drop_intermediate:
        last = steps[0][1].isNull()
        bend = (steps[0][0] != steps[0][1]) | (steps[1][0] != steps[1][1])
        points = points.where(first | last | bend)

    def share(measure: str) -> Column:
        return F.try_divide(F.col(f"{measure}_total").cast("double"), F.col(f"{measure}_all").cast("double"))

    return points.unionByName(start).select(
        F.col("score").alias("threshold"), share("negatives").alias("fpr"), share("positives").alias("tpr")
    )


def regression_metrics(predicted: DataFrame, target: str, prediction: str) -> DataFrame:
    """Mean absolute error and R squared over the rows that have target and prediction, in one pass."""
    y, yhat = F.col(target).cast("double"), F.col(prediction).cast("double")
    y = F.when(yhat.isNotNull(), y)
    sums = predicted.agg(
        F.avg(F.abs(y - yhat)).alias("mae"),
        F.sum((y - yhat) * (y - yhat)).alias("sse"),
        (F.var_pop(y) * F.count(y)).alias("sst"),
    )
    return sums.select("mae", (F.lit(1.0) - F.try_divide("sse", "sst")).alias("r2"))


def best_model(comparison: DataFrame) -> DataFrame:
    """Highest ROC-AUC; a tie goes to the first name."""
    return comparison.orderBy(F.col("roc_auc").desc_nulls_last(), "model").limit(1)
