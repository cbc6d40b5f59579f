"""Expected lifetime of customers and the value that follows from it."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from tidemark.functions import rules
from tidemark.operators.evaluation import regression_metrics
from tidemark.operators.features import CATEGORICAL, NUMERIC_NO_TENURE
from tidemark.operators.models import SEED, encoder
from tidemark.operators.splits import exact_split
from tidemark.session import forest_rows_per_task, spread, stage_table


def fit_lifetime_model(
    features: DataFrame, trees: int = 300, seed: int = SEED
) -> tuple[PipelineModel, DataFrame]:
    """Regression forest for total tenure, and its error on held-out rows.

    It learns from customers that have left, the only ones whose total tenure is known, so it
    underestimates those who stay.
    """
    columns = [*CATEGORICAL, *NUMERIC_NO_TENURE, "tenure_months"]
    churned = features.where(F.col("churned") == 1).select("customer_id", *columns)
    parts = stage_table(exact_split(churned, "customer_id", seed=seed), "lifetime")
    forest = RandomForestRegressor(
        featuresCol="features", labelCol="tenure_months", predictionCol="predicted_tenure",
        numTrees=trees, maxDepth=8, featureSubsetStrategy="all", seed=seed,
    )
    train, test = parts.where(~F.col("is_test")), parts.where("is_test")
    n_train = train.count()
    rows = spread(train, n_train, forest_rows_per_task(n_train)).persist()
    try:
        # every stage reads them, some several times; dealt and sorted once
        model = Pipeline(stages=[*encoder(CATEGORICAL, NUMERIC_NO_TENURE), forest]).fit(rows)
    finally:
        rows.unpersist()
    return model, regression_metrics(model.transform(test), "tenure_months", "predicted_tenure")


def predict_lifetime(model: PipelineModel, features: DataFrame) -> DataFrame:
    return model.transform(features).select(*features.columns, "predicted_tenure")


def predicted_clv(rows: DataFrame, prediction: str = "predicted_tenure") -> DataFrame:
    """Add total tenure and value: own tenure once churned, else the prediction but no less than the tenure.

    Value is total tenure x monthly charge, two decimals, half to even.
    """
    tenure = F.col("tenure_months").cast("double")
    total = F.when(F.col("churned") == 1, tenure).otherwise(F.greatest(F.col(prediction), tenure))
    value = rules.half_even(F.col("predicted_total_tenure_months") * F.col("monthly_charges").cast("double"), 2)
    return rows.withColumn("predicted_total_tenure_months", total).withColumn("predicted_clv", value).select(
        *[c for c in rows.columns if c != prediction], "predicted_total_tenure_months", "predicted_clv"
    )
