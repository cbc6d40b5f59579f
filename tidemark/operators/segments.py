"""Customer segments by k-means, numbered by value."""

from __future__ import annotations

from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import rules
from tidemark.operators.models import SEED
from tidemark.session import side_by_side, spread, stage_table

SEGMENT_COLUMNS = ["tenure_months", "monthly_charges", "ticket_count", "predicted_clv"]
CLUSTERS = len(rules.SEGMENT_LABELS)


def fit_segments(rows: DataFrame, k: int = CLUSTERS, restarts: int = 10, seed: int = SEED) -> PipelineModel:
    """Scaling and k-means on tenure, charge, tickets and value; the cheapest of several seeds wins."""
    prepare = Pipeline(stages=[
        VectorAssembler(inputCols=SEGMENT_COLUMNS, outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
    ])
    numbers = stage_table(rows.select(*SEGMENT_COLUMNS), "segments")
    scaler = prepare.fit(numbers)
    points = scaler.transform(spread(numbers, numbers.count())).select("_scaled").persist()
    try:
        points.count()  # filled once, before the runs share it
        kmeans = KMeans(k=k, featuresCol="_scaled", predictionCol="raw_cluster", maxIter=300, tol=1e-4)
        fits = [partial(kmeans.copy({kmeans.seed: seed + i}).fit, points) for i in range(restarts)]
        runs = side_by_side(rows.sparkSession, fits)
    finally:
        points.unpersist()
    best = min(runs, key=lambda run: run.summary.trainingCost)
    return PipelineModel([*scaler.stages, best])


def assign_cluster(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).select(*rows.columns, "raw_cluster")


def segment_order(
    rows: DataFrame, raw: str = "raw_cluster", value: str = "predicted_clv", k: int = CLUSTERS
) -> DataFrame:
    """(raw cluster, segment number): 0, 1, ... from the largest mean value down. Save it with the clusters."""
    return (
        rows.where(F.col(raw).between(0, k - 1))
        .groupBy(raw)
        .agg(F.avg(value).alias("_mean"))
        .select(
            raw, (F.row_number().over(Window.orderBy(F.col("_mean").desc(), raw)) - 1).alias("segment_cluster")
        )
    )


def relabel_segments(
    rows: DataFrame,
    raw: str = "raw_cluster",
    value: str = "predicted_clv",
    k: int = CLUSTERS,
    order: DataFrame | None = None,
) -> DataFrame:
    """Replace raw cluster numbers by segment numbers and name them, in the order given or that of these rows.

    The joined side has one row per cluster and so at most `k`. A row without one of the k clusters
    stays without a number.
    """
    order = segment_order(rows, raw, value, k) if order is None else order
    return (
        rows.join(F.broadcast(order), raw, "left")
        .select(*[c for c in rows.columns if c != raw], "segment_cluster")
        .withColumn("segment_label", rules.segment_label("segment_cluster"))
    )


def segment_profile(rows: DataFrame) -> DataFrame:
    """Size and means of tenure, charge, value and churn per segment, two decimals, half to even."""
    return rows.groupBy("segment_label").agg(
        F.count("*").alias("customers"),
        *[
            rules.half_even(F.avg(F.col(c).cast("double")), 2).alias(f"avg_{c}")
            for c in ("tenure_months", "monthly_charges", "predicted_clv", "churned")
        ],
    )
