"""Churn classifiers: encoding, class weights, training, comparison, feature names."""

from __future__ import annotations

from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tidemark.operators.evaluation import binary_metrics
from tidemark.operators.features import CATEGORICAL, NUMERIC
from tidemark.schemas import MODEL_COMPARISON
from tidemark.session import (
    fit_rows_per_task, forest_group_mb, forest_rows_per_task, shared_folder, side_by_side, spread, stage_table,
)

SEED = 42
LABEL, WEIGHT = "churned", "class_weight"
CLASSIFIERS = ("logistic_regression", "random_forest", "boosted_trees")


def encoder(categorical: list[str], numeric: list[str]) -> list:
    """Pipeline stages that turn the columns into the vector `features`.

    Every level gets its own 0/1 slot and an unseen level gives zeros: unseen levels are indexed
    last, and the last slot is the one dropped. Numbers are centred and scaled to unit deviation
    (the sample deviation, a factor of sqrt((n - 1) / n) from the population one).
    """
    return [
        StringIndexer(
            inputCols=categorical,
            outputCols=[f"index_{c}" for c in categorical],
            stringOrderType="alphabetAsc",
            handleInvalid="keep",
        ),
        OneHotEncoder(
            inputCols=[f"index_{c}" for c in categorical],
            outputCols=[f"cat_{c}" for c in categorical],
            dropLast=True,
        ),
        VectorAssembler(inputCols=numeric, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="num", withMean=True, withStd=True),
        VectorAssembler(inputCols=[*[f"cat_{c}" for c in categorical], "num"], outputCol="features"),
    ]


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the slots of `features`, in order."""
    indexer = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    numbers = next(s for s in model.stages if isinstance(s, VectorAssembler) and s.getOutputCol() == "numbers")
    levels = [
        f"cat__{column}_{level}"
        for column, found in zip(indexer.getInputCols(), indexer.labelsArray)
        for level in found
    ]
    return levels + [f"num__{column}" for column in numbers.getInputCols()]


def feature_name_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    names = list(enumerate(feature_names(model)))
    return spark.createDataFrame(names, "feature_index int, feature_name string")


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows, balanced weight and boosting weight per class.

    Balanced: all rows / (2 x rows of the class). Boosting: negatives / positives for class 1, else 1.
    """
    n, positives = F.count("*"), F.count_if(F.col(label) == 1)
    # One row of counts, turned into one row per class; no window, no second pass.
    counts = train.where(F.col(label).isin(0, 1)).agg(n.alias("n"), positives.alias("p"))
    negatives = F.col("n") - F.col("p")
    classes = F.array(
        F.struct(F.lit(0).alias(label), negatives.alias("n_rows"), F.lit(1.0).alias("positive_weight")),
        F.struct(
            F.lit(1).alias(label), F.col("p").alias("n_rows"),
            F.try_divide(negatives, F.col("p")).alias("positive_weight"),
        ),
    )
    return (
        counts.select("n", F.inline(classes))
        .where(F.col("n_rows") > 0)
        .select(label, "n_rows", (F.col("n") / (F.col("n_rows") * 2)).alias("balanced_weight"), "positive_weight")
    )


def with_class_weight(train: DataFrame, column: str, label: str = LABEL) -> DataFrame:
    """Add the class weight as a column; the joined side has two rows."""
    weights = class_weights(train, label).select(label, F.col(column).alias(WEIGHT))
    return train.join(F.broadcast(weights), label)


def classifier(name: str, n_train: int, trees: int = 300, seed: int = SEED):
    """Untrained classifier with the parameters of the comparison.

    Logistic regression has an L2 penalty of strength 1 on the summed loss; Spark averages the loss
    over the weights, which add up to `n_train`. Boosting samples columns per node, as Spark does,
    not per tree.
    """
    common = {"featuresCol": "features", "labelCol": LABEL, "weightCol": WEIGHT}
    if name == "logistic_regression":
        return LogisticRegression(
            **common, maxIter=1000, regParam=1.0 / n_train, elasticNetParam=0.0, standardization=False
        )
    if name == "random_forest":
        return RandomForestClassifier(
            **common, numTrees=trees, maxDepth=8, featureSubsetStrategy="sqrt", seed=seed,
            maxMemoryInMB=forest_group_mb(n_train),
        )
    if name == "boosted_trees":
        return GBTClassifier(
            **common, maxIter=trees, maxDepth=4, stepSize=0.05, subsamplingRate=0.8,
            featureSubsetStrategy="0.8", seed=seed,
        )
    raise ValueError(f"unknown classifier {name}")


def fit_classifier(
    train: DataFrame,
    name: str,
    categorical: list[str] = CATEGORICAL,
    numeric: list[str] = NUMERIC,
    trees: int = 300,
    seed: int = SEED,
) -> PipelineModel:
    """Fit encoding and classifier on the training rows; give staged rows, they are read repeatedly."""
    # The encoded rows, and the growing lineage of boosting, are cut in the checkpoint folder, so that has to be known.
    shared_folder(train.sparkSession)
    scheme = "positive_weight" if name == "boosted_trees" else "balanced_weight"
    n_train, n_labelled = train.agg(F.count("*"), F.count_if(F.col(LABEL).isin(0, 1))).first()
    if n_train != n_labelled:
        raise ValueError(f"{n_train - n_labelled} training rows have no label 0 or 1")
    rows_per_task = forest_rows_per_task(n_train) if name == "random_forest" else fit_rows_per_task(n_train)
    rows = with_class_weight(train.select(*categorical, *numeric, LABEL), scheme)
    rows = spread(rows, n_train, rows_per_task).persist()  # last, as a join above would drop the order
    try:
        # every stage reads them, some several times; dealt and sorted once
        encoding = Pipeline(stages=encoder(categorical, numeric)).fit(rows)
        # Encoded once too, in the same partitions and order. The checkpoint also spares every task of the many jobs of a
        # fit from unpacking how its rows came about.
        encoded = encoding.transform(rows).select("features", LABEL, WEIGHT).checkpoint()
    finally:
        rows.unpersist()
    return PipelineModel(stages=[*encoding.stages, classifier(name, n_train, trees, seed).fit(encoded)])


def with_probability(model: PipelineModel, rows: DataFrame, column: str = "churn_probability") -> DataFrame:
    """Add the probability of class 1, unrounded."""
    scored = model.transform(rows).withColumn(column, vector_to_array("probability").getItem(1))
    return scored.select(*rows.columns, column)


def compare_classifiers(
    train: DataFrame, test: DataFrame, names: tuple[str, ...] = CLASSIFIERS, trees: int = 300, seed: int = SEED
) -> tuple[DataFrame, dict[str, PipelineModel], dict[str, DataFrame]]:
    """Fit every classifier: metrics on the test rows (best first), the models, the scored test rows.

    A model is scored as soon as it is there, while others are still being fitted.
    """

    def fitted(name: str) -> tuple[PipelineModel, DataFrame, Row]:
        model = fit_classifier(train, name, trees=trees, seed=seed)
        # read twice, for the metrics and for the curve
        frame = stage_table(with_probability(model, test), "scored-test")
        return model, frame, Row(model=name, **binary_metrics(frame, LABEL).first().asDict())

    found = side_by_side(train.sparkSession, [partial(fitted, name) for name in names])
    models = {name: model for name, (model, _, _) in zip(names, found)}
    scored = {name: frame for name, (_, frame, _) in zip(names, found)}
    rows = [row for _, _, row in found]
    table = train.sparkSession.createDataFrame(rows, MODEL_COMPARISON)
    return table.orderBy(F.col("roc_auc").desc_nulls_last(), "model"), models, scored


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
