"""Why a score is what it is: additive contributions of linear and tree models, and rankings of the drivers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.operators.models import feature_names
from tidemark.session import new_path, stage_table

#: What the usual chart of drivers shows.
TOP_DRIVERS = 15


#: What base and contributions add up to: the logit of the probability, or the probability itself.
LOGIT, PROBABILITY = "logit", "probability"


def is_linear(model: PipelineModel) -> bool:
    """Whether the pipeline ends in a logistic regression."""
    return isinstance(model.stages[-1], LogisticRegressionModel)


def contributions(
    rows: DataFrame, key: str, values: Column, names: list[str], weights: list[float], centre: list[float]
) -> DataFrame:
    """Long form (key, feature, value, contribution): weight x (value - centre) per feature.

    `values` is an array column in the order of `names`. The result has one row per input row and
    feature, so pass the rows to be explained and not a whole table.
    """
    fixed = [F.array(*[F.lit(x) for x in column]) for column in (names, map(float, weights), map(float, centre))]
    zipped = F.arrays_zip(fixed[0].alias("feature"), values.alias("value"), fixed[1].alias("weight"), fixed[2].alias("centre"))
    long_form = rows.select(key, F.inline(zipped)).toDF(key, "feature", "value", "weight", "centre")
    return long_form.select(
        key, "feature", "value", (F.col("weight") * (F.col("value") - F.col("centre"))).alias("contribution")
    )


def linear_parts(model: PipelineModel) -> tuple[list[str], list[float], float]:
    """Feature names, weights and intercept of a pipeline that ends in a logistic regression."""
    last = model.stages[-1]
    if not isinstance(last, LogisticRegressionModel):
        raise TypeError("not a linear model; use additive_contributions")
    return feature_names(model), [float(w) for w in last.coefficients.toArray()], float(last.intercept)


def linear_contributions(
    model: PipelineModel, rows: DataFrame, background: DataFrame, key: str = "customer_id"
) -> tuple[DataFrame, float]:
    """Contributions to the logit against the mean of `background`, and the logit at that mean.

    Per row, the base plus all contributions is the logit of the score.
    """
    names, weights, intercept = linear_parts(model)
    encoded = model.transform(background)
    centre = [float(x) for x in encoded.select(Summarizer.mean(F.col("features"))).first()[0].toArray()]
    base = intercept + sum(w * m for w, m in zip(weights, centre))
    explained = model.transform(rows).select(key, vector_to_array("features").alias("_x"))
    return contributions(explained, key, F.col("_x"), names, weights, centre), base


def _tree_leaves(model: PipelineModel) -> tuple[DataFrame, float, str]:
    """(leaves of all trees, base, scale) of a pipeline that ends in a forest or in boosted trees.

    A node's value is the score of the training rows that reach it, on the scale of the sum: for boosting the logit,
    which is twice the weighted sum of the trees, for a forest the mean probability. A leaf has the number under which
    the model reports it, from the left, and for every slot by how much the value changes at the slot's splits on the
    way from the root. Nodes are read from the saved form of the model, where a node's children come after it, the left
    before the right; leaves are at most trees x 2 ** depth.
    """
    last = model.stages[-1]
    if isinstance(last, GBTClassificationModel):
        scale, value = LOGIT, F.col("nodeData.prediction")
        weights = [2.0 * w for w in last.treeWeights]
    elif isinstance(last, RandomForestClassificationModel):
        stats = F.col("nodeData.impurityStats")
        scale, value = PROBABILITY, F.get(stats, F.lit(1)) / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
        weights = [1.0 / last.getNumTrees] * last.getNumTrees
    else:
        raise TypeError(f"no contributions for {type(last).__name__}")
    spark = SparkSession.getActiveSession()
    path = new_path(spark, "trees")
    last.write().overwrite().save(path)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.col("treeID"))
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), (weight * value).alias("value"),
        "nodeData.leftChild", "nodeData.rightChild", F.col("nodeData.split.featureIndex").alias("slot"),
    )
    base = nodes.where("node = 0").agg(F.sum("value")).first()[0]
    values = nodes.select("tree", F.col("node").alias("child"), F.col("value").alias("child_value"))
    inner = nodes.where("leftChild >= 0")
    for side in ("left", "right"):
        child = values.withColumnsRenamed({"child": f"{side}Child", "child_value": f"{side}_value"})
        inner = inner.join(child, ["tree", f"{side}Child"])
    steps = [
        F.struct(F.col(f"{side}Child").alias("node"), F.struct("slot", (F.col(f"{side}_value") - F.col("value")).alias("change")).alias("step"))
        for side in ("left", "right")
    ]
    inner = stage_table(inner.select("tree", "node", F.array(*steps).alias("children")), "inner-nodes")
    nothing = F.array().cast("array<struct<slot:int,change:double>>")
    reached = nodes.where("node = 0").select("tree", "node", nothing.alias("path"))
    stay = F.array(F.struct("node", F.lit(None).cast("struct<slot:int,change:double>").alias("step")))
    for _ in range(last.getOrDefault("maxDepth")):
        below = reached.join(F.broadcast(inner), ["tree", "node"], "left")
        below = below.select("tree", "path", F.inline(F.coalesce("children", stay)))
        path_below = F.when(F.col("step").isNull(), F.col("path")).otherwise(F.concat("path", F.array("step")))
        reached = below.select("tree", "node", path_below.alias("path"))

    def change(slot: Column) -> Column:
        own = F.filter("path", lambda step: step["slot"] == slot)
        return F.aggregate(own, F.lit(0.0), lambda total, step: total + step["change"])

    slots = F.sequence(F.lit(0), F.lit(last.numFeatures - 1))
    leaf = F.row_number().over(Window.partitionBy("tree").orderBy("node")) - 1
    leaves = reached.select("tree", leaf.alias("leaf"), F.transform(slots, change).alias("changes"))
    return stage_table(leaves, "leaves"), base, scale


def tree_contributions(
    model: PipelineModel, rows: DataFrame, key: str = "customer_id"
) -> tuple[DataFrame, float, str]:
    """(contributions of every feature in long form, base, scale) of a forest or boosted trees.

    Every split on a row's way through a tree is credited to its feature with the change of the node's value, so that
    base plus all contributions is the row's score on that scale; the base is the mean of the training rows. The model
    names the leaf a row ends in per tree, and the leaf tells the changes on the way to it, so a row meets one table of
    leaves, whose size is bounded by trees and depth, and is then joined with its sums by key alone. Pass the rows to
    be explained and not a whole table; rows with a key that occurs twice would be added up.
    """
    leaves, base, scale = _tree_leaves(model)
    last, names = model.stages[-1], feature_names(model)
    named = PipelineModel([*model.stages[:-1], last.copy({last.leafCol: "_leaf"})])
    encoded = named.transform(rows).select(
        key, vector_to_array("features").alias("_x"), vector_to_array("_leaf").alias("_leaf")
    )
    ends = encoded.select(F.col(key).alias("_key"), F.posexplode("_leaf").alias("tree", "leaf"))
    ends = ends.withColumn("leaf", F.col("leaf").cast("int")).join(F.broadcast(leaves), ["tree", "leaf"])
    sums = ends.groupBy("_key").agg(*[F.sum(F.get("changes", F.lit(i))).alias(f"_change{i}") for i in range(len(names))])
    sums = sums.select("_key", F.array(*[f"_change{i}" for i in range(len(names))]).alias("_changes"))
    every = encoded.select(key, "_x").join(sums, F.col(key).eqNullSafe(F.col("_key")), "left")
    zipped = F.arrays_zip(
        F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("_x").alias("value"), F.col("_changes").alias("contribution")
    )
    return every.select(key, F.inline(zipped)).toDF(key, "feature", "value", "contribution"), base, scale


def additive_contributions(
    model: PipelineModel, rows: DataFrame, background: DataFrame, key: str = "customer_id"
) -> tuple[DataFrame, float, str]:
    """(contributions, base, scale) of any classifier; a linear one is compared with the mean of `background`."""
    if is_linear(model):
        return *linear_contributions(model, rows, background, key), LOGIT
    return tree_contributions(model, rows, key)


def driver_ranking(long_form: DataFrame, top: int | None = None) -> DataFrame:
    """Mean absolute contribution per feature, largest first; all features without `top`."""
    ranked = (
        long_form.groupBy("feature")
        .agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
        .orderBy(F.col("mean_abs_contribution").desc(), "feature")
    )
    return ranked if top is None else ranked.limit(top)


def tree_drivers(model: PipelineModel, rows: DataFrame, top: int | None = None) -> DataFrame:
    """Importance per feature of a tree model, largest first; all features without `top`."""
    weights = model.stages[-1].featureImportances.toArray()
    pairs = [(name, float(w)) for name, w in zip(feature_names(model), weights)]
    table = rows.sparkSession.createDataFrame(pairs, "feature string, importance double")
    ranked = table.orderBy(F.col("importance").desc(), "feature")
    return ranked if top is None else ranked.limit(top)
