from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import evaluation, explain, inference, lifetime, models, scoring, segments, splits
from tidemark.operators.features import CATEGORICAL, NUMERIC, feature_table
from tidemark.plans import jobs
from tidemark.session import stage_table
from tidemark.sources.star_tables import StarTables, planted_label

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    t = StarTables(spark, MEDIUM)
    return stage_table(planted_label(feature_table(t.customers, t.subscriptions, t.support_tickets)), "rows")


@pytest.fixture(scope="module")
def parts(rows):
    return jobs.split_features(rows)


@pytest.fixture(scope="module")
def logistic(parts):
    return models.fit_classifier(parts[0], "logistic_regression")


def test_encoding(spark, rows):
    model = Pipeline(stages=models.encoder(CATEGORICAL, NUMERIC)).fit(rows)
    names = models.feature_names(model)
    assert names[:2] == ["cat__gender_Female", "cat__gender_Male"] and names[-9:] == [f"num__{c}" for c in NUMERIC]
    unseen = rows.limit(1).withColumn("contract_type", F.lit("Ten years")).withColumn("gender", F.lit(None).cast("string"))
    vector = model.transform(unseen).first().features.toArray()
    assert len(vector) == len(names)
    for name, value in zip(names, vector):
        if name.startswith(("cat__gender", "cat__contract_type")):
            assert value == 0.0
    matrix = np.array([
        r[0] for r in model.transform(rows).select(vector_to_array("features")).collect()
    ])
    # Every categorical column has exactly one slot set; numbers have mean 0 and deviation 1.
    assert (matrix[:, : -len(NUMERIC)].sum(axis=1) == len(CATEGORICAL)).all()
    assert np.allclose(matrix[:, -len(NUMERIC):].mean(axis=0), 0, atol=1e-9)
    assert np.allclose(matrix[:, -len(NUMERIC):].std(axis=0, ddof=1), 1)


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "churned int")
    got = {r.churned: (r.n_rows, r.balanced_weight, r.positive_weight) for r in models.class_weights(df).collect()}
    assert got == {0: (6, 8 / 12, 1.0), 1: (2, 2.0, 3.0)}
    weighted = models.with_class_weight(df, "balanced_weight")
    assert weighted.agg(F.sum("class_weight")).first()[0] == pytest.approx(8.0)


def test_logistic_regression_finds_the_planted_drivers(logistic, parts):
    names, weights, _ = explain.linear_parts(logistic)
    weight = dict(zip(names, weights))
    assert weight["cat__contract_type_Month-to-month"] > 0 > weight["cat__contract_type_Two year"]
    assert weight["num__monthly_charges"] > 0 > weight["num__tenure_months"]
    metrics = evaluation.binary_metrics(models.with_probability(logistic, parts[1])).first()
    assert 0.7 < metrics.roc_auc <= 1 and metrics.recall > 0.5


def test_logistic_regression_solves_the_stated_problem(logistic, parts):
    """The gradient of weighted log loss + half the squared weights vanishes at the solution."""
    train = models.with_class_weight(parts[0], "balanced_weight")
    data = logistic.transform(train).select(vector_to_array("features"), "class_weight", "churned").collect()
    x, w, y = (np.array([r[i] for r in data], dtype=float) for i in range(3))
    _, weights, intercept = explain.linear_parts(logistic)
    p = 1 / (1 + np.exp(-(x @ weights + intercept)))
    assert np.allclose(x.T @ (w * (p - y)) + weights, 0, atol=0.05)
    assert abs((w * (p - y)).sum()) < 0.05


def test_contributions_add_up_to_the_logit(logistic, parts):
    sample = splits.sample_rows(parts[1], "customer_id", 50)
    long_form, base = explain.linear_contributions(logistic, sample, sample)
    totals = {r[0]: r[1] for r in long_form.groupBy("customer_id").agg(F.sum("contribution")).collect()}
    scores = models.with_probability(logistic, sample).collect()
    assert len(totals) == len(scores) == 50
    for r in scores:
        logit = np.log(r.churn_probability / (1 - r.churn_probability))
        assert base + totals[r.customer_id] == pytest.approx(logit, abs=1e-9)
    ranking = explain.driver_ranking(long_form, explain.TOP_DRIVERS).collect()
    assert len(ranking) == 15 and ranking[0].feature == "num__monthly_charges"


def test_two_methods_agree_on_the_drivers(rows, logistic):
    """A driver that raises the odds in the regression table pushes the score in the classifier."""
    names, weights, _ = explain.linear_parts(logistic)
    weight = dict(zip(names, weights))
    estimate = {r.term: r.estimate for r in inference.glm_logit(rows).coefficients.where("p_value < 0.01").collect()}
    for term, name in {"monthly_charges": "num__monthly_charges", "tenure_months": "num__tenure_months"}.items():
        assert np.sign(estimate[term]) == np.sign(weight[name])
    base = weight["cat__contract_type_Month-to-month"]
    for level in ("One year", "Two year"):
        assert np.sign(estimate[f"contract_type{level}"]) == np.sign(weight[f"cat__contract_type_{level}"] - base)


def test_trees(spark, parts):
    forest = models.fit_classifier(parts[0], "random_forest", trees=10)
    boosted = models.fit_classifier(parts[0], "boosted_trees", trees=5)
    for model in (forest, boosted):
        assert evaluation.binary_metrics(models.with_probability(model, parts[1])).first().roc_auc > 0.6
        drivers = explain.tree_drivers(model, parts[1], explain.TOP_DRIVERS).collect()
        assert len(drivers) == 15 and drivers[0].importance >= drivers[-1].importance
    with pytest.raises(TypeError):
        explain.linear_parts(forest)
    with pytest.raises(ValueError):
        models.classifier("oracle", 1)


def test_save_load_and_profiles(spark, logistic, parts, tmp_path):
    models.save_model(logistic, str(tmp_path / "model"))
    loaded = models.load_model(str(tmp_path / "model"))
    profiles = parts[1].withColumnRenamed("customer_id", "profile_id")
    scored, long_form = scoring.score_profiles(loaded, profiles, parts[1])
    first = scored.first()
    total = long_form.where(F.col("profile_id") == first.profile_id).agg(F.sum("contribution")).first()[0]
    assert first.base_logit + total == pytest.approx(np.log(first.churn_probability / (1 - first.churn_probability)))
    direct = models.with_probability(logistic, profiles)
    key = ["profile_id", "churn_probability"]
    assert sorted(map(tuple, scored.select(key).collect())) == sorted(map(tuple, direct.select(key).collect()))
    assert long_form.where("profile_id = %d" % scored.first().profile_id).count() == len(models.feature_names(loaded))
    for r in scored.collect():
        assert r.risk_tier == ("Low" if r.churn_probability < 0.3 else "Medium" if r.churn_probability < 0.6 else "High")


def test_lifetime_and_segments(spark, rows):
    model, error = lifetime.fit_lifetime_model(rows, trees=10)
    assert error.first().mae > 0
    predicted = lifetime.predict_lifetime(model, rows)
    valued = stage_table(lifetime.predicted_clv(predicted), "valued")
    assert "predicted_tenure" not in valued.columns
    assert valued.where("predicted_total_tenure_months < tenure_months").count() == 0
    assert valued.where("churned = 1 AND predicted_total_tenure_months <> tenure_months").count() == 0

    clusters = segments.fit_segments(valued, restarts=2)
    labelled = segments.relabel_segments(segments.assign_cluster(clusters, valued))
    assert labelled.count() == rows.count()
    means = [r.m for r in labelled.groupBy("segment_cluster").agg(F.avg("predicted_clv").alias("m"))
             .orderBy("segment_cluster").collect()]
    assert len(means) == 4 and means == sorted(means, reverse=True)
    assert segments.segment_profile(labelled).agg(F.sum("customers")).first()[0] == rows.count()


def test_prediction_table_types(spark):
    df = spark.createDataFrame([(1, 0.599996, 10.005, 2, 5.0)],
                               "customer_id int, churn_probability double, predicted_clv double, segment_cluster int, "
                               "monthly_charges double")
    scored = scoring.with_risk(df)
    row = scoring.prediction_table(scored, dt.datetime(2024, 5, 6, 7, 8, 9, 999)).first()
    assert row.risk_tier == "High" and str(row.churn_probability) == "0.60000"
    assert row.scored_at == dt.datetime(2024, 5, 6, 7, 8, 9)
    assert [tuple(r) for r in scoring.tier_counts(scored).collect()] == [("Low", None), ("Medium", None), ("High", 1)]
    assert scoring.risk_total(scored.where("risk_tier = 'Low'")).first()[0] == 0.0


def test_profiles_are_scored_by_a_tree_model(spark, parts):
    forest = models.fit_classifier(parts[0], "random_forest", trees=3)
    profiles = parts[1].withColumnRenamed("customer_id", "profile_id")
    scored, reasons = scoring.score_profiles(forest, profiles, parts[1])
    assert scored.where("churn_probability is null or risk_tier is null").count() == 0
    assert scored.where("base_logit is not null or score_scale <> 'probability'").count() == 0
    assert reasons.select("profile_id").distinct().count() == profiles.count()


def walked(tree, x, value):
    """Contributions of one tree by walking its nodes through the JVM."""
    node, out = tree._call_java("rootNode"), {}
    while node.subtreeDepth() > 0:
        split = node.split()
        slot = split.featureIndex()
        if hasattr(split, "threshold") and "Continuous" in split.getClass().getName():
            left = x[slot] <= split.threshold()
        else:
            left = x[slot] in list(split.leftCategories())
        below = node.leftChild() if left else node.rightChild()
        out[slot] = out.get(slot, 0.0) + value(below) - value(node)
        node = below
    return out


@pytest.mark.parametrize("name", ["random_forest", "boosted_trees"])
def test_tree_contributions_add_up_and_equal_a_walk_through_the_trees(spark, parts, name):
    model = models.fit_classifier(parts[0], name, trees=6)
    rows = parts[1].limit(12)
    long_form, base, scale = explain.tree_contributions(model, rows)
    found = {}
    for r in long_form.collect():
        found.setdefault(r.customer_id, {})[r.feature] = r.contribution
    names, last = models.feature_names(model), model.stages[-1]

    def share(node):
        stats = list(node.impurityStats().stats())
        return stats[1] / sum(stats) / last.getNumTrees

    encoded = model.transform(rows).select("customer_id", "features", "probability").collect()
    assert len(found) == len(encoded) == 12
    for r in encoded:
        x, p = r.features.toArray(), r.probability[1]
        expected = dict.fromkeys(names, 0.0)
        for tree, weight in zip(last.trees, last.treeWeights):
            value = share if name == "random_forest" else lambda node, w=weight: 2 * w * node.prediction()
            for slot, change in walked(tree, x, value).items():
                expected[names[slot]] += change
        assert found[r.customer_id] == pytest.approx(expected, abs=1e-9)
        score = p if scale == explain.PROBABILITY else np.log(p / (1 - p))
        assert base + sum(expected.values()) == pytest.approx(score, abs=1e-6)
    assert scale == (explain.PROBABILITY if name == "random_forest" else explain.LOGIT)


@pytest.mark.parametrize("name", ["random_forest", "boosted_trees"])
def test_fits_do_not_depend_on_the_layout(spark, parts, name):
    one, seven = (
        models.with_probability(models.fit_classifier(parts[0].repartition(n), name, trees=4), parts[1])
        .select("customer_id", "churn_probability")
        for n in (1, 7)
    )
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, seven.collect()))


def test_rows_without_a_label_stop_a_fit(spark, parts):
    unlabelled = parts[0].withColumn("churned", F.when(F.col("customer_id") > 5, F.col("churned")))
    with pytest.raises(ValueError, match="no label"):
        models.fit_classifier(unlabelled, "logistic_regression")


def test_saved_numbering_of_segments_holds_for_other_batches(spark):
    first = spark.createDataFrame([(0, 10.0), (1, 40.0), (2, 30.0), (3, 20.0)], "raw_cluster int, predicted_clv double")
    order = segments.segment_order(first)
    batch = spark.createDataFrame([(0, 99.0), (3, 1.0)], "raw_cluster int, predicted_clv double")
    found = {r.predicted_clv: r.segment_cluster for r in segments.relabel_segments(batch, order=order).collect()}
    assert found == {99.0: 3, 1.0: 2}
