"""Forest fits and tree contributions on large tables: tasks, and what is shuffled, grow no faster than the rows."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidemark import session
from tidemark.operators import explain, lifetime, models
from tidemark.operators.features import CATEGORICAL, NUMERIC


@pytest.fixture(scope="module")
def rows(spark):
    """Features whose label and tenure the contract decides."""
    level = {c: F.concat(F.lit("level "), (F.col("id") % 2).cast("string")) for c in CATEGORICAL}
    number = {c: (F.hash("id", F.lit(i)) % 7).cast("double") for i, c in enumerate(NUMERIC)}
    contract = F.when(F.col("id") % 3 == 0, "Month-to-month").otherwise("One year")
    table = spark.range(1200).withColumns({**level, **number, "contract_type": contract})
    columns = {"customer_id": F.col("id"), "churned": (F.col("id") % 3 == 0).cast("int")}
    return session.stage_table(table.withColumns(columns).drop("id"), "forest-rows")


def tasks(n_rows: int) -> int:
    return n_rows // session.forest_rows_per_task(n_rows) + 1


def test_tasks_of_a_forest_are_bounded_until_they_are_full():
    assert [tasks(n) for n in (0, 499, 500, 12_000)] == [1, 1, 2, 25]
    assert all(tasks(n) <= session.FOREST_TASKS for n in (24_001, 72_000, 720_000, 2_399_999))
    assert tasks(24_000_000) == 481


def test_tasks_of_a_series_of_short_jobs_are_bounded_until_they_are_full():
    parts = {n: n // session.fit_rows_per_task(n) + 1 for n in (0, 19_999, 20_000, 479_999, 720_000, 4_320_000, 48_000_000)}
    assert list(parts.values()) == [1, 1, 2, 24, 24, 24, 241]


@pytest.mark.parametrize("name", ["logistic_regression", "boosted_trees"])
def test_series_of_short_jobs_are_fitted_in_that_many_tasks(rows, monkeypatch, name):
    parts = []

    def counted(df, *sizes):
        dealt = session.spread(df, *sizes)
        parts.append(dealt.rdd.getNumPartitions())
        return dealt

    monkeypatch.setattr(session, "FIT_TASKS", 3)
    monkeypatch.setattr(session, "FIT_ROWS_PER_TASK", 100)
    monkeypatch.setattr(models, "spread", counted)
    models.fit_classifier(rows, name, trees=2)
    assert parts == [3]


@pytest.mark.parametrize("name", models.CLASSIFIERS)
def test_rows_are_encoded_once_and_keep_their_partitions(rows, monkeypatch, name):
    """A classifier reads rows that are stored encoded, with the columns' attributes, and no longer how they came about."""
    given, made = [], models.classifier

    class Watched:
        def __init__(self, *args):
            self.inner = made(*args)

        def fit(self, encoded):
            given.append(encoded)
            return self.inner.fit(encoded)

    monkeypatch.setattr(models, "classifier", Watched)
    monkeypatch.setattr(session, "FIT_ROWS_PER_TASK", 500)
    model = models.fit_classifier(rows, name, trees=2)
    (encoded,) = given
    plan = plan_of(encoded)
    assert encoded.rdd.getNumPartitions() == 3
    assert "ExistingRDD" in plan and "InMemory" not in plan and "Exchange" not in plan
    attributes = encoded.schema["features"].metadata["ml_attr"]["attrs"]
    assert len(attributes["binary"]) + len(attributes["numeric"]) == len(models.feature_names(model))
    assert model.transform(rows).where(F.col("prediction").isNull()).count() == 0


def test_a_model_is_scored_while_others_are_fitted(rows, monkeypatch):
    scored, fit, score = threading.Event(), models.fit_classifier, models.with_probability

    def slow(train, name, **given):
        assert name == "logistic_regression" or scored.wait(60)
        return fit(train, name, **given)

    def watched(*given):
        scored.set()
        return score(*given)

    monkeypatch.setattr(models, "fit_classifier", slow)
    monkeypatch.setattr(models, "with_probability", watched)
    names = ("random_forest", "logistic_regression")
    table, fitted, frames = models.compare_classifiers(rows, rows, names, trees=2)
    assert {r.model for r in table.collect()} == set(fitted) == set(frames) == set(names)


def test_a_forest_of_many_rows_grows_few_trees_a_job():
    mb = [models.classifier("random_forest", n).getMaxMemoryInMB() for n in (1, 480_000, 480_001, 4_320_000)]
    assert mb == [256, 256, 1, 1]


def test_smaller_groups_grow_all_trees_of_a_forest(rows, monkeypatch):
    monkeypatch.setattr(session, "FOREST_GROUP_ROWS", 100)
    model = models.fit_classifier(rows, "random_forest", trees=40).stages[-1]
    assert model.getNumTrees == 40 and min(tree.numNodes for tree in model.trees) > 1


@pytest.mark.parametrize("fit", ["random_forest", "lifetime"])
def test_forests_are_fitted_in_that_many_tasks(rows, monkeypatch, fit):
    parts = []

    def counted(df, *sizes):
        dealt = session.spread(df, *sizes)
        parts.append(dealt.rdd.getNumPartitions())
        return dealt

    monkeypatch.setattr(session, "FOREST_TASKS", 2)
    monkeypatch.setattr(session, "FOREST_ROWS_PER_TASK", 10_000)
    monkeypatch.setattr(models if fit == "random_forest" else lifetime, "spread", counted)
    if fit == "random_forest":
        models.fit_classifier(rows, fit, trees=2)
    else:
        lifetime.fit_lifetime_model(rows.withColumn("churned", F.lit(1)), trees=2)
    assert parts == [2]


@pytest.mark.parametrize("name", ["random_forest", "boosted_trees"])
def test_contributions_join_rows_by_key_alone(rows, name):
    """No join by key and slot; rows with the same key, or none, are added up."""
    model = models.fit_classifier(rows, name, trees=3)
    twice = rows.where("customer_id < 3").unionByName(rows.where("customer_id = 1"))
    twice = twice.withColumn("customer_id", F.when(F.col("customer_id") != 2, F.col("customer_id")))
    once, _, _ = explain.tree_contributions(model, rows.where("customer_id < 3"))
    long_form, _, _ = explain.tree_contributions(model, twice)
    single = {(r.customer_id, r.feature): r.contribution for r in once.collect()}
    found = {}
    for r in long_form.collect():
        found.setdefault((r.customer_id, r.feature), []).append(r.contribution)
    for feature in models.feature_names(model):
        assert found[0, feature] == [pytest.approx(single[0, feature])]
        assert found[1, feature] == [pytest.approx(2 * single[1, feature])] * 2
        assert found[None, feature] == [pytest.approx(single[2, feature])]
    shape = plan_of(long_form).split("== Physical Plan ==")[1].split("\n\n")[0].split("== Initial Plan ==")[-1]
    assert shape.count("Join") == 2
