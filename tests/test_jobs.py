from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import checks
from tidemark.operators.features import feature_table
from tidemark.plans import jobs, views
from tidemark.sources import files, table_set
from tidemark.sources.star_tables import AS_OF, planted_label


def raw_files(star, folder, **changes):
    """The domain tables as CSV, with text keys and unique refund ids."""
    for name, df in star.all_tables().items():
        if name == "transactions":
            df = df.dropDuplicates(["transaction_id"])
        df = changes.get(name, lambda x: x)(df)
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.RAW_TABLES[name]]
        files.write_csv(df.select(columns), f"{folder}/{name}.csv")


def published(spark, folder, **schema):
    return table_set.read_tables(spark, str(folder), schema)[next(iter(schema))]


def test_load_job(spark, star, tmp_path):
    raw_files(star, tmp_path / "raw")
    counts = {r.table_name: r.n_rows for r in jobs.load_job(spark, str(tmp_path / "raw"), str(tmp_path / "db")).collect()}
    assert counts["customers"] == 150 and set(counts) == set(schemas.RAW_TABLES)
    assert published(spark, tmp_path / "db", ml_predictions=schemas.PREDICTIONS).count() == 0
    opened = jobs.open_tables(spark, str(tmp_path / "db"))
    assert opened["subscriptions"].schema == schemas.SUBSCRIPTIONS
    total = opened["transactions"].agg(F.sum("amount")).first()[0]
    assert total == star.transactions.dropDuplicates(["transaction_id"]).agg(F.sum("amount")).first()[0]


def test_failed_load_keeps_the_former_tables(spark, star, tmp_path):
    db = str(tmp_path / "db")
    raw_files(star, tmp_path / "raw")
    jobs.load_job(spark, str(tmp_path / "raw"), db)
    raw_files(star, tmp_path / "bad", customers=lambda df: df.where("customer_id <> 3"))
    with pytest.raises(checks.CheckFailed, match="subscriptions.customer_id: reference"):
        jobs.load_job(spark, str(tmp_path / "bad"), db)
    assert jobs.open_tables(spark, db)["customers"].count() == 150
    stored = {t: {p.name for p in (tmp_path / "db" / t).iterdir()} for t in schemas.RAW_TABLES}
    assert all(len(folders) == 1 for folders in stored.values())
    raw_files(star, tmp_path / "broken")
    for check in (tmp_path / "broken" / "churn_events.csv").glob(".*.crc"):
        check.unlink()
    for part in (tmp_path / "broken" / "churn_events.csv").glob("part-*"):
        part.write_text(part.read_text().replace(",1,", ",1.5,"))
    with pytest.raises(Exception, match="is no whole number"):
        jobs.load_job(spark, str(tmp_path / "broken"), db)
    assert stored == {t: {p.name for p in (tmp_path / "db" / t).iterdir()} for t in schemas.RAW_TABLES}
    raw_files(star, tmp_path / "more", support_tickets=lambda df: df.limit(5))
    jobs.load_job(spark, str(tmp_path / "more"), db)
    assert jobs.open_tables(spark, db)["support_tickets"].count() == 5
    assert jobs.open_tables(spark, db, set_number=1)["support_tickets"].count() > 5


def test_model_publish_and_report(spark, star, tmp_path):
    features = planted_label(feature_table(star.customers, star.subscriptions, star.support_tickets))
    run = jobs.model_job(features, str(tmp_path / "models"), ("logistic_regression", "random_forest"), trees=5, restarts=2)
    table = run.comparison.collect()
    assert run.best_name == table[0].model and len(table) == 2
    assert files.read_metadata(spark, f"{run.folder}/metadata")["best_model"] == run.best_name
    assert run.scored.count() == 150 and run.lifetime_error.count() == 1
    left = {p.name for p in Path(run.folder).iterdir()}
    assert left == {
        "churn", "lifetime", "segments", "segment_order", "metadata", "background", "model_comparison.csv", "roc_points.csv",
        "drivers.csv", "feature_names.csv",
    }
    curves = spark.read.option("header", True).csv(f"{run.folder}/roc_points.csv")
    assert {r.model for r in curves.select("model").distinct().collect()} == {"logistic_regression", "random_forest"}

    saved = jobs.open_model(spark, str(tmp_path / "models"))
    profiles = features.withColumnRenamed("customer_id", "profile_id").where("profile_id < 5")
    scores, reasons = jobs.profile_job(saved, profiles)
    assert scores.count() == 5
    assert reasons.select("profile_id").distinct().count() == 5
    again = jobs.score_job(saved, features)
    columns = ["customer_id", "churn_probability", "risk_tier", "predicted_clv", "segment_cluster"]
    assert sorted(map(tuple, again.select(columns).collect())) == sorted(map(tuple, run.scored.select(columns).collect()))
    jobs.publish_job(again, str(tmp_path / "again"), dt.datetime(2001, 8, 2), saved.metadata["model_version"] + "-x")
    kind = schemas.with_key_type(schemas.PREDICTIONS, schemas.T.LongType())
    assert published(spark, tmp_path / "again", ml_predictions=kind).first().model_version == "v1.0-x"

    when = dt.datetime(2001, 8, 1, 12)
    _, snapshot_path = jobs.publish_job(run.scored, str(tmp_path / "out"), when)
    kept = schemas.with_key_type(schemas.FEATURES_SCORED, schemas.T.LongType())
    kept = published(spark, tmp_path / "out", features_scored=kept)
    assert kept.where("predicted_clv IS NULL OR segment_label IS NULL OR churned IS NULL").count() == 0
    comparison = files.read_csv(spark, f"{run.folder}/model_comparison.csv", schemas.MODEL_COMPARISON)
    assert sorted(map(tuple, comparison.collect())) == sorted(map(tuple, table))
    text_key = schemas.with_key_type(schemas.PREDICTIONS, schemas.T.LongType())
    predictions = published(spark, tmp_path / "out", ml_predictions=text_key)
    with pytest.raises(table_set.SetConflict):  # the customers that were scored have been replaced since
        jobs.publish_job(run.scored, str(tmp_path / "out"), when, before=table_set.TableSet())
    assert published(spark, tmp_path / "out", ml_predictions=text_key).count() == 150
    assert predictions.count() == 150 and predictions.first().scored_at == when
    snapshot = files.read_csv(spark, snapshot_path, schemas.with_key_type(schemas.SNAPSHOT, schemas.T.LongType()))
    assert snapshot.where("segment_label IS NULL").count() == 0

    names = views.register_views(star.all_tables(), predictions, AS_OF)
    assert len(names) == 10
    assert spark.sql("SELECT sum(customers) AS n FROM vw_revenue_at_risk").first().n == star.subscriptions.where("is_active = 1").count()

    lines = jobs.statistics_job(features, str(tmp_path / "report"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "report")).collect()) == sorted(lines)
    assert any(line.startswith("  contract_type: X2 ") for line in lines)
    assert "  tech_supportNo internet service: NA (SE NA, z NA, p NA)" in lines


def test_versions_of_models_are_kept(spark, star, tmp_path):
    features = planted_label(feature_table(star.customers, star.subscriptions, star.support_tickets))
    folder = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError, match="no model version"):
        jobs.open_model(spark, folder)

    def run(version, label):
        rows = features.withColumn("churned", F.expr(label))
        return jobs.model_job(rows, folder, ("logistic_regression",), trees=2, restarts=1, model_version=version)

    first, second = run("a", "churned"), run("b", "1 - churned")
    listed = {r.model_version: r.is_current for r in jobs.model_versions(spark, folder).collect()}
    assert listed == {"a": 0, "b": 1}
    columns = ["customer_id", "churn_probability", "segment_cluster"]
    for version, found in (("a", first), ("b", second), (None, second)):
        again = jobs.score_job(jobs.open_model(spark, folder, version), found.scored.select(features.columns))
        assert sorted(map(tuple, again.select(columns).collect())) == sorted(map(tuple, found.scored.select(columns).collect()))
    with pytest.raises(ValueError, match="no label"):
        run("c", "cast(null as int)")
    assert {r.model_version for r in jobs.model_versions(spark, folder).collect()} == {"a", "b"}
    assert not (tmp_path / "models" / "version=c").exists()


def test_features_job(spark, star, tmp_path):
    rate = jobs.features_job(star.all_tables(), str(tmp_path / "features.csv")).first()
    assert rate.n_rows == 150
    schema = schemas.with_key_type(schemas.FEATURES, schemas.T.LongType())
    back = files.read_csv(spark, str(tmp_path / "features.csv"), schema)
    assert back.count() == 150
    assert back.agg(F.sum("churned"), F.sum("monthly_charges")).first() == (
        feature_table(star.customers, star.subscriptions, star.support_tickets)
        .agg(F.sum("churned"), F.sum("monthly_charges")).first()
    )
