"""End-to-end jobs: load, features, model and score, profiles, publish, statistics report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tidemark.operators import checks, explain, inference, lifetime, models, scoring, segments, splits
from tidemark.operators.evaluation import best_model, roc_points
from tidemark.operators.features import CATEGORICAL, NUMERIC, feature_table, overall_churn_rate
from tidemark.schemas import MODEL_METADATA, PREDICTIONS, RAW_TABLES, SEGMENT_ORDER
from tidemark.session import stage_table
from tidemark.sources import files, table_set


#: Tables that follow from the raw ones; a load empties them.
DERIVED_TABLES = {"ml_predictions": PREDICTIONS}


def load_job(spark: SparkSession, raw_folder: str, table_folder: str) -> DataFrame:
    """Read the five CSV tables, stop on any failed check, replace the stored tables; returns row counts.

    The CSV is parsed once, into folders that no reader sees; the checks read those, each at most twice. All tables are
    published in one step, together with an empty table of predictions, as the former ones are about former customers.
    A reader sees either the former tables or the new ones. A failed load, and one that another load overtook, leaves
    nothing behind.
    """
    with table_set.replacing(spark, table_folder) as writer:
        written = {
            name: writer.write(name, files.read_csv(spark, f"{raw_folder}/{name}.csv", schema))
            for name, schema in RAW_TABLES.items()
        }
        report = stage_table(checks.load_report(written), "checks")
        checks.enforce(report)
        for name, schema in DERIVED_TABLES.items():
            writer.write(name, spark.createDataFrame([], schema))
    return checks.counted_rows(report)


def open_tables(spark: SparkSession, table_folder: str, set_number: int | None = None) -> dict[str, DataFrame]:
    """The raw tables of the newest set, or of the one with that number."""
    return table_set.read_tables(spark, table_folder, RAW_TABLES, table_set.read_set(spark, table_folder, set_number))


def features_job(opened: dict[str, DataFrame], path: str) -> DataFrame:
    """Build the feature table and write it as CSV; returns the churn rate."""
    rows = stage_table(
        feature_table(opened["customers"], opened["subscriptions"], opened["support_tickets"]), "features"
    )
    files.write_csv(rows, path)
    return overall_churn_rate(rows)


@dataclass
class ModelRun:
    """What a model run leaves behind."""

    comparison: DataFrame
    best_name: str
    best: PipelineModel
    lifetime_error: DataFrame
    scored: DataFrame
    model_version: str
    folder: str


@dataclass
class SavedModel:
    """The published models, their metadata, the order of the segments, and the rows that explanations compare with."""

    model: PipelineModel
    metadata: dict
    background: DataFrame
    lifetime: PipelineModel
    segments: PipelineModel
    segment_order: DataFrame


def split_features(features: DataFrame, seed: int = models.SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, stratified by the label, staged because training reads them many times."""
    parts = stage_table(splits.exact_split(features, "customer_id", models.LABEL, seed=seed), "split")
    return parts.where("not is_test").drop("is_test"), parts.where("is_test").drop("is_test")


def model_job(
    features: DataFrame,
    model_folder: str,
    names: tuple[str, ...] = models.CLASSIFIERS,
    trees: int = 300,
    restarts: int = 10,
    seed: int = models.SEED,
    model_version: str = scoring.MODEL_VERSION,
) -> ModelRun:
    """Compare classifiers, keep the best, add lifetime, value and segment, and score every customer.

    A version is a folder of its own with the three models, the metadata, the rows that explanations compare with, and
    as CSV the comparison, the ROC points, the drivers of the best model and the feature names. It is published when all
    of it is there, as the current one; earlier versions stay and can be opened by name. A version that is trained again
    replaces its former run.
    """
    spark = features.sparkSession
    with table_set.replacing(spark, model_folder) as writer:
        folder = writer.place(f"version={model_version}")
        run = _train(features, folder, names, trees, restarts, seed, model_version)
        writer.notes["current"] = model_version
    return run


def _train(
    features: DataFrame, folder: str, names: tuple[str, ...], trees: int, restarts: int, seed: int, model_version: str
) -> ModelRun:
    spark = features.sparkSession
    features = stage_table(features, "features")
    train, test = split_features(features, seed)
    comparison, fitted, scored_tests = models.compare_classifiers(train, test, names, trees, seed)
    best_name = best_model(comparison).first()["model"]
    best = fitted[best_name]
    models.save_model(best, f"{folder}/churn")
    files.write_metadata(spark, f"{folder}/metadata", best_name, CATEGORICAL, NUMERIC, model_version)
    test.write.parquet(f"{folder}/background")
    drivers = explain.driver_ranking(explain.additive_contributions(best, test, test)[0])
    curves = [roc_points(frame).select(F.lit(name).alias("model"), "*") for name, frame in scored_tests.items()]
    reports = {
        "model_comparison": comparison,
        "roc_points": reduce(DataFrame.unionByName, curves),
        "drivers": drivers,
        "feature_names": models.feature_name_table(spark, best),
    }
    for name, table in reports.items():
        files.write_csv(table, f"{folder}/{name}.csv")

    lifetime_model, lifetime_error = lifetime.fit_lifetime_model(features, trees, seed)
    models.save_model(lifetime_model, f"{folder}/lifetime")
    valued = stage_table(lifetime.predicted_clv(lifetime.predict_lifetime(lifetime_model, features)), "valued")
    clusters = segments.fit_segments(valued, restarts=restarts, seed=seed)
    models.save_model(clusters, f"{folder}/segments")
    assigned = stage_table(segments.assign_cluster(clusters, valued), "clusters")
    segments.segment_order(assigned).write.parquet(f"{folder}/segment_order")
    order = spark.read.schema(SEGMENT_ORDER).parquet(f"{folder}/segment_order")
    scored = stage_table(scoring.score_customers(best, segments.relabel_segments(assigned, order=order)), "scored")
    return ModelRun(comparison, best_name, best, lifetime_error, scored, model_version, folder)


def version_folder(spark: SparkSession, model_folder: str, model_version: str | None = None) -> str:
    """Folder of a version, of the current one without a name."""
    published = table_set.read_set(spark, model_folder)
    name = model_version or published.notes.get("current")
    if f"version={name}" not in published.folders:
        raise FileNotFoundError(f"no model version {name} under {model_folder}")
    return f"{model_folder}/{published.folders[f'version={name}']}"


def model_versions(spark: SparkSession, model_folder: str) -> DataFrame:
    """Metadata of every version, and which of them is current."""
    published = table_set.read_set(spark, model_folder)
    parts = [
        spark.read.schema(MODEL_METADATA).json(f"{model_folder}/{folder}/metadata").withColumn(
            "is_current", F.lit(int(name == f"version={published.notes.get('current')}"))
        )
        for name, folder in sorted(published.folders.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def open_model(spark: SparkSession, model_folder: str, model_version: str | None = None) -> SavedModel:
    """The models of a version, of the current one without a name."""
    folder = version_folder(spark, model_folder, model_version)
    return SavedModel(
        models.load_model(f"{folder}/churn"),
        files.read_metadata(spark, f"{folder}/metadata"),
        spark.read.parquet(f"{folder}/background"),
        models.load_model(f"{folder}/lifetime"),
        models.load_model(f"{folder}/segments"),
        spark.read.schema(SEGMENT_ORDER).parquet(f"{folder}/segment_order"),
    )


def score_job(saved: SavedModel, features: DataFrame) -> DataFrame:
    """Score a batch of features with saved models only: value, segment by the saved numbering, probability, tier."""
    valued = lifetime.predicted_clv(lifetime.predict_lifetime(saved.lifetime, features))
    assigned = segments.assign_cluster(saved.segments, valued)
    segmented = segments.relabel_segments(assigned, order=saved.segment_order)
    return stage_table(scoring.score_customers(saved.model, segmented), "scored")


def profile_job(saved: SavedModel, profiles: DataFrame, key: str = "profile_id") -> tuple[DataFrame, DataFrame]:
    """Score profiles with the published model: (probability and tier, contributions in long form)."""
    columns = [key, *saved.metadata["categorical"], *saved.metadata["numeric"]]
    return scoring.score_profiles(saved.model, profiles.select(columns), saved.background, key)


def publish_job(
    scored: DataFrame,
    table_folder: str,
    scored_at: dt.datetime,
    model_version: str = scoring.MODEL_VERSION,
    before: table_set.TableSet | None = None,
) -> tuple[str, str]:
    """Replace the tables of scored features and predictions in one step, and write the snapshot as CSV.

    The tables belong to the set that a load publishes. `before` is the set whose customers were scored; a load since
    then makes this fail (`SetConflict`), as the scores are about former customers. The snapshot gets a new folder per
    run. Returns the paths of predictions and snapshot.
    """
    spark = scored.sparkSession
    published = table_set.replace_tables(spark, table_folder, {
        "features_scored": scored,
        "ml_predictions": scoring.prediction_table(scored, scored_at, model_version),
    }, before)
    path = f"{table_folder}/snapshot_{scored_at:%Y%m%d%H%M%S}.csv"
    files.write_csv(scoring.snapshot(scored), path)
    return f"{table_folder}/{published.folders['ml_predictions']}", path


def report_lines(
    features: DataFrame,
    factors: tuple[str, ...] = inference.GLM_FACTORS,
    numbers: tuple[str, ...] = inference.GLM_NUMBERS,
) -> list[str]:
    """Rendered statistics report, with a regression on `factors` and `numbers`; its inputs are tables of a few rows each.

    p-values have six digits in tests and three in the regression, whose estimates come from an iteration.
    """
    features = stage_table(features, "report")
    glm = inference.glm_logit(features, factors, numbers)
    fit = glm.fit.first()

    def shown(value: float | None, pattern: str) -> str:
        return "NA" if value is None else format(value, pattern)

    def p_value(r: Row, pattern: str = ".6g") -> str:
        """Below the smallest double only the exponent is known."""
        return f"1e{r.log10_p:.0f}" if r.p_value == 0.0 else shown(r.p_value, pattern)

    lines = ["Logistic regression of churn on its drivers"]
    lines += [
        f"  {r.term}: {shown(r.estimate, '.6f')} (SE {shown(r.std_error, '.6f')}, z {shown(r.z, '.3f')}, "
        f"p {p_value(r, '.3g')})"
        for r in glm.coefficients.orderBy("position").collect()
    ]
    lines.append(
        f"  deviance {fit.null_deviance:.1f} ({fit.null_df} df) without terms, "
        f"{fit.residual_deviance:.1f} ({fit.residual_df} df) with terms, AIC {fit.aic:.1f}, "
        f"McFadden R2 {inference.mcfadden_r2(glm.fit).first()[0]:.4f}"
    )
    lines.append("Odds ratios with 95% intervals")
    lines += [
        f"  {r.term}: {shown(r.odds_ratio, '.3f')} [{shown(r.lower, '.3f')}, {shown(r.upper, '.3f')}]"
        for r in inference.odds_ratios(glm.coefficients).orderBy("position").collect()
    ]
    lines.append("Chi-square tests of churn and category")
    lines += [
        f"  {r.variable}: X2 {shown(r.statistic, '.2f')}, df {r.df}, p {p_value(r)}"
        for r in inference.chi_square_tests(features).orderBy("variable").collect()
    ]
    lines.append("Welch t-tests, retained minus churned")
    lines += [
        f"  {r.variable}: means {shown(r.mean_retained, '.2f')} and {shown(r.mean_churned, '.2f')}, "
        f"t {shown(r.t, '.2f')}, df {shown(r.df, '.1f')}, p {p_value(r)}"
        for r in inference.welch_tests(features).orderBy("variable").collect()
    ]
    return lines


def statistics_job(
    features: DataFrame,
    path: str,
    factors: tuple[str, ...] = inference.GLM_FACTORS,
    numbers: tuple[str, ...] = inference.GLM_NUMBERS,
) -> list[str]:
    """Write the statistics report as text."""
    lines = report_lines(features, factors, numbers)
    files.write_text(features.sparkSession, lines, path)
    return lines
