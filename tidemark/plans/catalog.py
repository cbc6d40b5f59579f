"""Catalogue of queries over the star-schema folder: name -> (spark, folder) -> DataFrame.

Results are made comparable across engines: decimals as doubles, dates as text, doubles rounded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import schemas
from tidemark.functions import calendar, rules
from tidemark.operators import (
    billing, checks, churn, dashboard, evaluation, explain, features, inference, lifetime, models, revenue,
    scoring, segments, splits,
)
from tidemark.plans import jobs, views
from tidemark.session import new_path, stage_table
from tidemark.sources import files, table_set, tables
from tidemark.sources.star_tables import AS_OF, SCORECARD_WEIGHTS, StarTables, planted_label

Query = Callable[[SparkSession, str], DataFrame]
SCORED_AT = dt.datetime(2001, 8, 1, 12, 0, 0)
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles for decimals, text for dates and times, 0/1 for booleans, doubles rounded."""

    def convert(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            return F.round(column.cast("double"), digits).alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, T.BooleanType):
            return column.cast("int").alias(field.name)
        return column

    return df.select(*[convert(f) for f in df.schema])


def query(name: str, digits: int = 6) -> Callable[[Callable[[StarTables], DataFrame]], Callable]:
    """Register a function of the domain tables under a name."""

    def register(build: Callable[[StarTables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, folder: plain(build(StarTables(spark, folder)), digits)
        return build

    return register


def feature_rows(t: StarTables) -> DataFrame:
    return features.feature_table(t.customers, t.subscriptions, t.support_tickets)


def planted_rows(t: StarTables) -> DataFrame:
    """Features with a label drawn from the scorecard, and the scorecard's probability."""
    probability = rules.scorecard_probability(SCORECARD_WEIGHTS)
    return planted_label(feature_rows(t)).withColumn("churn_probability", rules.half_even(probability, 5))


def valued_rows(t: StarTables) -> DataFrame:
    """Features with probability, tier and value; total tenure is a given number, not a fitted one."""
    given = (F.col("customer_id") % 97).cast("double") + 0.5
    probability = rules.scorecard_probability(SCORECARD_WEIGHTS)
    valued = lifetime.predicted_clv(feature_rows(t).withColumn("predicted_tenure", given))
    return scoring.with_risk(valued.withColumn("churn_probability", probability))


def scored_rows(t: StarTables) -> DataFrame:
    """As above with segments, from given raw clusters by charge band."""
    raw = (F.floor(F.col("monthly_charges") / 32) % 4).cast("int")
    return segments.relabel_segments(valued_rows(t).withColumn("raw_cluster", raw))


def snapshot_rows(t: StarTables) -> DataFrame:
    return scoring.snapshot(scored_rows(t))


def prediction_rows(t: StarTables) -> DataFrame:
    return scoring.prediction_table(scored_rows(t), SCORED_AT)


# --- sources and sinks


@query("csv_round_trip")
def _(t: StarTables) -> DataFrame:
    path = new_path(t.spark, "subscriptions-csv")
    files.write_csv(t.subscriptions, path)
    schema = schemas.with_key_type(schemas.SUBSCRIPTIONS, T.LongType())
    return files.read_csv(t.spark, path, schema)


@query("snapshot_csv")
def _(t: StarTables) -> DataFrame:
    path = new_path(t.spark, "snapshot-csv")
    files.write_csv(snapshot_rows(t), path)
    return files.read_csv(t.spark, path, schemas.with_key_type(schemas.SNAPSHOT, T.LongType()))


@query("table_append")
def _(t: StarTables) -> DataFrame:
    path = new_path(t.spark, "transactions")
    everything = t.transactions
    for kind in ("charge", "refund"):
        tables.append_table(everything.where(F.col("transaction_type") == kind), path)
    stored = t.spark.read.schema(everything.schema).parquet(path)
    return stored.groupBy("transaction_type", "status").agg(
        F.count("*").alias("n_rows"), F.sum("amount").alias("amount")
    )


@query("table_replace")
def _(t: StarTables) -> DataFrame:
    root = new_path(t.spark, "subscriptions")
    tables.replace_table(t.subscriptions, root)
    stored = tables.read_table(t.spark, root, t.subscriptions.schema)
    tables.replace_table(stored.where(F.col("is_active") == 1), root)
    return (
        tables.read_table(t.spark, root, t.subscriptions.schema)
        .groupBy("contract_type")
        .agg(F.count("*").alias("n_rows"), F.sum("monthly_charges").alias("monthly_charges"))
    )


@query("table_set_replace")
def _(t: StarTables) -> DataFrame:
    """Totals of five tables that are published together twice, read from the first set and from the second."""
    root = new_path(t.spark, "database")
    raw = t.all_tables()
    first = table_set.replace_tables(t.spark, root, raw)
    schema_of = {name: df.schema for name, df in raw.items()}
    opened = table_set.read_tables(t.spark, root, schema_of, first)
    ended = opened["subscriptions"].where("is_active = 0").select("customer_id").distinct()
    second = table_set.replace_tables(
        t.spark, root, {name: opened[name].join(ended, "customer_id", "left_semi") for name in ("customers", "transactions")}
    )
    amounts = {"subscriptions": "monthly_charges", "transactions": "amount"}
    parts = [
        df.agg(
            F.count("*").alias("n_rows"),
            F.coalesce(F.sum(amounts[name]), F.lit(0)).cast("double").alias("amount") if name in amounts
            else F.lit(0.0).alias("amount"),
        ).select(F.lit(of.number).alias("set_number"), F.lit(name).alias("table_name"), "*")
        for of in (first, second)
        for name, df in table_set.read_tables(t.spark, root, schema_of, of).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("named_views")
def _(t: StarTables) -> DataFrame:
    names = views.register_views(t.all_tables(), prediction_rows(t), AS_OF)
    return t.spark.sql(
        " UNION ALL ".join(f"SELECT '{name}' AS view_name, count(*) AS n_rows FROM {name}" for name in names)
    )


# --- data checks


@query("pk_check")
def _(t: StarTables) -> DataFrame:
    return checks.key_report(t.all_tables())


@query("null_check")
def _(t: StarTables) -> DataFrame:
    return checks.null_report(t.all_tables())


@query("fk_check")
def _(t: StarTables) -> DataFrame:
    return checks.reference_report({**t.all_tables(), "predictions": prediction_rows(t)})


@query("load_checks")
def _(t: StarTables) -> DataFrame:
    """Everything the load insists on, in one report with the rows of each table."""
    return checks.load_report(t.all_tables())


@query("row_counts")
def _(t: StarTables) -> DataFrame:
    return checks.row_counts(t.all_tables())


# --- metric views


@query("mrr_by_month")
def _(t: StarTables) -> DataFrame:
    return revenue.mrr_by_month(t.subscriptions, t.transaction_dates)


@query("churned_by_month")
def _(t: StarTables) -> DataFrame:
    return churn.churned_by_month(t.churn_events)


for _name, _column in {
    "churn_rate_by_contract": "contract_type",
    "churn_rate_by_internet": "internet_service",
    "churn_rate_by_payment": "payment_method",
}.items():
    query(_name)(lambda t, column=_column: churn.churn_rate_by(t.subscriptions, column))


@query("tenure_buckets")
def _(t: StarTables) -> DataFrame:
    return churn.tenure_buckets(t.subscriptions)


@query("customer_clv")
def _(t: StarTables) -> DataFrame:
    return revenue.customer_clv(t.customers, t.subscriptions, t.transactions)


@query("cohort_lifetime")
def _(t: StarTables) -> DataFrame:
    return churn.cohort_lifetime(t.customers, t.subscriptions, t.churn_events, AS_OF)


@query("revenue_at_risk")
def _(t: StarTables) -> DataFrame:
    return revenue.revenue_at_risk(valued_rows(t), t.subscriptions)


@query("tickets_vs_churn")
def _(t: StarTables) -> DataFrame:
    return churn.tickets_vs_churn(t.subscriptions, t.support_tickets)


# --- scalar functions


@query("calendar_columns")
def _(t: StarTables) -> DataFrame:
    start, end = F.col("start_date"), F.coalesce("end_date", F.lit(AS_OF))
    return t.subscriptions.select(
        "subscription_id",
        calendar.month_label("start_date").alias("month_label"),
        calendar.month_start("start_date").alias("month_start"),
        calendar.first_month_on_or_after(start).alias("first_full_month"),
        calendar.whole_months(start, end).alias("whole_months"),
        calendar.periods_of_30_days(start, end).alias("periods"),
        calendar.plus_periods(start, F.col("tenure_months")).alias("last_billing"),
    )


@query("value_columns")
def _(t: StarTables) -> DataFrame:
    return planted_rows(t).select(
        "customer_id",
        rules.customer_code(F.col("customer_id") + 1).alias("customer_code"),
        rules.clip(F.col("monthly_charges").cast("double"), 30.0, 90.0).alias("clipped_charge"),
        rules.tenure_bucket("tenure_months").alias("tenure_bucket"),
        rules.at_least_half("churn_probability").alias("predicted"),
        rules.segment_label(F.col("customer_id") % 5).alias("segment_label"),
        F.greatest(F.col("tenure_months"), (F.col("customer_id") % 97).cast("int")).alias("larger"),
        rules.logistic(F.col("tenure_months").cast("double") / 12 - 5).alias("logistic"),
        F.try_divide(F.col("monthly_charges").cast("double"), F.col("ticket_count")).alias("charge_per_ticket"),
    )


# --- features, splits, evaluation


@query("feature_table")
def _(t: StarTables) -> DataFrame:
    return feature_rows(t)


@query("overall_churn_rate")
def _(t: StarTables) -> DataFrame:
    return features.overall_churn_rate(feature_rows(t))


@query("class_weights")
def _(t: StarTables) -> DataFrame:
    return models.class_weights(planted_rows(t))


@query("stratified_split")
def _(t: StarTables) -> DataFrame:
    labels = stage_table(planted_rows(t).select("customer_id", "churned"), "labels")
    return splits.exact_split(labels, "customer_id", "churned")


@query("stratified_split_hot_key")
def _(t: StarTables) -> DataFrame:
    """Sizes of the split where one key holds a third of the rows and the cut may fall into it."""
    key = F.when(F.col("customer_id") % 3 == 0, -1).otherwise(F.col("customer_id")).alias("customer_id")
    labels = stage_table(planted_rows(t).select(key, "churned"), "labels")
    split = splits.exact_split(labels, "customer_id", "churned")
    return split.groupBy("churned", F.col("is_test").cast("int").alias("is_test")).agg(F.count("*").alias("n_rows"))


@query("random_split")
def _(t: StarTables) -> DataFrame:
    ended = stage_table(feature_rows(t).where(F.col("churned") == 1).select("customer_id"), "ended")
    return splits.exact_split(ended, "customer_id")


@query("sample_rows")
def _(t: StarTables) -> DataFrame:
    return splits.sample_rows(feature_rows(t).select("customer_id", "churned"), "customer_id", 500)


@query("binary_metrics", digits=4)
def _(t: StarTables) -> DataFrame:
    return evaluation.binary_metrics(planted_rows(t), decimals=5)


@query("binary_metrics_unrounded", digits=4)
def _(t: StarTables) -> DataFrame:
    probability = rules.scorecard_probability(SCORECARD_WEIGHTS)
    return evaluation.binary_metrics(planted_rows(t).withColumn("churn_probability", probability))


@query("roc_points")
def _(t: StarTables) -> DataFrame:
    return evaluation.roc_points(planted_rows(t), decimals=5)


def _score_variants(t: StarTables) -> DataFrame:
    """Metrics of three fixed scorecards: all drivers, without contract, charge only."""
    planted = stage_table(planted_rows(t), "planted")
    no_contract = {**SCORECARD_WEIGHTS, "month_to_month": 0.0, "two_year": 0.0}
    charge_only = {name: 0.0 for name in rules.SCORECARD if name != "monthly_charges"}
    variants = {"all_drivers": SCORECARD_WEIGHTS, "no_contract": no_contract, "charge_only": charge_only}
    parts = [
        evaluation.binary_metrics(
            planted.withColumn("churn_probability", rules.half_even(rules.scorecard_probability(weights), 5)), decimals=5
        ).select(F.lit(name).alias("model"), "*")
        for name, weights in variants.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("score_comparison", digits=4)
def _(t: StarTables) -> DataFrame:
    return _score_variants(t)


@query("best_model_pick", digits=4)
def _(t: StarTables) -> DataFrame:
    return evaluation.best_model(_score_variants(t))


@query("regression_metrics")
def _(t: StarTables) -> DataFrame:
    ended = feature_rows(t).where(F.col("churned") == 1)
    given = 40 + (F.col("customer_id") % 31).cast("double")
    return evaluation.regression_metrics(ended.withColumn("given", given), "tenure_months", "given")


@query("encoded_features")
def _(t: StarTables) -> DataFrame:
    rows = stage_table(feature_rows(t), "encoded")
    model = Pipeline(stages=models.encoder(features.CATEGORICAL, features.NUMERIC)).fit(rows)
    names = F.array(*[F.lit(n) for n in models.feature_names(model)])
    values = vector_to_array("features")
    pairs = F.arrays_zip(names.alias("feature"), values.alias("value"))
    return model.transform(rows).select("customer_id", F.inline(pairs)).toDF("customer_id", "feature", "value")


@query("feature_names")
def _(t: StarTables) -> DataFrame:
    rows = stage_table(feature_rows(t), "names")
    model = Pipeline(stages=models.encoder(features.CATEGORICAL, features.NUMERIC)).fit(rows)
    return models.feature_name_table(t.spark, model)


def _scorecard_contributions(t: StarTables) -> DataFrame:
    """Contributions of the fixed scorecard on all rows, against their mean."""
    terms = rules.scorecard_terms()
    sample = stage_table(
        feature_rows(t).select("customer_id", *[c.alias(f"x_{n}") for n, c in terms.items()]), "scorecard"
    )
    centre = sample.agg(*[F.avg(f"x_{n}") for n in terms]).first()
    weights = {**rules.SCORECARD, **SCORECARD_WEIGHTS}
    values = F.array(*[F.col(f"x_{n}") for n in terms])
    return explain.contributions(
        sample, "customer_id", values, list(terms), [weights[n] for n in terms], list(centre)
    )


@query("scorecard_contributions")
def _(t: StarTables) -> DataFrame:
    return _scorecard_contributions(t)


@query("scorecard_drivers")
def _(t: StarTables) -> DataFrame:
    return explain.driver_ranking(_scorecard_contributions(t), explain.TOP_DRIVERS)


# --- value, segments, scores


@query("predicted_clv")
def _(t: StarTables) -> DataFrame:
    return valued_rows(t).select("customer_id", "predicted_total_tenure_months", "predicted_clv")


@query("segment_relabel")
def _(t: StarTables) -> DataFrame:
    return scored_rows(t).select("customer_id", "segment_cluster", "segment_label")


@query("segment_profile")
def _(t: StarTables) -> DataFrame:
    return segments.segment_profile(scored_rows(t))


@query("risk_tier")
def _(t: StarTables) -> DataFrame:
    return valued_rows(t).select("customer_id", "churn_probability", "risk_tier")


@query("prediction_table")
def _(t: StarTables) -> DataFrame:
    return prediction_rows(t)


@query("risk_total_all")
def _(t: StarTables) -> DataFrame:
    return scoring.risk_total(valued_rows(t))


@query("snapshot_export")
def _(t: StarTables) -> DataFrame:
    return snapshot_rows(t)


@query("tier_counts")
def _(t: StarTables) -> DataFrame:
    return scoring.tier_counts(valued_rows(t))


# --- billing


@query("billing_schedule")
def _(t: StarTables) -> DataFrame:
    return billing.billing_schedule(t.subscriptions)


@query("logistic_scorecard")
def _(t: StarTables) -> DataFrame:
    probability = rules.scorecard_probability(SCORECARD_WEIGHTS)
    return feature_rows(t).select("customer_id", probability.alias("churn_probability"))


@query("churn_events_extract")
def _(t: StarTables) -> DataFrame:
    return t.churn_events


@query("capped_tenure")
def _(t: StarTables) -> DataFrame:
    long_tenures = t.subscriptions.withColumn("tenure_months", F.col("tenure_months") + 5)
    return billing.capped_tenure(long_tenures, AS_OF).select("subscription_id", "tenure_months", "scheduled_end")


# --- statistical tests


@query("chi_square", digits=4)
def _(t: StarTables) -> DataFrame:
    tests = inference.chi_square_tests(planted_rows(t))
    return tests.select("variable", "statistic", "df", "log10_p")


@query("welch_t", digits=4)
def _(t: StarTables) -> DataFrame:
    tests = inference.welch_tests(planted_rows(t))
    return tests.select("variable", "mean_retained", "mean_churned", "t", "df", "log10_p")


def _one_factor(t: StarTables) -> inference.GlmFit:
    """With one factor the estimates have a closed form, so the whole table has an SQL twin."""
    return inference.glm_logit(planted_rows(t), ("contract_type",), ())


@query("glm_one_factor", digits=4)
def _(t: StarTables) -> DataFrame:
    return _one_factor(t).coefficients.select("position", "term", "estimate", "std_error", "z", "log10_p")


@query("odds_ratios_one_factor", digits=3)
def _(t: StarTables) -> DataFrame:
    return inference.odds_ratios(_one_factor(t).coefficients)


@query("glm_fit_one_factor", digits=4)
def _(t: StarTables) -> DataFrame:
    fit = _one_factor(t).fit
    return fit.select("*", (1 - F.col("residual_deviance") / F.col("null_deviance")).alias("mcfadden_r2"))


@query("churn_rate_pct")
def _(t: StarTables) -> DataFrame:
    return inference.churn_rate_pct(planted_rows(t))


# --- dashboard


@query("kpi_row")
def _(t: StarTables) -> DataFrame:
    return dashboard.kpi_row(snapshot_rows(t))


@query("probability_by_contract")
def _(t: StarTables) -> DataFrame:
    return dashboard.probability_by_contract(snapshot_rows(t))


@query("risk_explorer")
def _(t: StarTables) -> DataFrame:
    return dashboard.explorer_rows(dashboard.explore(snapshot_rows(t)))


@query("risk_explorer_filtered")
def _(t: StarTables) -> DataFrame:
    chosen = dashboard.explore(snapshot_rows(t), ("Medium", "High"), ("One year", "Month-to-month"), 2500)
    return dashboard.explorer_rows(chosen)


@query("explorer_footer")
def _(t: StarTables) -> DataFrame:
    return dashboard.explorer_footer(dashboard.explore(snapshot_rows(t)))


@query("segment_summary")
def _(t: StarTables) -> DataFrame:
    return dashboard.segment_summary(snapshot_rows(t))


@query("filter_domains")
def _(t: StarTables) -> DataFrame:
    return dashboard.filter_domains(snapshot_rows(t))


# --- regression tables


def _mixed(t: StarTables) -> inference.GlmFit:
    """One factor and one number: a few Newton steps in SQL give the same table."""
    return inference.glm_logit(planted_rows(t), ("contract_type",), ("tenure_months",))


@query("glm_summary", digits=4)
def _(t: StarTables) -> DataFrame:
    return _mixed(t).coefficients.select("position", "term", "estimate", "std_error", "z", "log10_p")


@query("odds_ratios", digits=3)
def _(t: StarTables) -> DataFrame:
    return inference.odds_ratios(_mixed(t).coefficients)


@query("mcfadden_r2", digits=4)
def _(t: StarTables) -> DataFrame:
    fit = _mixed(t).fit
    return fit.withColumn("mcfadden_r2", F.lit(inference.mcfadden_r2(fit).first()[0]).cast("double"))


@query("statistics_report")
def _(t: StarTables) -> DataFrame:
    """The lines of the written report; the regression is that of one factor and one number."""
    path = new_path(t.spark, "report")
    jobs.statistics_job(planted_rows(t), path, ("contract_type",), ("tenure_months",))
    return t.spark.read.text(path)


@query("glm_all_drivers")
def _(t: StarTables) -> DataFrame:
    return inference.glm_logit(planted_rows(t)).coefficients


@query("odds_ratios_all_drivers")
def _(t: StarTables) -> DataFrame:
    return inference.odds_ratios(inference.glm_logit(planted_rows(t)).coefficients)


@query("mcfadden_r2_all_drivers")
def _(t: StarTables) -> DataFrame:
    return inference.mcfadden_r2(inference.glm_logit(planted_rows(t)).fit)


# --- fitted models on planted rules, whose right fit is known


def _ruled(t: StarTables, rule: str = "contract_type = 'Month-to-month'") -> DataFrame:
    """Features with a label that one column decides."""
    return stage_table(feature_rows(t).withColumn("churned", F.expr(f"cast({rule} as int)")), "ruled")


@query("train_compare_rule", digits=4)
def _(t: StarTables) -> DataFrame:
    """Metrics of all three classifiers on held-out rows; each has to find the rule."""
    return models.compare_classifiers(*jobs.split_features(_ruled(t)), trees=40)[0]


@query("score_customers_rule")
def _(t: StarTables) -> DataFrame:
    """Tier and class of all customers by a saved and reopened model."""
    rows = _ruled(t)
    path = new_path(t.spark, "model")
    models.save_model(models.fit_classifier(jobs.split_features(rows)[0], "logistic_regression"), path)
    scored = scoring.score_customers(models.load_model(path), rows)
    return scored.select("customer_id", "risk_tier", rules.at_least_half("churn_probability").alias("predicted"))


def _explained(t: StarTables, name: str) -> DataFrame:
    """Tier and class of profiles, how far base and contributions miss the score, and the strongest driver."""
    rows = _ruled(t)
    train, test = jobs.split_features(rows)
    model = models.fit_classifier(train, name, trees=20)
    profiles = rows.select(F.col("customer_id").alias("profile_id"), *features.CATEGORICAL, *features.NUMERIC)
    scored, reasons = scoring.score_profiles(model, profiles, test)
    reasons = stage_table(reasons, "reasons")
    top = explain.driver_ranking(reasons, 1).first()
    p = F.col("churn_probability")
    score = F.when(F.col("score_scale") == explain.LOGIT, F.log(p / (1 - p))).otherwise(p)
    sums = reasons.groupBy("profile_id").agg(F.sum("contribution").alias("parts"), F.count("*").alias("n_parts"))
    return scored.join(sums, "profile_id").select(
        F.lit(name).alias("model"), "profile_id", rules.at_least_half("churn_probability").alias("predicted"), "score_scale",
        (F.abs(F.col("base_value") + F.col("parts") - score) < 1e-6).alias("adds_up"), "n_parts",
        F.lit(top and top["feature"]).cast("string").alias("top_driver"),
    )


@query("score_profiles_rule")
def _(t: StarTables) -> DataFrame:
    return _explained(t, "logistic_regression")


@query("tree_contributions_boosted")
def _(t: StarTables) -> DataFrame:
    return _explained(t, "boosted_trees")


@query("tree_contributions_forest")
def _(t: StarTables) -> DataFrame:
    return _explained(t, "random_forest")


@query("lifetime_rule")
def _(t: StarTables) -> DataFrame:
    """Predicted tenure and value of all customers where the contract decides the tenure, and the held-out error."""
    months = F.expr("case contract_type when 'Two year' then 48 when 'One year' then 24 else 9 end")
    rows = stage_table(feature_rows(t).withColumn("tenure_months", months), "lifetime-rule")
    model, error = lifetime.fit_lifetime_model(rows, trees=20)
    valued = lifetime.predicted_clv(lifetime.predict_lifetime(model, rows))
    measured = [F.lit(value).cast("double").alias(name) for name, value in error.first().asDict().items()]
    return valued.select("customer_id", "predicted_total_tenure_months", "predicted_clv", *measured)


@query("kmeans_bands")
def _(t: StarTables) -> DataFrame:
    """Segments of customers that lie in four bands."""
    band, key = F.col("customer_id") % 4, F.col("customer_id")
    rows = feature_rows(t).select(
        "customer_id", "churned",
        (10 + 20 * band + key % 3).cast("int").alias("tenure_months"),
        ((2000 + 2500 * band + key % 5) / 100).cast("decimal(10,2)").alias("monthly_charges"),
        band.alias("ticket_count"),
        (1000 * (band + 1) * (band + 1) + key % 11).cast("double").alias("predicted_clv"),
    )
    rows = stage_table(rows, "bands")
    found = segments.relabel_segments(segments.assign_cluster(segments.fit_segments(rows), rows))
    return segments.segment_profile(found)


@query("model_versions")
def _(t: StarTables) -> DataFrame:
    """Two versions trained on different rules: metadata, and the tiers that either gives all customers."""
    folder = new_path(t.spark, "models")
    for version, rule in (("v1.0", "contract_type = 'Month-to-month'"), ("v2.0", "internet_service = 'Fiber optic'")):
        jobs.model_job(_ruled(t, rule), folder, ("logistic_regression",), trees=5, restarts=1, model_version=version)
    everyone = stage_table(feature_rows(t), "features")
    tiers = [
        jobs.score_job(jobs.open_model(t.spark, folder, version), everyone)
        .groupBy("risk_tier").agg(F.count("*").alias("customers"))
        .select(F.lit(version).alias("model_version"), "*")
        for version in ("v1.0", "v2.0")
    ]
    described = jobs.model_versions(t.spark, folder).select(
        "model_version", "best_model", "is_current", F.array_join(F.concat("categorical", "numeric"), ",").alias("columns")
    )
    return described.join(reduce(DataFrame.unionByName, tiers), "model_version")


# --- fitted models without an SQL twin


@query("statistics_report_all_drivers")
def _(t: StarTables) -> DataFrame:
    path = new_path(t.spark, "report")
    jobs.statistics_job(planted_rows(t), path)
    return t.spark.read.text(path)


def _logistic_model(t: StarTables):
    rows = stage_table(planted_rows(t).drop("churn_probability"), "planted")
    train, test = jobs.split_features(rows)
    return models.fit_classifier(train, "logistic_regression"), rows, test


@query("score_customers")
def _(t: StarTables) -> DataFrame:
    model, rows, _test = _logistic_model(t)
    path = new_path(t.spark, "model")
    models.save_model(model, path)
    scored = scoring.score_customers(models.load_model(path), rows)
    return scored.select("customer_id", "churn_probability", "risk_tier")


@query("score_profiles")
def _(t: StarTables) -> DataFrame:
    model, rows, test = _logistic_model(t)
    profiles = rows.select(F.col("customer_id").alias("profile_id"), *features.CATEGORICAL, *features.NUMERIC)
    scored, _contributions = scoring.score_profiles(model, profiles, test)
    return scored.select("profile_id", "churn_probability", "risk_tier")


@query("linear_contributions")
def _(t: StarTables) -> DataFrame:
    model, _rows, test = _logistic_model(t)
    return explain.linear_contributions(model, test, test)[0]


@query("driver_ranking")
def _(t: StarTables) -> DataFrame:
    model, _rows, test = _logistic_model(t)
    return explain.driver_ranking(explain.linear_contributions(model, test, test)[0])


@query("lifetime_regressor")
def _(t: StarTables) -> DataFrame:
    return lifetime.fit_lifetime_model(stage_table(feature_rows(t), "features"))[1]


@query("kmeans_segments")
def _(t: StarTables) -> DataFrame:
    rows = stage_table(valued_rows(t), "valued")
    model = segments.fit_segments(rows)
    return segments.segment_profile(segments.relabel_segments(segments.assign_cluster(model, rows)))


@query("train_compare", digits=4)
def _(t: StarTables) -> DataFrame:
    rows = stage_table(planted_rows(t).drop("churn_probability"), "planted")
    return models.compare_classifiers(*jobs.split_features(rows))[0]
