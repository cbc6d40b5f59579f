from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import inference
from tidemark.operators.features import feature_table
from tidemark.session import stage_table
from tidemark.sources.star_tables import StarTables, planted_label


@pytest.fixture(scope="module")
def rows(spark):
    t = StarTables(spark, "/root/testdata/sf0.01")
    return stage_table(planted_label(feature_table(t.customers, t.subscriptions, t.support_tickets)), "rows")


def fit_by_newton(rows):
    """Same model in numpy, without the aliased level."""
    data = rows.select(*inference.GLM_FACTORS, *inference.GLM_NUMBERS, "churned").toPandas()
    columns, names = [np.ones(len(data))], ["(Intercept)"]
    for factor in inference.GLM_FACTORS:
        for level in sorted(data[factor].unique())[1:]:
            if (factor, level) != ("tech_support", "No internet service"):
                columns.append((data[factor] == level).to_numpy(float))
                names.append(f"{factor}{level}")
    for number in inference.GLM_NUMBERS:
        columns.append(data[number].to_numpy(float))
        names.append(number)
    x, y = np.column_stack(columns), data["churned"].to_numpy(float)
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        information = x.T @ (x * (p * (1 - p))[:, None])
        beta += np.linalg.solve(information, x.T @ (y - p))
    deviance = -2 * (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
    null = -2 * (y.sum() * math.log(y.mean()) + (1 - y).sum() * math.log(1 - y.mean()))
    return dict(zip(names, zip(beta, np.sqrt(np.diag(np.linalg.inv(information)))))), deviance, null


def test_glm_against_newton(rows):
    fit = inference.glm_logit(rows)
    want, deviance, null = fit_by_newton(rows)
    got = {r.term: r for r in fit.coefficients.collect()}
    assert set(got) == set(want) | {"tech_supportNo internet service"}
    assert got["tech_supportNo internet service"].estimate is None
    for term, (estimate, error) in want.items():
        assert got[term].estimate == pytest.approx(estimate, rel=1e-5, abs=1e-7)
        assert got[term].std_error == pytest.approx(error, rel=1e-5)
        assert got[term].p_value == pytest.approx(math.erfc(abs(estimate / error) / math.sqrt(2)), rel=1e-3)
    stats = fit.fit.first()
    assert stats.residual_deviance == pytest.approx(deviance) and stats.null_deviance == pytest.approx(null)
    assert (stats.null_df, stats.residual_df) == (rows.count() - 1, rows.count() - len(want))
    assert stats.aic == pytest.approx(deviance + 2 * len(want))
    assert inference.mcfadden_r2(fit.fit).first()[0] == round(1 - deviance / null, 4)


def test_constant_and_repeated_columns_are_aliased(spark, rows):
    df = rows.withColumn("twice", F.col("tenure_months") * 2).withColumn("same", F.lit(7))
    fit = inference.glm_logit(df, ("contract_type",), ("tenure_months", "twice", "same", "monthly_charges"))
    missing = {r.term for r in fit.coefficients.where("estimate IS NULL").collect()}
    assert missing == {"twice", "same"}
    assert fit.coefficients.where("std_error > 0").count() == 5


def test_published_odds_ratio_and_r2(spark):
    coefficients = spark.createDataFrame(
        [(1, "ticket_count", 0.922313, 0.046222), (2, "aliased", None, None)],
        "position int, term string, estimate double, std_error double",
    )
    got = [tuple(r)[2:] for r in inference.odds_ratios(coefficients).collect()]
    assert got == [(2.515, 2.297, 2.754), (None, None, None)]
    fit = spark.createDataFrame([(8455.9, 5716.8)], "null_deviance double, residual_deviance double")
    assert inference.mcfadden_r2(fit).first()[0] == 0.3239


def test_chi_square_edges(spark):
    df = spark.createDataFrame([("a", "x", 0), ("b", "x", 1), ("a", "x", 0), ("b", None, 1)], "u string, v string, churned int")
    got = {r.variable: r for r in inference.chi_square_tests(df, ("u", "v")).collect()}
    assert got["u"].statistic == pytest.approx(4.0) and got["u"].df == 1
    assert got["u"].p_value == pytest.approx(math.erfc(math.sqrt(2)))
    assert got["v"].statistic is None and got["v"].p_value is None
    one_class = df.withColumn("churned", F.lit(1))
    assert inference.chi_square_tests(one_class, ("u",)).first().statistic is None


def test_welch_edges(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (0, None), (1, 4.0), (1, 8.0)], "churned int, v double")
    row = inference.welch_tests(df, ("v",)).first()
    assert (row.mean_retained, row.mean_churned) == (1.5, 6.0)
    assert row.t == pytest.approx(-4.5 / math.sqrt(0.25 + 4.0))
    assert row.df == pytest.approx((0.25 + 4.0) ** 2 / (0.25**2 + 4.0**2))
    alone = inference.welch_tests(df.where("churned = 0"), ("v",)).first()
    assert alone.t is None and alone.p_value is None


def test_a_factor_may_have_any_number_of_levels(spark):
    df = spark.createDataFrame([(chr(97 + k % 20), k % 3 % 2) for k in range(200)], "f string, churned int")
    assert inference.glm_logit(df, ("f",), ()).coefficients.count() == 20
