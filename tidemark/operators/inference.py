"""Statistical tests: logistic regression table, chi-square, Welch t."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.tails import chi_square_log10_p, normal_log10_p, student_log10_p
from tidemark.session import stage_table

# Terms of the regression in formula order, and the variables of the tests.
GLM_FACTORS = ("contract_type", "payment_method", "internet_service", "tech_support")
GLM_NUMBERS = ("monthly_charges", "tenure_months", "senior_citizen", "ticket_count")
CHI_SQUARE_VARIABLES = ("contract_type", "internet_service", "payment_method", "tech_support")
WELCH_VARIABLES = ("monthly_charges", "tenure_months", "ticket_count")
WALD_95 = 1.959963984540054


def chi_square(df: DataFrame, variables: tuple[str, ...] = CHI_SQUARE_VARIABLES, label: str = "churned") -> DataFrame:
    """Test of independence between each variable and the 0/1 label, without continuity correction.

    One scan counts the combinations of levels; every contingency table is a sum over those.
    Statistic and p-value are NULL when a variable or the label takes one value only.
    """
    cells = df.where(F.col(label).isin(0, 1)).groupBy(*variables).agg(
        F.count("*").alias("rows"), F.sum(F.col(label).cast("bigint")).alias("ones")
    )
    tagged = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("level")) for v in variables])
    levels = (
        cells.select(F.inline(tagged), "rows", "ones")
        .where(F.col("level").isNotNull())
        .groupBy("variable", "level")
        .agg(F.sum("rows").cast("double").alias("rows"), F.sum("ones").cast("double").alias("ones"))
    )
    # With two label values the sum of (observed - expected)^2 / expected over both columns is
    # n^2 / (ones x zeros) x (sum of ones_i^2 / rows_i  -  ones^2 / n).
    sums = levels.groupBy("variable").agg(
        F.sum("rows").alias("n"), F.sum("ones").alias("p"), F.count("*").alias("k"),
        F.sum(F.col("ones") * F.col("ones") / F.col("rows")).alias("squares"),
    )
    n, p = F.col("n"), F.col("p")
    statistic = F.try_divide(n * n * (F.col("squares") - p * p / n), p * (n - p))
    return sums.select(
        "variable",
        F.when(F.col("k") > 1, statistic).alias("statistic"),
        (F.col("k") - 1).cast("int").alias("df"),
    )


def welch_t(df: DataFrame, variables: tuple[str, ...] = WELCH_VARIABLES, label: str = "churned") -> DataFrame:
    """Welch two-sample t-test, retained (0) minus churned (1), all variables in one pass."""

    def moments(variable: str, group: int) -> list:
        value = F.when(F.col(label) == group, F.col(variable).cast("double"))
        return [
            F.count(value).alias(f"{variable}_n{group}"),
            F.avg(value).alias(f"{variable}_m{group}"),
            F.var_samp(value).alias(f"{variable}_v{group}"),
        ]

    totals = df.agg(*[column for v in variables for g in (0, 1) for column in moments(v, g)])
    per_variable = totals.select(F.inline(F.array(*[
        F.struct(
            F.lit(v).alias("variable"),
            *[F.col(f"{v}_{part}").alias(part) for part in ("n0", "m0", "v0", "n1", "m1", "v1")],
        )
        for v in variables
    ])))
    error0, error1 = F.try_divide("v0", "n0"), F.try_divide("v1", "n1")
    spread = error0 + error1
    df_sum = F.try_divide(error0 * error0, F.col("n0") - 1) + F.try_divide(error1 * error1, F.col("n1") - 1)
    return per_variable.select(
        "variable",
        F.col("m0").alias("mean_retained"),
        F.col("m1").alias("mean_churned"),
        F.try_divide(F.col("m0") - F.col("m1"), F.sqrt(spread)).alias("t"),
        F.try_divide(spread * spread, df_sum).alias("df"),
    )


def _with_p_values(tests: DataFrame, statistic: str, log10_tail: Callable[[float, float], float]) -> DataFrame:
    """Add `p_value` and `log10_p` to a table of one row per tested variable.

    Those few rows pass through the driver. `p_value` is 0 below the smallest double.
    """
    rows = []
    for row in tests.collect():
        known = row[statistic] is not None and row.df is not None
        log10_p = log10_tail(row[statistic], row.df) if known else None
        rows.append((*row, 10.0**log10_p if known else None, log10_p))
    schema = tests.schema.add("p_value", "double").add("log10_p", "double")
    return tests.sparkSession.createDataFrame(rows, schema)


def chi_square_tests(df: DataFrame, variables: tuple[str, ...] = CHI_SQUARE_VARIABLES) -> DataFrame:
    """`chi_square` with p-values."""
    return _with_p_values(chi_square(df, variables), "statistic", chi_square_log10_p)


def welch_tests(df: DataFrame, variables: tuple[str, ...] = WELCH_VARIABLES) -> DataFrame:
    """`welch_t` with two-sided p-values."""
    return _with_p_values(welch_t(df, variables), "t", student_log10_p)


def churn_rate_pct(df: DataFrame, column: str = "contract_type", label: str = "churned") -> DataFrame:
    """Mean of the label per value of `column`, in percent with one decimal."""
    return df.groupBy(column).agg(F.round(F.avg(label) * 100, 1).alias("churn_rate_pct"))


@dataclass
class GlmFit:
    """Coefficients (one row per term, NULL where aliased) and fit statistics (one row)."""

    coefficients: DataFrame
    fit: DataFrame


def _levels(df: DataFrame, factors: tuple[str, ...]) -> dict[str, list[str]]:
    """Sorted levels of every factor, in one pass; the design matrix has a column for each, which is what bounds them."""
    if not factors:
        return {}
    found = df.agg(*[F.sort_array(F.collect_set(f)).alias(f) for f in factors]).first()
    return {f: list(found[f]) for f in factors}


def _aliased(correlation: np.ndarray, tolerance: float = 1e-9) -> list[int]:
    """Columns that are linear combinations of the intercept and the columns before them."""
    kept: list[int] = []
    aliased: list[int] = []
    for j in range(correlation.shape[0]):
        if np.isnan(correlation[j, j]) or np.isnan(correlation[j, kept]).any():
            aliased.append(j)
            continue
        across = correlation[np.ix_(kept, [j])][:, 0]
        explained = across @ np.linalg.solve(correlation[np.ix_(kept, kept)], across) if kept else 0.0
        (aliased if 1.0 - explained < tolerance else kept).append(j)
    return aliased


def glm_logit(
    df: DataFrame,
    factors: tuple[str, ...] = GLM_FACTORS,
    numbers: tuple[str, ...] = GLM_NUMBERS,
    label: str = "churned",
) -> GlmFit:
    """Binomial regression with logit link: estimates, standard errors, z and p.

    Factors use treatment contrasts against their first level. Terms that depend on earlier ones
    are found from the correlation matrix of the design, left out of the fit and reported as NULL.
    The rows are staged once; all passes over them are aggregations by Spark.
    """
    used = df.select(*factors, *[F.col(c).cast("double").alias(c) for c in numbers], F.col(label).cast("double"))
    staged = stage_table(used.dropna(), "glm")
    names, columns = [], []
    levels = _levels(staged, factors)
    for factor in factors:
        for level in levels[factor][1:]:
            names.append(f"{factor}{level}")
            columns.append(F.when(F.col(factor) == level, 1.0).otherwise(0.0))
    for number in numbers:
        names.append(number)
        columns.append(F.col(number))
    slots = [f"_{i}" for i in range(len(names))]
    design = staged.select(*[c.alias(s) for c, s in zip(columns, slots)], label)

    everything = VectorAssembler(inputCols=slots, outputCol="_all").transform(design)
    correlation = Correlation.corr(everything, "_all").first()[0].toArray()
    # The diagonal is always 1, so a constant column shows in the rest of its row.
    for j in range(len(slots)):
        if len(slots) > 1 and np.isnan(np.delete(correlation[j], j)).all():
            correlation[j, j] = math.nan
    aliased = set(_aliased(correlation))
    kept = [s for j, s in enumerate(slots) if j not in aliased]

    rows = VectorAssembler(inputCols=kept, outputCol="_features").transform(design)
    model = GeneralizedLinearRegression(
        family="binomial", link="logit", featuresCol="_features", labelCol=label, maxIter=25, tol=1e-8
    ).fit(rows)
    summary = model.summary
    errors = list(summary.coefficientStandardErrors)
    estimates = [float(b) for b in model.coefficients]
    fitted = iter(zip(estimates, errors[:-1]))

    def row(position: int, term: str, estimate: float | None, error: float | None) -> tuple:
        if estimate is None:
            return position, term, None, None, None, None, None
        log10_p = normal_log10_p(estimate / error)
        return position, term, estimate, error, estimate / error, 10.0**log10_p, log10_p

    table = [row(0, "(Intercept)", float(model.intercept), errors[-1])]
    for j, name in enumerate(names):
        estimate, error = (None, None) if j in aliased else next(fitted)
        table.append(row(j + 1, name, estimate, error))
    spark = df.sparkSession
    coefficients = spark.createDataFrame(
        table,
        "position int, term string, estimate double, std_error double, z double, p_value double, log10_p double",
    )
    statistics = [(
        float(summary.nullDeviance), int(summary.residualDegreeOfFreedomNull),
        float(summary.deviance), int(summary.residualDegreeOfFreedom), float(summary.aic),
    )]
    fit = spark.createDataFrame(
        statistics,
        "null_deviance double, null_df bigint, residual_deviance double, residual_df bigint, aic double",
    )
    return GlmFit(coefficients, fit)


def odds_ratios(coefficients: DataFrame) -> DataFrame:
    """exp(estimate) with the Wald 95% interval, three decimals."""
    reach = F.lit(WALD_95) * F.col("std_error")

    def exponential(value):
        return F.round(F.exp(value), 3)

    return coefficients.select(
        "position", "term",
        exponential(F.col("estimate")).alias("odds_ratio"),
        exponential(F.col("estimate") - reach).alias("lower"),
        exponential(F.col("estimate") + reach).alias("upper"),
    )


def mcfadden_r2(fit: DataFrame) -> DataFrame:
    return fit.select(
        F.round(F.lit(1.0) - F.try_divide("residual_deviance", "null_deviance"), 4).alias("mcfadden_r2")
    )
