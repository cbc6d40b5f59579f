from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import calendar, hashing, rules, tails
from tidemark.functions.running import running_totals


def d(text):
    return dt.date.fromisoformat(text)


@pytest.mark.parametrize("start, end, months", [
    ("2024-01-31", "2024-02-29", 0),
    ("2023-08-31", "2024-02-29", 5),
    ("2024-01-15", "2024-03-14", 1),
    ("2024-01-15", "2024-03-15", 2),
    ("2024-03-15", "2024-02-20", 0),
    ("2024-03-15", "2024-01-14", -2),
])
def test_whole_months(spark, start, end, months):
    row = spark.range(1).select(calendar.whole_months(F.lit(d(start)), F.lit(d(end)))).first()
    assert row[0] == months


def test_month_helpers(spark):
    df = spark.createDataFrame([(d("2024-02-01"),), (d("2024-02-29"),), (None,)], "day date")
    rows = df.select(
        calendar.month_start("day"), calendar.month_label("day"), calendar.first_month_on_or_after(F.col("day"))
    ).collect()
    assert [tuple(r) for r in rows] == [
        (d("2024-02-01"), "2024-02-01", d("2024-02-01")),
        (d("2024-02-01"), "2024-02-01", d("2024-03-01")),
        (None, None, None),
    ]


def test_thirty_day_periods(spark):
    df = spark.createDataFrame([(d("2024-01-01"), d("2024-03-01"))], "a date, b date")
    row = df.select(
        calendar.periods_of_30_days(F.col("a"), F.col("b")), calendar.plus_periods(F.col("a"), F.lit(2))
    ).first()
    assert tuple(row) == (2, d("2024-03-01"))


def test_tier_edges(spark):
    df = spark.createDataFrame([(0.29999,), (0.3,), (0.599996,), (0.6,)], "p double")
    plain = [r[0] for r in df.select(rules.risk_tier("p")).collect()]
    assert plain == ["Low", "Medium", "Medium", "High"]
    rounded = [r[0] for r in df.select(rules.risk_tier(rules.half_even("p", 5))).collect()]
    assert rounded == ["Low", "Medium", "High", "High"]


def test_tenure_buckets(spark):
    months = [6, 7, 12, 13, 24, 25, 48, 49, None]
    df = spark.createDataFrame([(m,) for m in months], "m int")
    assert [r[0] for r in df.select(rules.tenure_bucket("m")).collect()] == [
        "0-6 mo", "7-12 mo", "7-12 mo", "13-24 mo", "13-24 mo", "25-48 mo", "25-48 mo", "48+ mo", "48+ mo",
    ]


def test_small_rules(spark):
    row = spark.range(1).select(
        rules.segment_label(F.lit(3)), rules.segment_label(F.lit(9)), rules.customer_code(F.lit(42)),
        rules.customer_code(F.lit(1234567)), rules.percentage(F.lit(1), F.lit(8)), rules.percentage(F.lit(1), F.lit(0)),
        rules.clip(F.lit(5.0), 1.0, 3.0), rules.at_least_half(F.lit(0.5)),
    ).first()
    assert tuple(row) == ("Low-Value / New", None, "CU-00042", "CU-1234567", 12.5, None, 3.0, 1)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30), st.integers(0, 5))
def test_half_even_is_the_frame_rule(spark, values, digits):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(rules.half_even("v", digits)).collect()]
    assert got == [float(x) for x in np.round(np.array(values), digits)]


def test_hash_depends_on_seed(spark):
    row = spark.range(1).select(
        hashing.unit_interval(F.lit(1), 1).alias("a"), hashing.unit_interval(F.lit(1), 2).alias("b")
    ).first()
    assert row.a != row.b and 0 <= row.a < 1 and 0 <= row.b < 1


def test_published_tail_values():
    assert 10 ** tails.chi_square_log10_p(32.98, 3) == pytest.approx(3.25239e-07, rel=1e-3)
    assert 10 ** tails.student_log10_p(-15.28, 2831.5) == pytest.approx(1.02253e-50, rel=5e-2)
    assert 10 ** tails.normal_log10_p(3.400) == pytest.approx(0.000674, rel=1e-3)


@pytest.mark.parametrize("t, df", [(0.3, 2.5), (1.0, 10.0), (2.2, 33.3), (4.0, 400.0), (-3.0, 7.0)])
def test_student_tail_against_integration(t, df):
    grid = np.linspace(abs(t), abs(t) + 2000, 4_000_001)
    log_density = (
        math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - math.log(df * math.pi) / 2
        - (df + 1) / 2 * np.log1p(grid**2 / df)
    )
    assert 10 ** tails.student_log10_p(t, df) == pytest.approx(2 * np.trapezoid(np.exp(log_density), grid), rel=1e-4)


@pytest.mark.parametrize("x, df", [(0.5, 1), (3.0, 2), (7.5, 3), (20.0, 4), (11.0, 9)])
def test_chi_square_tail_against_integration(x, df):
    grid = np.linspace(x, x + 200, 2_000_001)
    log_density = (df / 2 - 1) * np.log(grid) - grid / 2 - df / 2 * math.log(2) - math.lgamma(df / 2)
    assert 10 ** tails.chi_square_log10_p(x, df) == pytest.approx(np.trapezoid(np.exp(log_density), grid), rel=1e-5)


def test_tails_do_not_underflow():
    assert tails.chi_square_log10_p(5000.0, 3) == pytest.approx(-5000 / 2 / tails.LN10, rel=1e-2)
    assert tails.student_log10_p(60.0, 1e7) == pytest.approx(tails.normal_log10_p(60.0), rel=1e-3)
    assert tails.normal_log10_p(35.3) > tails.normal_log10_p(35.4)
    assert tails.chi_square_log10_p(0.0, 2) == 0.0 and tails.student_log10_p(0.0, 5.0) == 0.0


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_agree_with_one_window(spark, descending):
    rng = np.random.default_rng(3)
    # Most values lie close together, so equal-width ranges would be lopsided.
    scores = np.unique(np.concatenate([rng.random(300), 0.5 + rng.random(3000) * 1e-9]))
    rows = [(float(s), int(rng.integers(0, 5)), int(rng.integers(0, 5))) for s in scores]
    df = spark.createDataFrame(rows, "score double, a bigint, b bigint")
    wide = running_totals(df, "score", ["a", "b"], descending)
    narrow = running_totals(df, "score", ["a", "b"], descending, small=True).select(wide.columns)
    assert sorted(map(tuple, wide.collect()), key=str) == sorted(map(tuple, narrow.collect()), key=str)


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "score double, a bigint")
    assert running_totals(df, "score", ["a"]).count() == 0
