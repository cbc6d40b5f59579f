from __future__ import annotations

import pytest

from tidemark.operators import checks


def bad(report):
    return {(r.table_name, r.column_name): r.n_bad for r in report.collect()}


def test_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "id int")
    assert bad(checks.key_check(df, "t", "id")) == {("t", "id"): 3}


def test_null_counts_in_one_row_per_column(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert bad(checks.null_check(df, "t", ["a", "b"])) == {("t", "a"): 1, ("t", "b"): 2}


def test_orphans_and_null_references(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (9,), (None,)], "customer_id int")
    parent = spark.createDataFrame([(1,), (2,)], "customer_id int")
    assert bad(checks.reference_check(child, "c", "customer_id", parent)) == {("c", "customer_id"): 4}


def test_empty_tables_are_sound(spark):
    empty = spark.createDataFrame([], "customer_id int")
    report = checks.key_check(empty, "t", "customer_id").unionByName(
        checks.null_check(empty, "t", ["customer_id"])
    ).unionByName(checks.reference_check(empty, "t", "customer_id", empty))
    assert [r.n_bad for r in report.collect()] == [0, 0, 0]
    checks.enforce(report)


def test_enforce_names_the_failures(spark):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    with pytest.raises(checks.CheckFailed, match="t.id: primary_key, 1 bad rows"):
        checks.enforce(checks.key_check(df, "t", "id"))


def test_load_report_finds_the_repeated_refund_ids(star):
    tables = star.all_tables()
    found = {k: n for k, n in bad(checks.load_report(tables)).items() if n}
    assert set(found) == {("transactions", "transaction_id")}
    with pytest.raises(checks.CheckFailed):
        checks.enforce(checks.load_report(tables))


def test_reference_report_covers_declared_references(star, spark):
    predictions = spark.createDataFrame([(-1,)], "customer_id bigint")
    report = checks.reference_report({**star.all_tables(), "predictions": predictions})
    found = [(r.table_name, r.column_name, r.n_bad) for r in report.collect()]
    assert len(found) == 6
    assert ("predictions", "customer_id", 1) in found
