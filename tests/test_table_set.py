"""Tables that are published together: readers, rivals, failures, expiry, scans of the load's checks."""

from __future__ import annotations

import re
import threading
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import plan_of
from tidemark import schemas
from tidemark.operators import checks
from tidemark.sources import table_set

IDS = T.StructType([T.StructField("id", T.LongType(), False)])
BOTH = {"a": IDS, "b": IDS}


def counts(spark, root, of=None):
    return {name: df.count() for name, df in table_set.read_tables(spark, root, BOTH, of).items()}


def files_below(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*") if p.is_file() and not p.name.startswith("."))


def test_sets_follow_each_other_and_stay_readable(spark, tmp_path):
    root = str(tmp_path / "db")
    assert table_set.read_set(spark, root) == table_set.TableSet() and table_set.set_numbers(spark, root) == []
    first = table_set.replace_tables(spark, root, {"a": spark.range(3), "b": spark.range(4)})
    second = table_set.replace_tables(spark, root, {"a": spark.range(7)})
    assert (first.number, second.number) == (1, 2) and second.folders["b"] == first.folders["b"]
    assert counts(spark, root) == {"a": 7, "b": 4} and counts(spark, root, first) == {"a": 3, "b": 4}
    assert table_set.read_set(spark, root, 1) == first and table_set.set_numbers(spark, root) == [1, 2]
    with pytest.raises(FileNotFoundError, match="no set 9"):
        table_set.read_set(spark, root, 9)
    with pytest.raises(FileNotFoundError, match="has no c"):
        table_set.read_tables(spark, root, {**BOTH, "c": IDS})


def test_a_reader_during_a_load_sees_one_set(spark, tmp_path):
    root = str(tmp_path / "db")
    table_set.replace_tables(spark, root, {"a": spark.range(3), "b": spark.range(3)})
    opened = table_set.read_tables(spark, root, BOTH)
    with table_set.replacing(spark, root) as writer:
        assert writer.write("a", opened["a"].unionByName(opened["a"])).count() == 6
        assert counts(spark, root) == {"a": 3, "b": 3}
        writer.write("b", spark.range(6))
        with pytest.raises(ValueError, match="already"):
            writer.write("b", spark.range(1))
        assert counts(spark, root) == {"a": 3, "b": 3}
    assert counts(spark, root) == {"a": 6, "b": 6}
    assert {name: df.count() for name, df in opened.items()} == {"a": 3, "b": 3}


def test_errors_leave_nothing_behind(spark, tmp_path):
    root = str(tmp_path / "db")
    table_set.replace_tables(spark, root, {"a": spark.range(3), "b": spark.range(3)})
    before = files_below(tmp_path)
    with pytest.raises(RuntimeError, match="stop"), table_set.replacing(spark, root) as writer:
        writer.write("a", spark.range(9))
        writer.write("c", spark.range(9))
        raise RuntimeError("stop")
    broken = spark.range(9).select(F.raise_error(F.lit("bad value")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="bad value"):
        table_set.replace_tables(spark, root, {"a": spark.range(2), "b": broken})
    assert files_below(tmp_path) == before and counts(spark, root) == {"a": 3, "b": 3}
    assert not (tmp_path / "db" / "c").exists()


@pytest.mark.parametrize("move", ["_link", "_rename"])
def test_of_many_writers_one_wins(spark, tmp_path, monkeypatch, move):
    """By a link on a local disk; the rename that other file systems use is tried one after another."""
    monkeypatch.setattr(table_set, "_link", getattr(table_set, move))
    n = 6
    root, barrier = str(tmp_path / "db"), threading.Barrier(n)
    start = table_set.replace_tables(spark, root, {"a": spark.range(1), "b": spark.range(1)})

    def rival(k):
        try:
            with table_set.replacing(spark, root, start) as writer:
                for name in BOTH:
                    writer.write(name, spark.range(10 + k))
                if move == "_link":
                    barrier.wait()
            return k
        except table_set.SetConflict:
            return None

    with ThreadPool(n if move == "_link" else 1) as pool:
        won = [k for k in pool.map(rival, range(n)) if k is not None]
    assert len(won) == 1 and counts(spark, root) == {"a": 10 + won[0], "b": 10 + won[0]}
    assert table_set.set_numbers(spark, root) == [1, 2]
    assert len(list((tmp_path / "db" / "a").iterdir())) == 2  # those of the losers are gone
    assert not list((tmp_path / "db" / table_set.FOLDER).glob(".draft*"))


def test_expired_sets_go_with_what_only_they_name(spark, tmp_path):
    root = str(tmp_path / "db")
    table_set.replace_tables(spark, root, {"a": spark.range(1), "b": spark.range(1)})
    for k in (2, 3):
        table_set.replace_tables(spark, root, {"a": spark.range(k)})
    with table_set.replacing(spark, root) as writer:
        writer.write("a", spark.range(4))
        assert table_set.expire_sets(spark, root, 1) == [1, 2]
        assert len(list((tmp_path / "db" / "a").iterdir())) == 2
    assert counts(spark, root) == {"a": 4, "b": 1} and table_set.set_numbers(spark, root) == [3, 4]
    assert table_set.expire_sets(spark, root, 5) == []
    with pytest.raises(ValueError):
        table_set.expire_sets(spark, root, 0)


def test_load_checks_scan_no_table_more_than_twice(spark, star, tmp_path):
    stored = {}
    for name, df in star.all_tables().items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.schema(df.schema).parquet(str(tmp_path / name))
    report = checks.load_report(stored)
    plan = plan_of(report)
    for name in stored:
        assert 1 <= len(re.findall(rf"Location: InMemoryFileIndex \[[^\]]*/{name}\]", plan)) <= 2, name
    assert "BroadcastNestedLoopJoin" not in plan and "Cartesian" not in plan


def test_load_report_equals_the_single_checks(spark, star):
    raw = star.all_tables()
    holes = F.when(F.col("customer_id") % 7 == 0, F.lit(None)).otherwise(F.col("customer_id"))
    raw["subscriptions"] = raw["subscriptions"].withColumn("customer_id", holes).unionByName(raw["subscriptions"].limit(9))
    raw["customers"] = raw["customers"].where("customer_id % 5 > 0")
    raw["churn_events"] = raw["churn_events"].limit(0)
    single = checks.key_report(raw).unionByName(checks.null_report(raw))
    for child, column, parent in checks.LOADED_REFERENCES:
        single = single.unionByName(checks.reference_check(raw[child], child, column, raw[parent]))
    report = checks.load_report(raw)
    assert sorted(map(tuple, report.drop("n_rows").collect())) == sorted(map(tuple, single.collect()))
    rows = {r.table_name: r.n_rows for r in checks.counted_rows(report).collect()}
    assert rows == {r.table_name: r.n_rows for r in checks.row_counts(raw).collect()} and rows["churn_events"] == 0
    assert report.where("check_name = 'reference' and table_name = 'churn_events'").first()["n_bad"] == 0
    with pytest.raises(checks.CheckFailed, match="subscriptions.customer_id: not_null"):
        checks.enforce(report)


def test_raw_tables_are_all_checked():
    assert set(checks.PRIMARY_KEYS) == set(checks.REQUIRED_COLUMNS) == set(schemas.RAW_TABLES)
