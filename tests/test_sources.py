from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tidemark import schemas
from tidemark.session import clear_stage, new_path, shared_folder, side_by_side, spread, stage_table
from tidemark.sources import database, files, tables
from tests.conftest import plan_of


def test_csv_keeps_types_nulls_and_quotes(spark, tmp_path):
    row = ("CU-00001", 'A "quoted", name', 1, 0, None, dt.date(2024, 2, 29), None, "Bayern", "Germany")
    df = spark.createDataFrame([row], schemas.CUSTOMERS)
    files.write_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), schemas.CUSTOMERS)
    assert [tuple(r) for r in back.collect()] == [row]


def test_csv_with_a_wrong_value_stops(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("churn_id,customer_id,churn_date,churn_flag,churn_reason\n1,a,not-a-date,1,x\n")
    with pytest.raises(Exception, match="(?i)malformed|cannot be parsed|MALFORMED_RECORD"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), schemas.CHURN_EVENTS).collect()


def test_csv_with_another_header_stops(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("customer_id,churn_id,churn_date,churn_flag,churn_reason\n1,2,2024-01-01,1,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), schemas.CHURN_EVENTS).collect()


def test_csv_accepts_whole_numbers_with_a_zero_fraction(spark, tmp_path):
    header = "ticket_id,customer_id,opened_date,closed_date,category,priority,satisfaction_score\n"
    good = "1,CU-00001,2024-01-01,2024-01-03,billing,low,4.0\n2,CU-00001,2024-01-01,,billing,low,\n"
    (tmp_path / "good.csv").write_text(header + good)
    rows = files.read_csv(spark, str(tmp_path / "good.csv"), schemas.SUPPORT_TICKETS)
    assert rows.schema == schemas.SUPPORT_TICKETS
    assert [(r.closed_date, r.satisfaction_score) for r in rows.collect()] == [(dt.date(2024, 1, 3), 4), (None, None)]
    (tmp_path / "bad.csv").write_text(header + "1,CU-00001,2024-01-01,,billing,low,4.5\n")
    with pytest.raises(Exception, match="satisfaction_score is no whole number: 4.5"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), schemas.SUPPORT_TICKETS).collect()


def test_metadata(spark, tmp_path):
    path = str(tmp_path / "m")
    files.write_metadata(spark, path, "random_forest", ["a", "b"], ["c"], "v1.0")
    files.write_metadata(spark, path, "logistic_regression", ["a", "b"], ["c"], "v1.0")
    assert files.read_metadata(spark, path) == {
        "best_model": "logistic_regression", "categorical": ["a", "b"], "numeric": ["c"], "model_version": "v1.0",
    }


def test_replacement_can_read_itself_and_survives_a_failed_write(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, root, spark.range(1).schema)
    tables.replace_table(spark.range(10), root)
    current = tables.read_table(spark, root, spark.range(1).schema)
    tables.replace_table(current.where("id < 4"), root)
    assert tables.read_table(spark, root, current.schema).count() == 4

    broken = spark.range(5).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.replace_table(broken, root)
    assert tables.read_table(spark, root, current.schema).count() == 4
    unpublished = tables.write_version(spark.range(9), root)
    assert tables.read_table(spark, root, current.schema).count() == 4
    tables.drop_version(spark, unpublished)
    tables.replace_table(spark.range(7), root)
    assert tables.read_table(spark, root, current.schema).count() == 7


def test_append_by_month_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("month"))
    tables.append_table(df, path, ("month",))
    tables.append_table(df, path, ("month",))
    march = spark.read.parquet(path).where("month = 3")
    assert march.count() == 50
    assert "PartitionFilters: [isnotnull(month" in plan_of(march)


def test_bucketed_tables_join_without_a_shuffle(spark):
    left = spark.range(1000).select(F.col("id").alias("customer_id"), F.lit(1).alias("a"))
    right = spark.range(1000).select(F.col("id").alias("customer_id"), F.lit(2).alias("b"))
    tables.save_bucketed(left, "bucketed_left", "customer_id", 4)
    tables.save_bucketed(right, "bucketed_right", "customer_id", 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("bucketed_left").join(spark.table("bucketed_right"), "customer_id")
        assert joined.count() == 1000
        assert "Exchange" not in plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE bucketed_left")
        spark.sql("DROP TABLE bucketed_right")


def test_database_options():
    """Only the options are checked: no database is available to connect to."""
    connection = {"url": "jdbc:mysql://host/db", "user": "u"}
    assert database.scan_options(connection, table="t") == {**connection, "fetchsize": "10000", "dbtable": "t"}
    assert database.scan_options(connection, query="SELECT 1")["query"] == "SELECT 1"
    split = database.scan_options(connection, query="SELECT * FROM t", split=("id", 0, 100, 8))
    assert split["dbtable"] == "(SELECT * FROM t) part" and "query" not in split
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "100", "8")
    with pytest.raises(ValueError):
        database.scan_options(connection)


def test_database_tables_are_emptied_children_first(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(
        database, "write_database",
        lambda df, connection, table, replace=False: calls.append((table, replace, df.count())),
    )
    database.replace_database_tables({"customers": spark.range(3), "subscriptions": spark.range(2)}, {})
    assert calls == [
        ("subscriptions", True, 0), ("customers", True, 0), ("customers", False, 3), ("subscriptions", False, 2),
    ]


def test_staging_uses_the_named_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = stage_table(spark.range(5), "numbers")
    assert df.count() == 5 and df.inputFiles()[0].startswith(f"file://{shared_folder(spark)}/tidemark-")
    assert new_path(spark, "x") != new_path(spark, "x")
    assert "Range" not in plan_of(df)


def test_spread_depends_on_the_rows_only(spark):
    rows = spark.range(100).selectExpr("id % 40 as a", "cast(id as double) as b")
    for per_task, parts in ((1_000, 1), (30, 4), (9, 12)):
        layouts = [
            spread(rows.repartition(n), 100, per_task).select(F.spark_partition_id().alias("p"), "a", "b").collect()
            for n in (1, 20)
        ]
        assert layouts[0] == layouts[1] and {r.p for r in layouts[0]} <= set(range(parts))
        assert spread(rows, 100, per_task).rdd.getNumPartitions() == parts


def test_csv_keeps_or_stops(spark, tmp_path):
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("amount", T.DecimalType(12, 2)),
        T.StructField("text", T.StringType()),
    ])
    rows = [(1, 4, Decimal("65.90"), ""), (2, None, None, None), (3, -1, Decimal("0.05"), 'a "q", b'), (4, 0, Decimal("1.00"), "x\ny")]
    files.write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "t.csv"))
    back = files.read_csv(spark, str(tmp_path / "t.csv"), schema, line_breaks=True)
    assert back.schema == schema and sorted(map(tuple, back.collect())) == rows
    for bad in ("9,4.001,1.00,a", "9,4,65.999,a", "9,4,1.00x,a", "9,99999999999,1.00,a", "x,4,1.00,a"):
        (tmp_path / "bad.csv").write_text(f"id,n,amount,text\n{bad}\n")
        with pytest.raises(Exception, match="is no "):
            files.read_csv(spark, str(tmp_path / "bad.csv"), schema).collect()
    (tmp_path / "ok.csv").write_text("id,n,amount,text\n9,4.0,7,a\n")
    assert files.read_csv(spark, str(tmp_path / "ok.csv"), schema).first() == (9, 4, Decimal("7.00"), "a")


def test_side_by_side_keeps_the_order(spark):
    counts = side_by_side(spark, [spark.range(n).count for n in (5, 3, 9)])
    assert counts == [5, 3, 9]


def test_key_type():
    schema = schemas.with_key_type(schemas.CHURN_EVENTS, schemas.T.LongType())
    assert schema["customer_id"].dataType.simpleString() == "bigint"
    assert schema.fieldNames() == schemas.CHURN_EVENTS.fieldNames()


def test_clear_stage_last(spark):
    path = new_path(spark, "gone")
    spark.range(1).write.parquet(path)
    clear_stage(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
