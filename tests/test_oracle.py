"""Every query with an SQL twin gives the same names, types and values in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is not None, str(type(v)), v if v is not None else 0) for v in row])


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_same_result(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    cursor = duck.execute(contract.oracle_sql()[name])
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    names = list(kinds)
    want = [dict(zip(names, row)) for row in cursor.fetchall()]
    assert sorted(df.columns) == sorted(names)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == kinds
    order = sorted(names)
    assert ordered([tuple(r[c] for c in order) for r in df.collect()]) == ordered(
        [tuple(r[c] for c in order) for r in want]
    )
    assert want, "an empty result proves nothing"


def test_twins_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "customer_id", "contract_type", "tenure_months", "is_active", "lifetime_revenue", "total_refunds",
    ]
    assert df.count() == 150


@pytest.mark.parametrize(
    "name", ["null_check", "load_checks", "cohort_lifetime", "mrr_by_month", "feature_table", "customer_clv", "calendar_columns"]
)
def test_customers_without_orders(spark, tmp_path, name):
    """A ninth of the customers has no order and so no dates; they stay, and the checks report them."""
    for table in TABLES:
        if table == "orders":
            spark.read.parquet(f"{SMALL}/orders.parquet").where("o_custkey % 9 <> 4").write.parquet(str(tmp_path / "orders.parquet"))
        else:
            (tmp_path / f"{table}.parquet").symlink_to(f"{SMALL}/{table}.parquet")
    duck = duckdb.connect()
    for table in TABLES:
        files = "orders.parquet/*.parquet" if table == "orders" else f"{table}.parquet"
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{files}'")
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    order = sorted(names)
    want = ordered([tuple(dict(zip(names, row))[c] for c in order) for row in cursor.fetchall()])
    df = contract.queries()[name](spark, str(tmp_path))
    assert ordered([tuple(r[c] for c in order) for r in df.collect()]) == want
    if name == "null_check":
        assert df.where("table_name = 'customers' and column_name = 'signup_date'").first()["n_bad"] > 0
