"""Shape of the physical plans: no cross products, pruned scans, few shuffles of raw rows."""

from __future__ import annotations

import re
from functools import cache

import pytest

from tests.conftest import SMALL, plan_of
from tidemark.operators import churn, revenue, splits
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def query_plan(spark):
    """Plan of a registered query; building one may run staged parts, so each is built once."""
    return cache(lambda name: plan_of(QUERIES[name](spark, SMALL)))


def tree(plan: str) -> str:
    """The operator tree at the top of a formatted plan."""
    return plan.split("== Physical Plan ==")[1].split("\n\n")[0]


@pytest.mark.parametrize("name", list(ORACLE))
def test_no_cross_products(query_plan, name):
    plan = query_plan(name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_scans_are_pruned(star):
    plan = plan_of(churn.churn_rate_by(star.subscriptions, "contract_type"))
    schemas = re.findall(r"ReadSchema: (\S+)", plan)
    assert sorted(schemas) == sorted([
        "struct<c_custkey:bigint,c_mktsegment:string>", "struct<o_custkey:bigint,o_orderdate:timestamp_ntz>",
    ])


def test_months_of_transactions_need_no_join(star):
    plan = plan_of(revenue.mrr_by_month(star.subscriptions, star.transaction_dates))
    assert "EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_returnflag:string,l_shipdate:timestamp_ntz>" in plan
    assert tree(plan).count("Join") == 1


def test_transactions_are_totalled_before_the_join(star):
    plan = plan_of(revenue.customer_clv(star.customers, star.subscriptions, star.transactions))
    assert "partial_sum" in plan


def test_split_moves_no_rows(spark):
    """The flagged rows come straight from a scan."""
    flagged = splits.exact_split(spark.read.parquet(f"{SMALL}/customer.parquet"), "c_custkey")
    shape = tree(plan_of(flagged))
    assert "Scan" in shape and "Join" not in shape and "Exchange" not in shape


@pytest.mark.parametrize("name", [n for n in ORACLE if n not in ("binary_metrics_unrounded",)])
def test_windows_see_aggregated_rows_only(query_plan, name):
    lines = tree(query_plan(name)).splitlines()
    for i, line in enumerate(lines):
        if re.search(r"- Window \(", line):
            below = lines[i + 1:]
            until_scan = below[: next(j for j, x in enumerate(below) if "Scan" in x)]
            assert any("HashAggregate" in x for x in until_scan), "\n".join(lines)
