from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import splits
from tidemark.session import stage_table


def expected_test_keys(keys, share, seed=42):
    ranked = sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())
    return set(ranked[:share])


@pytest.mark.parametrize("n, positives, size", [(1000, 300, 0.2), (17, 5, 0.2), (103, 1, 0.25), (50, 0, 0.2), (2, 1, 0.5)])
def test_stratified_counts_are_exact(spark, n, positives, size):
    df = spark.range(n).select("id", (F.col("id") < positives).cast("int").alias("y"))
    rows = splits.exact_split(df, "id", "y", size).collect()
    assert len(rows) == n
    n_test = math.ceil(size * n)
    taken = {y: {r.id for r in rows if r.is_test and r.y == y} for y in (0, 1)}
    assert len(taken[0]) + len(taken[1]) == n_test
    for y, members in ((1, range(positives)), (0, range(positives, n))):
        assert abs(len(taken[y]) - len(members) * n_test / n) < 1
        assert taken[y] == expected_test_keys(members, len(taken[y]))


def test_quota_of_a_hundred_billion_rows(spark):
    counts = spark.createDataFrame([(0, 70_000_000_001), (1, 30_000_000_000)], "_label int, n bigint")
    quota = {r._label: r.quota for r in splits._test_quota(counts, 0.2).collect()}
    assert sum(quota.values()) == math.ceil(0.2 * 100_000_000_001)
    assert quota[1] in (6_000_000_000, 5_999_999_999, 6_000_000_001)


def test_unlabelled_split(spark):
    rows = splits.exact_split(spark.range(1001), "id").collect()
    assert {r.id for r in rows if r.is_test} == expected_test_keys(range(1001), 201)


def test_split_is_stable_under_partitioning(spark):
    df = spark.range(500)
    a = {r.id for r in splits.exact_split(df.repartition(7), "id").where("is_test").collect()}
    b = {r.id for r in splits.exact_split(df.coalesce(1), "id").where("is_test").collect()}
    assert a == b


def test_rows_of_one_key_stay_together(spark):
    hot = spark.range(1000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    rows = splits.exact_split(hot, "id", whole_keys=True).groupBy("id").agg(
        F.min(F.col("is_test").cast("int")).alias("lo"), F.max(F.col("is_test").cast("int")).alias("hi"),
        F.count("*").alias("n"),
    ).collect()
    assert all(r.lo == r.hi for r in rows)
    assert sum(r.n for r in rows) == 1000
    ranked = sorted(rows, key=lambda r: hashlib.md5(f"42:{r.id}".encode()).hexdigest())
    taken = 0
    for r in ranked:
        if taken + r.n > 200:
            break
        taken += r.n
    assert sum(r.n for r in rows if r.hi) == taken


@pytest.mark.parametrize("labelled", [True, False])
def test_hot_keys_are_divided_exactly(spark, labelled):
    """600 rows, a third of them on one key, for different hot keys: always 120 test rows."""
    for hot in range(6):
        key = F.when(F.col("id") % 3 == 0, 10_000 + hot).otherwise(F.col("id"))
        df = stage_table(spark.range(600).select(key.alias("id"), (F.col("id") % 4 == 0).cast("int").alias("y")), "hot")
        split = splits.exact_split(df, "id", "y" if labelled else None)
        assert split.groupBy().agg(F.count("*"), F.count_if("is_test")).first() == (600, 120)


def test_rows_of_a_divided_key_do_not_depend_on_their_places(spark):
    """Half of the rows on one key, a third of those equal: the same test rows from 1 and from 7 partitions."""
    key = F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id"))
    content = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id"))
    df = spark.range(900).select(key.alias("id"), content.alias("v"), F.lit(1).alias("y"))
    for seed in range(4):
        sides = []
        for n in (1, 7):
            rows = stage_table(df.repartition(n, F.rand(seed)), "layout")
            split = splits.exact_split(rows, "id", "y", seed=seed)
            sides.append(sorted(split.where("is_test").collect(), key=str))
        assert sides[0] == sides[1] and len(sides[0]) == 180


def test_empty_split(spark):
    assert splits.exact_split(spark.range(0), "id").count() == 0


def test_sample(spark):
    got = [r.id for r in splits.sample_rows(spark.range(1000), "id", 10).collect()]
    assert set(got) == expected_test_keys(range(1000), 10)
    assert splits.sample_rows(spark.range(3), "id", 500).count() == 3
    assert set(got) != {r.id for r in splits.sample_rows(spark.range(1000), "id", 10, seed=1).collect()}
