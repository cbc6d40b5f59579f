"""Shards, places and the two versions of the slot map."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import runs_python
from tidemark.llm import sharding


def check(rows, found, shards=24):
    assert len(found) == len(rows)
    for shard in {r["shard"] for r in found}:
        places = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert places == list(range(len(places)))
    assert all(0 <= r["shard"] < shards and r["grown_shard"] in (r["shard"], shards) for r in found)


def test_rows(spark, make_docs):
    rows = [(i, "é" * (i % 7)) for i in range(500)] + [(7, "é" * 0)] * 40 + [(None, None), (None, "x"), (1000, None)]
    docs, versions = sharding.shard_documents(make_docs(rows))
    found = docs.collect()
    check(rows, found)
    text_of = dict(rows[:500])
    for r in found:
        if r["doc_id"] is not None and r["doc_id"] < 500:
            data = text_of[r["doc_id"]].encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    assert [(r["size"], r["text_crc32"]) for r in found if r["doc_id"] == 1000] == [(8, 0)]
    assert len({(r["shard"], r["virtual_slot"]) for r in found if r["doc_id"] is None}) == 1
    assert versions.groupBy("version").agg(F.sum("slot_bytes")).distinct().count() == 2
    assert {r[0] for r in versions.groupBy("version").agg(F.sum("slot_bytes").alias("b")).select("b").collect()} == {sum(r["size"] for r in found)}


def test_id_and_shard_count_decide(make_docs):
    all_rows = [(i, f"text {i}") for i in range(300)]
    few = [(i, "other") for i in range(0, 300, 7)]
    one, two = (
        {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in sharding.shard_documents(make_docs(rows))[0].collect()}
        for rows in (all_rows, few)
    )
    assert all(one[i] == two[i] for i in two)


def test_growth_takes_an_even_share_from_every_shard(spark):
    slots = spark.range(sharding.SLOTS).select(F.col("id").cast("int").alias("virtual_slot"), F.lit(1).alias("slot_bytes"))
    first = sharding.first_map(slots, 24)
    grown = sharding.grow_map(first, 24)
    moved = first.alias("a").join(grown.alias("b"), "virtual_slot").where("a.shard != b.shard")
    assert {r[0] for r in moved.select("b.shard").distinct().collect()} == {24}
    taken = [r["count"] for r in moved.groupBy("a.shard").count().collect()]
    assert len(taken) == 24 and max(taken) - min(taken) <= 1 and sum(taken) == sharding.SLOTS // 25
    assert {r["version"] for r in grown.select("version").distinct().collect()} == {2}


def test_rebalance_moves_the_named_slots_only(spark):
    slots = spark.range(sharding.SLOTS).select(F.col("id").cast("int").alias("virtual_slot"), F.lit(5).alias("slot_bytes"))
    first = sharding.first_map(slots, 4)
    moves = spark.createDataFrame([(0, 3), (4, 2)], "virtual_slot int, to_shard int")
    after = {r["virtual_slot"]: r["shard"] for r in sharding.rebalance(first, moves).collect()}
    assert after[0] == 3 and after[4] == 2 and all(after[s] == s % 4 for s in after if s not in (0, 4))
    loads = {r["shard"]: r["bytes"] for r in sharding.shard_loads(first).collect()}
    assert sum(loads.values()) == 5 * sharding.SLOTS


def test_empty_table_and_plan(make_docs):
    docs, _ = sharding.shard_documents(make_docs([]))
    assert docs.collect() == []
    assert not runs_python(docs)


def test_a_hot_id_and_hot_rows_are_divided(make_docs, monkeypatch):
    """Small bounds, so that the hot slot has many parts and the hot row many runs; the result is the same."""
    rows = [(5, f"text {i}") for i in range(300)] + [(6, "same")] * 95 + [(None, None)] * 31 + [(i, "x") for i in range(50)]
    docs = make_docs(rows)
    whole = sorted(str((r["doc_id"], r["size"], r["text_crc32"], r["shard"])) for r in sharding.shard_documents(docs)[0].collect())
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 20)
    monkeypatch.setattr(sharding, "COPIES_AT_ONCE", 10)
    found = sharding.shard_documents(docs.repartition(7))[0].collect()
    check(rows, found)
    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"], r["shard"])) for r in found) == whole
    again = sharding.shard_documents(docs.coalesce(1))[0].collect()
    assert sorted(map(str, found)) == sorted(map(str, again))  # places do not depend on the stored order


def test_stored_versions(spark, make_docs, tmp_path):
    folder = str(tmp_path / "map")
    docs, versions = sharding.shard_documents(make_docs([(i, "t" * i) for i in range(60)]), 24, map_folder=folder)
    assert sharding.map_versions(spark, folder) == [1, 2]
    newest = sharding.open_map(spark, folder)
    assert {r["version"] for r in newest.collect()} == {2}
    moves = spark.createDataFrame([(0, 3)], "virtual_slot int, to_shard int")
    edited = sharding.rebalance(newest, moves)
    assert sharding.save_map(edited, folder) == 3
    with pytest.raises(ValueError):
        sharding.save_map(edited, folder)  # an edit of version 2, which is not the newest one any more
    assert sharding.open_map(spark, folder).where("virtual_slot = 0").first()["shard"] == 3
    old = sharding.open_map(spark, folder, 1)
    assert sorted(old.collect()) == sorted(versions.where("version = 1").collect())
    with pytest.raises(FileNotFoundError):
        sharding.open_map(spark, folder, 9)
    with pytest.raises(ValueError):
        sharding.shard_documents(make_docs([(1, "x")]), map_folder=folder)
