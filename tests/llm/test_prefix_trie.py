"""Prefix trie against a plain dictionary of prefixes, with shards and segments of every shape."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth int, position string, n_convs long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture
def table(spark):
    """Turns with columns whose names the operator uses itself."""
    return lambda rows: spark.createDataFrame([(*r, 7, "x", 9) for r in rows], SCHEMA)


def ordered(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}


def spliced(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute_force(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, who in members.items():
        worth = (len(who) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += node not in kids
    out = set()
    for node, who in members.items():
        ends = ",".join(str(c) for c in who if len(convs[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.add((who[0], len(node), parent, len(who), kids[node], leaves[node], saved[node],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(found, convs):
    assert found.columns == COLUMNS
    rows = [tuple(r) for r in found.collect()]
    expected = brute_force(convs)
    assert len(rows) == len(expected) and set(rows) == expected


def plain(df):
    numbered = pt.number_turns(df)
    return pt.prefix_trie(numbered, df.where("conv_id is not null").select("conv_id"))


def random_rows(seed, n_convs=60, longest=7, words=2):
    rng = random.Random(seed)
    return [
        (3 * c - 40, turn, rng.choice(["user", "assistant"][:words]), rng.choice("aé"[:words]) * rng.randint(1, 2))
        for c in range(n_convs) for turn in range(rng.randint(1, longest))
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(table, monkeypatch, seed):
    monkeypatch.setattr(pt, "SHARD_BITS", 2 + seed)  # several shards of 8 or 16
    monkeypatch.setattr(pt, "SEGMENT", 3)  # several segments
    rows = random_rows(seed)
    check(plain(table(rows).repartition(4)), ordered(rows))


def test_spliced_conversations(table):
    rows = random_rows(3, 80, 12) + [(c, 0, "user", "only") for c in (901, 902, 905, 907)]
    rows += [(c, t, "user", f"long {t}") for c in (1000, 1001) for t in range(30)]
    turns, convs = pt.splice(pt.number_turns(table(rows)))
    again = spliced(ordered(rows))
    assert any(not v for v in again.values())  # turnless ones are members of the root
    check(pt.prefix_trie(turns, convs), again)


def test_long_conversations_and_many_copies(table):
    rows = [(c, t, "user", f"t{t}") for c in range(4) for t in range(600 - 100 * (c == 3))]
    rows += [(100 + c, t, "user", f"same {t}") for c in range(1200) for t in range(2)]
    check(plain(table(rows)), ordered(rows))


def test_nulls_ties_and_repeated_rows(table):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, "", ""), (1, 0, "", ""), (1, 5, "user", None),
        (2, None, "user", "first"), (2, None, "user", "first"), (None, 1, "user", "lost"), (3, 1, "b", "x"), (3, 1, "a", "y"),
        (4, 1, "a", "y"), (4, 1, "b", "x"), (5, -3, "", "\U0001d54f" * 50_000),
    ]
    check(plain(table(rows)), ordered(rows))


def test_one_conversation_with_most_rows_is_numbered_in_ranges(table):
    rows = [(1, t // 3, "user", f"{t % 2}") for t in range(900)] + [(c, 0, "user", "x") for c in range(2, 50)]
    df = table(rows).repartition(3)
    numbered = pt.number_turns(df)
    places = sorted(r["position"] for r in numbered.where("conv_id = 1").collect())
    assert places == list(range(900))
    check(plain(df), ordered(rows))


def test_no_turns(table, spark):
    empty = table([])
    assert plain(empty).collect() == []
    turns, convs = pt.splice(pt.number_turns(empty))
    assert pt.prefix_trie(turns, convs).collect() == []
    lone = pt.prefix_trie(pt.number_turns(empty), spark.createDataFrame([(7,), (8,)], "conv_id long"))
    assert [tuple(r) for r in lone.collect()] == [(7, 0, None, 2, 0, 1, 0, hashlib.sha256(b"7,8").hexdigest())]


def test_sums_follow_deep_chains_in_few_rounds(table, monkeypatch):
    staged = []
    monkeypatch.setattr(pt, "stage_table", lambda df, name, real=pt.stage_table: (staged.append(name), real(df, name))[1])
    rows = [(c, t, "user", f"t{t}") for c in range(2) for t in range(200)]
    found = plain(table(rows))
    assert staged.count("sums") == 1 + 8
    root = found.where(F.col("depth") == 0).first()
    assert root["saved_tokens"] == sum(len(f"t{t}") for t in range(200)) and root["n_leaves"] == 1
