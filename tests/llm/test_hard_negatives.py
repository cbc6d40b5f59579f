"""Hard negatives against brute force over all rows, tree bounds, and edge cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score double, place int, code string"


@pytest.fixture
def table(spark):
    """Rows with columns whose names the operator uses itself."""
    return lambda rows: spark.createDataFrame([(i, v, label, 0.5, 3, "x") for i, v, label in rows], SCHEMA)


def brute_force(rows, is_anchor, n_pos=5, n_neg=5):
    fit = set()
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = set()
    for i, label, a in fit:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, b)), j, m) for j, m, b in fit if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:n_pos]:
            window = [(t, k) for t, k, m in scored if m != label and -80 * s <= -100 * t <= -100 * s]
            out |= {(i, j, r, k, -s, -t) for r, (t, k) in enumerate(window[:n_neg], 1)}
    return out


def mined(df, **more):
    return [tuple(r) for r in hn.mine_hard_negatives(hn.scaled(df), "vec_id % 10 = 0", **more).collect()]


def test_clusters_copies_and_ties(table, monkeypatch):
    monkeypatch.setattr(hn, "PASS_BYTES", 500)  # several passes
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.2 * rng.normal(size=8)).tolist(), i // 6 % 3) for i in range(300)]
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(60)]  # copies over two labels, anchors among them
    rows += [(2000 + i, [0.0] * 8, 1) for i in range(20)] + rows[:5]
    found = mined(table(rows).repartition(5))
    expected = brute_force(rows, lambda i: i % 10 == 0)
    assert len(found) == len(expected) and set(found) == expected
    assert len({r[0] for r in found}) > 30


def test_other_list_lengths(table):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist(), i % 2) for i in range(80)]
    assert set(mined(table(rows), n_positives=2, n_negatives=7)) == brute_force(rows, lambda i: i % 10 == 0, 2, 7)


def test_rows_that_take_no_part_and_odd_vectors(table):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.9, 0.4], 2), (3, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1),
        (6, [1.0, -inf], 2), (7, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (10, [0.0, 0.0], 2), (11, [0.0, 0.0], 2),
        (20, [], 1), (30, [1.0], 2), (31, [1.0, 0.1, 9.0], 2), (40, [-1.0, 0.0], 3), (50, [1.0, 0.0], 3), (-10, [1.0, 0.3], 1),
    ]
    assert set(mined(table(rows))) == brute_force(rows, lambda i: i % 10 == 0)


def test_scores_beyond_exact_floats(table):
    rows = [(i, [3e5 + i / 256, 2e5, 1e5 * (i % 3)], i % 2) for i in range(25)]
    found = mined(table(rows))
    assert set(found) == brute_force(rows, lambda i: i % 10 == 0) and max(r[4] for r in found) > 2**53
    assert mined(table([(0, [1e38], 1), (1, [2e38], 1), (2, [1e38], 2)])) == [(0, 1, 1, 2, 2**56, 2**56)]


def test_empty_tables_and_no_anchor(table):
    assert mined(table([])) == []
    assert mined(table([(1, [1.0], 1), (2, [1.0], 2)])) == []
    assert hn.mine_hard_negatives(hn.scaled(table([])), "false").columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]


def random_block(rng, n, dim, spread):
    centres = rng.normal(size=(10, dim))
    vectors = np.floor(256 * (centres[rng.integers(0, 10, n)] + spread * rng.normal(size=(n, dim)))).astype(np.int64)
    return hn.Block(rng.integers(0, 3, n), vectors, hn._norms(vectors), np.arange(n + 1), np.arange(n)), centres


def test_walk_yields_every_row_of_a_window_and_spares_most_others():
    rng = np.random.default_rng(5)
    block, centres = random_block(rng, 2000, 16, 0.05)
    anchors = np.floor(256 * (np.repeat(centres, 20, axis=0) + 0.05 * rng.normal(size=(200, 16)))).astype(np.int64)
    tree = hn.spanning_tree(np.arange(200), rng.integers(0, 3, 200), anchors)
    exact = tree.vectors @ block.vectors.T
    floor = np.quantile(exact, 0.97, axis=1)
    yielded = {}
    for k, rows, scores in hn._walk(tree, hn._norms(tree.vectors), block, floor, np.full(200, np.inf), same=True):
        assert (exact[k, rows] == scores).all()
        yielded[k] = set(rows.tolist())
    for k in range(200):
        assert set(np.flatnonzero((exact[k] >= floor[k]) & (block.labels == tree.labels[k])).tolist()) <= yielded.get(k, set())
    scored = sum(len(rows) for k, rows in yielded.items() if k)
    assert scored < 0.5 * (block.labels[None, :] == tree.labels[1:, None]).sum()


def test_tree_spans_and_is_minimal():
    rng = np.random.default_rng(6)
    vectors = rng.integers(-50, 50, (40, 3))
    tree = hn.spanning_tree(np.arange(40), np.zeros(40, dtype=np.int64), vectors)
    assert sorted(tree.class_ids) == list(range(40)) and (tree.parent[1:] < np.arange(1, 40)).all()
    lengths = sorted((float(np.linalg.norm(vectors[a] - vectors[b])), a, b) for a in range(40) for b in range(a))
    group, total = list(range(40)), 0.0
    for length, a, b in lengths:  # Kruskal
        if group[a] != group[b]:
            total += length
            group = [group[a] if g == group[b] else g for g in group]
    assert tree.edge.sum() == pytest.approx(total)


def test_ids_are_whole(table):
    frame = hn.scaled(table([(i, [1.0, 1.0], i % 2) for i in range(40)]))
    found = hn.mine_hard_negatives(frame, "vec_id % 10 = 0")
    assert found.groupBy("anchor_id").agg(F.countDistinct("positive_id").alias("n")).where("n != 5").count() == 0
    assert {r["negative_id"] for r in found.collect()} == {1, 3, 5, 7, 9}
