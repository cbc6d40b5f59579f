"""Components against all pairs; signatures against exact similarity."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidemark.llm import near_dedup
from tidemark.llm.components import connected_components
from tidemark.llm.superminhash import EMPTY, signatures
from tidemark.llm.words import find_words, shingle_sets, text_chunks, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """{id: (set size, least id reachable)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                label[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def test_components_equal_all_pairs(make_docs):
    rng = random.Random(5)
    rows = []
    for _ in range(25):
        base = [f"v{rng.randrange(500)}" for _ in range(rng.choice([6, 30, 120, 600]))]
        for _ in range(rng.randrange(1, 12)):
            rows.append(edited(rng, base, rng.randrange(0, 1 + len(base) // 25)))
    rows += [rows[0], rows[0].upper(), rows[3] + " \n\t", "one two", "one two", "One  two", "one two three", "", "  \n"]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    found = result(near_dedup.near_duplicates(make_docs(rows)))
    assert found == brute_force(rows)
    assert len({c for _, c in found.values()}) < len(rows) - 30


def test_large_bucket_is_compared_in_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 4)
    rng = random.Random(2)
    base = [f"b{k}" for k in range(150)]
    rows = [(i, edited(rng, base, rng.randrange(0, 12))) for i in range(60)]
    assert result(near_dedup.near_duplicates(make_docs(rows))) == brute_force(rows)


def test_nulls_ties_repeats_and_long_texts(make_docs):
    long_text = " ".join(f"x{k}" for k in range(60_000))
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f"), (None, "a b c d e f"), (None, "alone here"), (1, None), (2, ""), (3, long_text), (4, long_text + " y")]
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(make_docs(rows)).collect()}
    assert found == {
        (5, 2, 5, True), (9, 2, 5, False), (None, 2, 5, False), (None, 1, None, True), (1, 0, 1, True), (2, 0, 2, True),
        (3, 59_996, 3, True), (4, 59_997, 3, False),
    }


def test_empty_table(make_docs):
    assert near_dedup.near_duplicates(make_docs([])).collect() == []


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(100):
        base = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
        a, b = base[:270], base[30:]
        ranks = signatures([a, b], 168)
        errors.append((ranks[0] == ranks[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < np.sqrt(0.8 * 0.2 / 168)


def test_small_sets_fill_all_places_and_empty_sets_none():
    ranks = signatures([np.array([7], dtype=np.uint64), np.zeros(0, dtype=np.uint64)], 64)
    assert sorted((ranks[0] >> np.uint64(48)).tolist()) == list(range(64))
    assert (ranks[1] == EMPTY).all()


def test_words_do_not_cross_texts():
    import pyarrow as pa

    texts = ["ab", "cd ef", None, "", " x\x0byé "]
    _, _, data, offsets = next(text_chunks(pa.array(texts)))
    words = find_words(data, offsets)
    found = [bytes(data[a:b]).decode() for a, b in zip(words.start, words.end)]
    assert found == ["ab", "cd", "ef", "x", "yé"]
    assert words.first.tolist() == [0, 1, 3, 3, 3, 5]
    assert [len(s) for s in shingle_sets(words, word_hashes(words))] == [1, 1, 0, 0, 1]


@pytest.mark.parametrize("links", [[], [(1, 1)], [(1, 2), (3, 2), (7, 8)], [(k, k + 1) for k in range(40)]])
def test_connected_components(spark, links):
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {}
    groups = []
    for a, b in links:
        if a != b:
            near = [g for g in groups if a in g or b in g]
            groups = [g for g in groups if g not in near] + [set().union({a, b}, *near)]
    for g in groups:
        want |= {x: min(g) for x in g}
    assert found == want
