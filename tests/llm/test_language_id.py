"""Hyperdimensional profiles against plain Python sums of n-grams, edge cases, and held-out accuracy."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id as lid

WORDS = {
    "en": "the and that with from this have which there their being would ing tion".split(),
    "de": "der die und nicht mit auch über schön einer werden sich können straße".split(),
    "fr": "les des une est pas où été même être avec dans ça leur façon très".split(),
}


def sample_text(lang, seed, n=60):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def plain_bundle(text):
    """Sum over all n-grams, one after another."""
    symbols = []
    for c in f" {text.lower()} ":
        if c.isalpha():
            symbols.append(ord(c))
        elif not symbols or symbols[-1] != 0:
            symbols.append(0)
    vectors = {s: lid.letter_vectors(np.array([s]))[0].astype(int) for s in set(symbols)}
    out = np.zeros(lid.DIMENSIONS, dtype=int)
    for gram in zip(*[symbols[k:] for k in range(lid.GRAM)]):
        bound = np.ones(lid.DIMENSIONS, dtype=int)
        for place, s in enumerate(gram):
            bound *= np.roll(vectors[s], lid.GRAM - 1 - place)
        out += bound
    return out


TEXTS = ["Straße, 12 straße!", "a", "", "12 34", "  x  ", "ÀÉあ漢字 \U0001d54f", "one\n\n-- two 3 three" * 5, None, "İstanbul"]


@pytest.mark.parametrize("chars", [5, 7, 64, 1_000_000])
def test_counts_are_those_of_whole_texts_however_they_are_sliced(monkeypatch, chars):
    monkeypatch.setattr(lid, "CHARS_AT_ONCE", chars)
    sums = np.zeros((len(TEXTS), lid.DIMENSIONS))
    for grams in lid.count_grams(TEXTS):
        sums += lid.bundle(grams, len(TEXTS))
    for text, found in zip(TEXTS, sums):
        assert (found == plain_bundle(text or "")).all(), text


def test_many_different_grams_are_bundled_in_parts(monkeypatch):
    monkeypatch.setattr(lid, "_GRAMS_AT_ONCE", 10)
    monkeypatch.setattr(lid, "_SMALL_ALPHABET", 3)
    text = "".join(chr(0x4E00 + i) + (" " if i % 7 == 0 else "") for i in range(200))
    (grams,) = lid.count_grams([None, text])
    assert (lid.bundle(grams, 2)[1] == plain_bundle(text)).all()


def test_letter_vectors_are_near_orthogonal():
    vectors = lid.letter_vectors(np.arange(97, 123)).astype(int)
    assert set(np.unique(vectors)) == {-1, 1}
    for a, b in itertools.combinations(vectors, 2):
        assert abs(a @ b) < 6 * lid.DIMENSIONS**0.5


def test_against_brute_force(make_docs, spark):
    rows = [(i, sample_text(lang, i)) for i, lang in enumerate(list(WORDS) * 8)]
    langs = dict(enumerate(list(WORDS) * 8))
    docs = make_docs(rows).drop("lang").join(spark.createDataFrame(list(langs.items()), "doc_id long, lang string"), "doc_id")
    profiles = lid.learn_profiles(docs.where("doc_id < 12"))
    sums = {lang: sum(plain_bundle(t) for i, t in rows if langs[i] == lang and i < 12) for lang in WORDS}
    assert profiles.languages == sorted(WORDS)
    found = {r["doc_id"]: r for r in lid.identify(docs, profiles, carry=["doc_id", "kept"]).collect()}
    assert len(found) == len(rows) and found[0]["kept"] is False
    for i, text in rows:
        v = plain_bundle(text)
        cosine = {lang: v @ s / np.linalg.norm(v) / np.linalg.norm(s) for lang, s in sums.items()}
        best = max(sorted(cosine), key=cosine.get)
        assert found[i]["lang_pred"] == best == langs[i]
        assert found[i]["score"] == pytest.approx(cosine[best], abs=1e-9)


def test_learning_does_not_depend_on_order_or_partitions(make_docs):
    docs = make_docs([(i, sample_text("de", i)) for i in range(40)])
    one = lid.learn_profiles(docs.coalesce(1)).prototypes
    many = lid.learn_profiles(docs.orderBy(F.desc("doc_id")).repartition(7)).prototypes
    assert (one == many).all()


def test_null_empty_long_and_repeated(make_docs, spark):
    long_text = sample_text("en", 1, 300_000)
    rows = [(1, None), (2, ""), (3, "12 !? 34"), (4, "z"), (5, long_text), (5, long_text), (None, "abc")]
    docs = make_docs(rows)
    profiles = lid.learn_profiles(make_docs([(9, sample_text("en", 2)), (8, None), (7, "")]))
    found = lid.identify(docs.withColumn("held_out", lid.held_out(F.col("doc_id"))), profiles, ["doc_id", "held_out"]).collect()
    pred = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert [pred[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert pred[4][0] == pred[5][0] == pred[None][0] == "en" and pred[5][1] > 0.8
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    for r in found:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_ties_go_to_the_first_language(make_docs, spark):
    both = spark.createDataFrame([("same words", "b"), ("same words", "a"), ("other", None)], "text string, lang string")
    profiles = lid.learn_profiles(both)
    assert profiles.languages == ["a", "b"]
    assert lid.identify(make_docs([(1, "same words")]), profiles).first()["lang_pred"] == "a"


def test_empty_tables_and_too_many_languages(make_docs, monkeypatch):
    nothing = lid.learn_profiles(make_docs([]))
    assert nothing.languages == []
    assert [tuple(r) for r in lid.identify(make_docs([(1, "text")]), nothing).collect()] == [(1, "und", 0.0)]
    docs = make_docs([(1, "text")])
    assert lid.identify(make_docs([]), lid.learn_profiles(docs)).collect() == []
    monkeypatch.setattr(lid, "MAX_LANGUAGES", 0)
    with pytest.raises(ValueError, match="languages"):
        lid.learn_profiles(docs)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("out", lid.held_out(F.col("doc_id")))
    profiles = lid.learn_profiles(docs.where("not out"))
    found = lid.identify(docs, profiles, carry=["doc_id", "lang", "out"]).where("out")
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 250 and right / n >= 0.98
