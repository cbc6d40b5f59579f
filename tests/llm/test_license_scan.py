"""Base places against a word list; template labels against all blocks and templates."""

from __future__ import annotations

import math
import random
import re
import time

import pytest

from tests.llm.conftest import runs_python
from tidemark.llm import license_scan as ls

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_force(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = sorted(
        (i, label)
        for phrase, label in ls.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )
    base = sorted({label for _, label in places})
    labels, best = set(base), 0.0
    for b in range(0, max(1, len(words)), ls.BLOCK_STEP):
        block = set(words[b : b + ls.BLOCK_WORDS])
        for label, template in ls.TEMPLATES:
            t = set(template.split())
            if len(t & block) >= math.ceil(ls.MIN_CONTAINMENT * len(t) - 1e-9):
                labels.add(label)
                best = max(best, len(t & block) / len(t))
    return (
        len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(base),
        ",".join(sorted(labels)), 1.0 if places else best,
    )


def check(rows, df):
    found = df.collect()
    assert len(found) == len(rows)
    text_of = dict(rows)
    for r in found:
        assert tuple(r)[1:] == brute_force(text_of[r["doc_id"]]), r


def test_against_all_blocks(spark, make_docs):
    rng = random.Random(3)
    filler = "the of and to in a is this with by for under work license software free public use code".split()
    texts = [
        None, "", " .. ", "Under the MIT License", "under the mit license under the MIT-license, cc by nc", "CC BY-NC 4.0 cc/by/nc",
        "Released\nunder the MIT\tLicense.", "underthe mit license", "é under the mit license é", "x " * 40_000 + "Apache License, Version 2.0",
    ]
    for _, template in ls.TEMPLATES * 6:
        words = template.split()
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(filler)
        before = [rng.choice(filler + ["zz", "été"]) for _ in range(rng.randrange(0, 90))]
        texts.append(" ".join(before + words + before[:7]))
    given = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    rows = list(enumerate(texts + given))
    df = ls.scan_licenses(make_docs(rows))
    check(rows, df)
    assert not runs_python(df)


def test_repeats_nulls_and_empty_table(make_docs):
    rows = [(1, "Licensed under CC BY-SA 4.0.")] * 3 + [(None, "Licensed under CC BY-SA 4.0.")]
    found = ls.scan_licenses(make_docs(rows)).collect()
    assert [r["labels"] for r in found] == ["cc-by-sa"] * 4 and all(r["score"] == 1.0 and r["n_base"] == 0 for r in found)
    assert ls.scan_licenses(make_docs([])).collect() == []


def test_order_runs_from_rare_to_frequent():
    tokens, rows = ls.ordered_templates({"a": 5, "b": 1}, (("x", "a b c"), ("y", "a a")))
    assert tokens == ["c", "b", "a"]
    assert rows == [(0, "x", [1, 2, 3], 3), (1, "y", [3], 1)]


def test_whole_license_texts_as_templates(make_docs):
    rng = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "lnrst"]
    license_text = " ".join(rng.choices(vocabulary, k=400)).capitalize() + "."
    other = " ".join(rng.choices(vocabulary, k=20))
    words = license_text.split()
    changed = [w if k % 50 else "other" for k, w in enumerate(words)]
    rows = [
        (1, "zz " * 45 + license_text), (2, " ".join(changed)), (3, " ".join(words[:200])), (4, other + " zz"),
        (5, " ".join(words[200:] + words[:200])), (6, "zz"),
    ]
    df = ls.scan_licenses(make_docs(rows), templates=[("long", license_text), ("short", other), ("none", " . ")])
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in df.collect()}
    assert {i: label for i, (label, _) in found.items()} == {1: "long", 2: "long", 3: "", 4: "short", 5: "long", 6: ""}
    assert found[1][1] == 1.0 and 0.9 <= found[2][1] < 1.0 and found[3][1] == 0.0
    pieces = ls.passages([("long", license_text)])
    assert " ".join(p[2] for p in pieces) == license_text.lower().rstrip(".") and all(len(p[2].split()) <= 33 for p in pieces)
    with pytest.raises(ValueError):
        ls.scan_licenses(make_docs(rows), templates=[])


def test_one_very_long_text(make_docs):
    """A text of 600,000 words, most of which are template tokens, in blocks that all hold a rare one."""
    text = "the software license version of gnu " * 100_000 + "Licensed under CC BY-SA 4.0"
    began = time.monotonic()
    found = ls.scan_licenses(make_docs([(1, text)])).collect()
    assert found[0]["labels"] == "cc-by-sa" and found[0]["n_words"] == 600_007
    assert time.monotonic() - began < 60
