"""Measures against a plain Python count, and verdicts of single lines."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {k for starts in windows.values() if len(starts) > 1 for i in starts for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def test_measures(spark, make_docs):
    texts = [
        None, "", " \n\t\x0b", "a", "a b c d e a b c d e", "a a a a a a a a", "x y\nx y\n\n \nx y \nx y", " é ü\r\nq #*$%&|<> z",
        "one two three four five six seven eight nine ten eleven " * 3, " ".join(f"w{k}" for k in range(30_000)), "l\n" * 50,
    ]
    given = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rows = list(enumerate(texts + given))
    found = quality_rules.quality_rules(make_docs(rows)).collect()
    assert len(found) == len(rows)
    text_of = dict(rows)
    for r in found:
        want = brute_force(text_of[r["doc_id"]])
        assert {k: r[k] for k in want} == want
        assert not (r["kept"] and r["base_failed"])


@pytest.mark.parametrize(
    "line, rule",
    [
        ("", None), ("A plain sentence stands here.", None), ("Released under the MIT License.", None),
        ("home | about | contact | imprint", "navigation"), ("Home » News » Sport » Today", "navigation"),
        ("Wir sind, wie gesagt, nicht da", None), ("Read more", "punctuation"), ("Why?", None),
        ("this&&& has%%% many*** marks###", "punctuation"), ("WORD!! WORD!! WORD!! WORD!!", "punctuation"),
        ("We use cookies to make this site better.", "boilerplate"), ("Il a dit « oui » et puis non, enfin peut-être.", None),
    ],
)
def test_lines(spark, line, rule):
    parts = spark.createDataFrame([(line,)], "x string").select(quality_rules._line_parts(F.col("x")).alias("p"))
    assert parts.select(quality_rules.line_verdict(F.col("p"))).first()[0] == rule


@pytest.mark.parametrize(
    "line, rule",
    [
        ("iVBORw0KGgo" * 60, "punctuation"), ("iVBORw0KGgo" * 60 + ".", None),
        (" ".join("q" * 150 for _ in range(4)), "punctuation"), (" ".join("q" * 150 for _ in range(5)), None),
        ("We use cookies " + " ".join("x" * 40 for _ in range(17)) + ".", "boilerplate"),
        ("We use cookies " + " ".join("x" * 40 for _ in range(22)) + ".", "boilerplate"),
        ("We use cookies " + " ".join("x" * 40 for _ in range(23)) + ".", None),
        ("We use cookies " + " \t ".join("x" * 4 for _ in range(200)) + " \t ", None),
    ],
)
def test_long_lines_meet_the_same_rules(spark, line, rule):
    assert len(line) > 400
    test_lines(spark, line, rule)


def test_documents_of_long_lines_without_words_go(make_docs):
    text = "\n".join(f"{k}" + "iVBORw0KGgo" * 60 for k in range(12))
    short = "\n".join(f"{k}" + "iVBORw0KGgo" * 30 for k in range(12))
    found = {r["doc_id"]: r for r in quality_rules.quality_rules(make_docs([(1, text), (2, short)])).collect()}
    assert [(found[i]["n_removed"], found[i]["kept"]) for i in (1, 2)] == [(12, False)] * 2


def test_lines_go_and_documents_that_lose_too_much(make_docs):
    good = "This line has quite a few words in it and it ends well."
    other = "Another sentence of some length follows here, with words of its own."
    rows = [(1, f"{good}\nhome | about | contact | help\n{other}"), (2, "home | about | contact | help | more | some\n" * 8 + good)]
    found = {r["doc_id"]: r for r in quality_rules.quality_rules(make_docs(rows)).collect()}
    assert found[1]["clean_text"] == f"{good}\n{other}" and found[1]["kept"] and found[1]["n_removed"] == 1
    assert not found[2]["kept"]


def test_good_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.quality_rules(docs).join(labels, "doc_id").groupBy("quality", "base_failed", "kept").count().collect()
    assert sum(r["count"] for r in judged if r["quality"] == 1 and not r["base_failed"] and not r["kept"]) == 0
    assert sum(r["count"] for r in judged if r["quality"] == 0 and r["kept"]) == 0


def test_no_python_and_no_shuffle(make_docs):
    from tests.conftest import plan_of
    from tests.llm.conftest import runs_python

    df = quality_rules.quality_rules(make_docs([(1, "a")]))
    assert not runs_python(df) and "Exchange" not in plan_of(df)
    assert quality_rules.quality_rules(make_docs([])).collect() == []
