"""Stages of the corpus pipeline on a small fixture with known cases."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm import quality_rules
from tidemark.session import stage_table

GOOD = "The {0} house stands near the {0} river, and nobody has ever lived there for more than a year or two at a time. {1}"
CLOSING = "Another closing line comes last, with enough words of its own."
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def item(spark):
    return spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").first()["text"]


def text(k, more=""):
    return GOOD.format(f"w{k}", " ".join(f"u{k}x{i}" for i in range(30)) + "." + more)


@pytest.fixture()
def rows(item):
    return [
        (1, text(1)), (2, text(1)), (3, text(2)), (3, text(2)), (4, None), (5, ""), (6, "too short"), (None, text(1)), (None, text(9)),
        (7, text(3) + "\nhome | about | contact | imprint\n" + CLOSING), (8, text(5, " " + item)), (9, text(6, " password=abcdefabcdefabcdef")),
        (10, text(7).replace("u7x3 ", "u7changed ")), (11, text(7)), (12, "buy | now | here | more\n" * 30),
    ]


def run_stages(spark, docs, upto):
    for _, stage in corpus_pipeline.STAGES[:upto]:
        docs = stage_table(stage(spark, docs, FOLDER), "test")
    return docs


def test_every_stage(spark, make_docs, rows):
    docs = make_docs(rows)
    kept = run_stages(spark, docs, 1)
    assert kept.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    whole = [(i, t) for i, t in rows if i not in (4, 5, 6, 7, 12)] + [(7, text(3) + "\n" + CLOSING)]
    assert found == sorted(whole, key=str)
    assert all(r["n_chars"] == len(r["text"]) and r["digest"] == "x" and r["kept"] is False for r in kept.collect())
    unique = run_stages(spark, docs, 2).collect()
    assert sorted((str(r["doc_id"]) for r in unique)) == sorted(map(str, [1, 3, 7, 8, 9, 10, 11, None]))
    clean = run_stages(spark, docs, 3).collect()
    assert {r["doc_id"] for r in unique} - {r["doc_id"] for r in clean} == {8}
    safe = {r["doc_id"]: r for r in run_stages(spark, docs, 4).collect()}
    assert safe[9]["text"] == text(6, " [secret]") and safe[9]["n_chars"] == len(safe[9]["text"])
    assert safe[1]["text"] == text(1) and len(safe) == len(clean)
    pieces = run_stages(spark, docs, 5).collect()
    assert {r["doc_id"] for r in pieces} == set(safe)


def test_near_duplicates_leave_one(spark, make_docs):
    base = " ".join(f"n{k}" for k in range(200))
    docs = make_docs([(i, base.replace(f"n{i} ", "edit ")) for i in range(3, 9)])
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()] == [3]


def test_empty_table(spark, make_docs):
    assert run_stages(spark, make_docs([]), 5).collect() == []


def test_rejected_documents_are_judged_once(spark, make_docs):
    from tests.conftest import plan_of

    plan = plan_of(corpus_pipeline.keep_quality(spark, make_docs([(1, text(1))]), FOLDER))
    assert plan.count("xxhash64") <= 2 * plan_of(quality_rules.quality_rules(make_docs([(1, "a")]))).count("xxhash64")


def test_registered(spark):
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()
