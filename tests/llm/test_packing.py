"""Pieces against the tokenizer itself; plans against their histogram."""

from __future__ import annotations

import random
import threading
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.cutting_stock import plan_rolls
from tidemark.llm.queries import public_tokenizer


def token_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizer())
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID], dtype="<u4")


def check_pieces(rows, pieces):
    """Every id in one piece, sums right, sequences filled from 0 without gaps and not too long."""
    for doc_id, text in rows:
        ids = token_ids(text)
        own = sorted((p for p in pieces if p["doc_id"] == doc_id), key=lambda p: p["start"])
        assert [p["start"] for p in own] == [0, *np.cumsum([p["length"] for p in own])[:-1].tolist()]
        assert sum(p["length"] for p in own) == len(ids)
        for p in own:
            assert p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= packing.MAX_LENGTH
    return sequences


def test_pieces_equal_the_tokenizer(make_docs):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["The", "véry,", "don't", "x2x", "ÄÖß", "…", "a_b", "12345", "日本語", "naïve", "²"]) for _ in range(rng.randrange(0, 900)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n "), (103, "word " * 5000), (104, "say <|endoftext|> now"), (105, "İstanbul \x1c x y")]
    pieces = [r.asDict() for r in packing.pack_documents(make_docs(rows), public_tokenizer()).collect()]
    check_pieces(rows, pieces)


def test_repeated_rows_and_null_ids(make_docs):
    rows = [(1, "a b c")] * 3 + [(None, "d e")]
    pieces = packing.pack_documents(make_docs(rows), public_tokenizer()).collect()
    assert Counter((r["doc_id"], r["length"]) for r in pieces) == {(1, 4): 3, (None, 3): 1}
    assert {r["sequence_id"] for r in pieces} == {0}
    assert sorted(r["offset"] for r in pieces)[0] == 0


def test_empty_table(make_docs):
    assert packing.pack_documents(make_docs([]), public_tokenizer()).collect() == []


def test_padding_is_little_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = [r.asDict() for r in packing.pack_documents(docs, public_tokenizer()).collect()]
    rolls = len({p["sequence_id"] for p in pieces})
    assert sum(p["length"] for p in pieces) / (rolls * packing.MAX_LENGTH) > 0.99


def test_ranks_are_split_into_parts(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 3)
    rows = [(i, "same text here") for i in range(40)]
    pieces = [r.asDict() for r in packing.pack_documents(make_docs(rows), public_tokenizer()).collect()]
    check_pieces(rows, pieces)


def test_plans_hold_every_piece_in_few_rolls():
    rng = random.Random(4)
    for sizes in ([1], [7], [50, 51], list(range(1, 101)), [34, 35, 67], [100]):
        histogram = {s: rng.randrange(1, 400) for s in sizes}
        plan = plan_rolls(histogram, 100)
        held = Counter()
        for pattern, rolls in plan:
            assert sum(s * n for s, n in pattern.items()) <= 100
            held.update({s: n * rolls for s, n in pattern.items()})
        assert held == histogram
    many = {s: 1000 for s in range(1, 101)}
    rolls = sum(n for _, n in plan_rolls(many, 100))
    assert rolls <= 1.01 * sum(s * n for s, n in many.items()) / 100
    assert plan_rolls({}, 10) == []


def test_column_generation_beats_first_fit():
    """Sizes for which longest-first wastes much: 6 rolls of (45, 30, 25) are exact."""
    rolls = sum(n for _, n in plan_rolls({45: 600, 30: 600, 25: 600}, 100))
    assert rolls <= 606


def test_the_plan_needs_no_threads_of_its_own_in_a_driver(spark):
    """On the length histogram of a whole table, while Spark keeps all cores busy."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lengths = docs.select((F.length("text") % 2048 / 4).cast("int").alias("n")).groupBy("n").count().collect()
    histogram = {r["n"] + 1: r["count"] for r in lengths}
    busy = threading.Thread(target=lambda: spark.range(400_000_000).selectExpr("sum(hash(id))").collect())
    busy.start()
    began = time.perf_counter()
    plan = plan_rolls(histogram, 513)
    assert time.perf_counter() - began < 90
    busy.join()
    held = Counter()
    for pattern, rolls in plan:
        held.update({size: n * rolls for size, n in pattern.items()})
    assert held == histogram


def test_a_full_table_of_words_is_begun_anew(monkeypatch):
    monkeypatch.setattr(packing, "_KNOWN_WORDS", 20)
    monkeypatch.setattr(packing, "_KNOWN_UNITS", 20)
    encoder = packing._Encoder(Path(public_tokenizer()).read_text(encoding="utf-8"))
    for k in range(6):
        text = " ".join(f"Wörd{k * 7 + i} it's" for i in range(12))
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        ids, totals = encoder.plain(data, np.array([0, len(data)]))
        assert totals.tolist() == [len(ids)] and (ids == token_ids(text)).all()
