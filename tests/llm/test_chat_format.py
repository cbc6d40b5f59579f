"""Shared prefixes, rendering and masks against plain Python."""

from __future__ import annotations

import pytest

from tests.llm.conftest import runs_python
from tidemark.llm import chat_format as cf

PAIR = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt int"
U, A, S = "user", "assistant", "system"


def rendered(turns):
    return "".join(f"{cf.TURN_START}{r}\n{t}{cf.TURN_END}\n" for r, t in turns)


def expected(chosen, rejected):
    chosen, rejected = chosen or [], rejected or []
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    out = [n, rendered(chosen[:n])]
    for side in (chosen[n:], rejected[n:]):
        at, spans = 0, []
        for r, t in side:
            start = at + len(cf.TURN_START) + len(r) + 1
            end = start + len(t) + len(cf.TURN_END)
            if r == A:
                spans.append(f"{start}:{end}")
            at = end + 1
        out += [rendered(side), ",".join(spans)]
    return tuple(out)


CASES = [
    ([(U, "q"), (A, "good é😀")], [(U, "q"), (A, "bad")]),
    ([(S, "s"), (U, "q"), (A, "a"), (U, "r"), (A, "x")], [(S, "s"), (U, "q"), (A, "a"), (U, "r"), (A, "y"), (U, "z"), (A, "w")]),
    ([(U, "q"), (A, "same")], [(U, "q"), (A, "same")]), ([], [(A, "only")]), (None, None), ([(A, "x")], None),
    ([(U, "q")], [(A, "q")]), ([(U, "a"), (A, "b")], [(U, "a")]), ([(U, ""), (A, "")], [(U, ""), (A, "c" * 20_000)]),
]


def test_pairs(spark):
    df = spark.createDataFrame([(i, c, r, 1) for i, (c, r) in enumerate(CASES)], PAIR)
    out = cf.format_preferences(df)
    found = {r["pair_id"]: (r["n_shared"], r["prompt"], r["chosen"], r["chosen_mask"], r["rejected"], r["rejected_mask"]) for r in out.collect()}
    assert found == {i: expected(c, r) for i, (c, r) in enumerate(CASES)}
    assert not runs_python(out)


def test_from_turns(spark):
    rows = [
        (1, 1, A, "one two three four", 0), (1, 0, U, "hi", 0), (2, 0, U, "alone", 0), (3, 0, None, None, 0), (3, 1, A, "w", 0),
        (None, 0, U, "q", 0), (None, 1, A, "x y", 0), (4, 0, U, "a", 0), (4, 0, U, "a", 0), (4, 1, A, "m n", 0), (4, 2, U, "end", 0),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    out = cf.format_preferences(cf.with_cut_answer(cf.conversations(turns)))
    found = {r["conv_id"]: (r["n_shared"], r["prompt"], r["chosen"], r["chosen_mask"], r["rejected"], r["rejected_mask"]) for r in out.collect()}
    assert found == {
        1: expected([(U, "hi"), (A, "one two three four")], [(U, "hi"), (A, "one two")]),
        2: expected([(U, "alone")], [(U, "alone")]),
        3: expected([("", ""), (A, "w")], [("", ""), (A, "")]),
        None: expected([(U, "q"), (A, "x y")], [(U, "q"), (A, "x")]),
        4: expected([(U, "a"), (U, "a"), (A, "m n"), (U, "end")], [(U, "a"), (U, "a"), (A, "m"), (U, "end")]),
    }


@pytest.mark.parametrize("schema", ["conv_id long, turn long, role string, text string"])
def test_empty_table(spark, schema):
    empty = spark.createDataFrame([], schema)
    assert cf.format_preferences(cf.with_cut_answer(cf.conversations(empty))).collect() == []
