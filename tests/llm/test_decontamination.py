"""Leaks: exact, re-parameterised, partial; what must be left alone."""

from __future__ import annotations

import random
import time

import pytest

from tidemark.llm import decontamination

ITEM = (
    "A farmer named Alice walks 12 km to the market every morning and sells 30 eggs there. On the way home Alice "
    "meets Bob who gives 12 coins to her. How many eggs does Alice sell in 7 days?"
)
CHANGED = ITEM.replace("Alice", "Carol").replace("12", "9").replace("30", "1,250").replace("Bob", "Dave").replace("7 days", "3 weeks")
#: Alice becomes two different people.
MIXED = ITEM.replace("Alice", "Carol", 1).replace("12 km", "9 km")
FILL = " ".join(f"filler{k}" for k in range(40)) + ". "


@pytest.fixture()
def leaks(spark, make_docs):
    def run(texts, items):
        benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, coverage int")
        docs = make_docs(texts)
        return {(r["doc_id"], r["item_id"]): r for r in decontamination.find_leaks(docs, benchmark).collect()}

    return run


def test_exact_and_changed_copies(leaks):
    texts = [(1, FILL + ITEM + " " + FILL), (2, FILL + CHANGED), (3, FILL), (4, ITEM.lower()), (5, " \n".join(ITEM.split(" "))), (6, ITEM.replace(",", "").replace(".", " ."))]
    found = leaks(texts, [(10, ITEM), (11, "Something else is asked here about the colour of seven large boats in port.")])
    assert {k[0] for k in found if k[1] == 10} == {1, 2, 4, 5, 6} and all(k[1] == 10 for k in found)
    assert not found[1, 10]["changed"] and found[1, 10]["coverage"] == 1.0
    assert found[2, 10]["changed"]


def test_inconsistent_slots_are_no_leak(leaks):
    plain = "and then the boy from the hill gave"
    item = f"Here Alice saw that {plain} Alice the old red book of the town while Alice sang"
    same = item.replace("Alice", "Carol")
    mixed = item.replace("Alice", "Carol", 1).replace("Alice", "Erin", 1).replace("Alice", "Mona", 1)
    found = leaks([(1, same), (2, mixed)], [(1, item)])
    assert (1, 1) in found and (2, 1) not in found


def test_literal_windows_count_beside_inconsistent_slots(leaks):
    last = "Carol".join(ITEM.rsplit("Alice", 1))
    found = leaks([(1, MIXED), (2, FILL + last + " " + FILL), (3, ITEM)], [(10, ITEM)])
    assert set(found) == {(1, 10), (2, 10), (3, 10)}
    assert found[2, 10]["matched_windows"] == 27 and found[2, 10]["item_windows"] == 32
    assert found[1, 10]["changed"] and found[2, 10]["changed"] and not found[3, 10]["changed"]


def test_items_dense_in_numbers(leaks):
    short = ("Compute 12 plus 30 minus 7 times 4", "Compute 15 plus 42 minus 9 times 6")
    middle = ("Compute 12 plus 30 minus 7 times 4 plus 8 minus 5", "Compute 15 plus 42 minus 9 times 6 plus 3 minus 2")
    sums = ("Add 1 2 3 4 5 6 7 8 9 10 then halve it", "Add 11 12 13 14 15 16 17 18 19 20 then halve it")
    tail = ("Please sort the given list now 5 4 3 2 1 9 8 7 6 10 11 12", "Please sort the given list now 35 34 33 32 31 39 38 37 36 40 41 42")
    few = ("Sum 5 4 3 2 with 1 9 8 7 and 16", "Sum 45 44 43 42 with 41 49 48 47 and 56")
    tiny = ("What is 12 times 30", "What is 25 times 70")
    pairs = [short, middle, sums, tail, few, tiny]
    texts = [(i, f"{FILL}{b}. {FILL}") for i, (_, b) in enumerate(pairs)]
    found = leaks(texts + [(20, FILL + "Add " + " ".join(str(k) for k in range(51, 80)))], [(i, a) for i, (a, _) in enumerate(pairs)])
    # the first item's template is also the beginning of the second text
    assert set(found) == {(i, i) for i in range(len(pairs))} | {(1, 0)}
    assert all(r["coverage"] == 1.0 and r["changed"] for r in found.values())


@pytest.mark.parametrize("old, new", [("Šárka", "Łucja"), ("Мария", "Елена"), ("Ελένη", "Σοφία"), ("Õnne", "Şebnem")])
def test_names_of_any_script(leaks, old, new):
    item = ITEM.replace("Alice", old)
    found = leaks([(1, FILL + item.replace(old, new)), (2, item.upper()), (3, item.replace(old, new.lower(), 1)), (4, FILL)], [(10, item)])
    assert {(1, 10), (2, 10)} <= set(found) and (4, 10) not in found
    assert found[1, 10]["changed"] and found[1, 10]["coverage"] == 1.0 and not found[2, 10]["changed"]


def test_lower_case_and_capitals_are_those_of_unicode():
    rng = random.Random(3)
    alphabet = "aZäÖßşİŁжДΣςéÉ中あǅ𝐀𐐀"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 6))) for _ in range(400)]
    data, offsets = decontamination._texts(texts)
    words = decontamination.Words(data, offsets * 0, offsets[:-1], offsets[1:])
    hashes = decontamination.folded_hashes(words)
    same = {}
    for t, h in zip(texts, hashes.tolist()):
        same.setdefault(t.lower(), set()).add(h)
    assert all(len(s) == 1 for s in same.values()) and len(set.union(*same.values())) == len(same)
    assert decontamination._capitals(words).tolist() == [t[0].isupper() or t[0].istitle() for t in texts]


def test_long_items_of_numbers_in_a_long_text(leaks):
    """Whole items of many lengths; the time does not grow with the length of an item."""
    items = [(n, f"Please sort {' '.join(str(k) for k in range(n))} right now") for n in range(200, 260)]
    texts = [(n, f"Please sort {' '.join(str(3 * k) for k in range(n))} right now. {FILL * 50}") for n in (200, 259)]
    began = time.monotonic()
    found = leaks(texts, items)
    assert {(200, 200), (259, 259)} <= set(found) and time.monotonic() - began < 60


def test_partial_passages(leaks):
    words = ITEM.split()
    texts = [(1, FILL + " ".join(words[: len(words) * 3 // 4])), (2, FILL + " ".join(words[:10]) + " " + FILL)]
    assert set(leaks(texts, [(1, ITEM)])) == {(1, 1)}


def test_short_items_nulls_repeats_and_ties(leaks):
    texts = [(1, "x what is the capital of France today y"), (1, "x what is the capital of France today y"), (2, None), (3, ""), (None, ITEM), (4, "12 13 14 15 16 17 18 19 20 21 22 23")]
    items = [(1, "What is the capital of france"), (1, "What is the capital of france"), (2, None), (3, ""), (None, ITEM), (4, "1 2 3 4 5 6 7 8 9 10 11 12 13")]
    assert set(leaks(texts, items)) == {(1, 1)}


def test_empty_tables(leaks):
    assert leaks([], [(1, ITEM)]) == {} and leaks([(1, ITEM)], []) == {}


def test_random_texts_against_a_window_list(leaks):
    """Literal windows only: lower-case words without numbers, so a leak is a shared run of words."""
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "bcdfgklmnprst" for b in "aeiou"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(5, 40)))) for i in range(30)]
    texts = []
    for d in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(0, 60))
        if d % 2:
            held = items[rng.randrange(30)][1].split()
            a = rng.randrange(len(held))
            words[5:5] = held[a : a + rng.randrange(1, 40)]
        texts.append((d, " ".join(words)))
    want = set()
    for d, text in texts:
        words = text.split()
        for i, item in items:
            own = item.split()
            width = min(len(own), decontamination.WINDOW)
            held = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
            windows = [tuple(own[k : k + width]) for k in range(len(own) - width + 1)]
            if sum(w in held for w in windows) >= decontamination.MIN_COVERAGE * len(windows):
                want.add((d, i))
    assert set(leaks(texts, items)) == want and len(want) > 10


def test_every_planted_item_of_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    want = {(r["doc_id"], i) for r in docs.select("doc_id", "text").collect() for i, t in items if t in r["text"]}
    found = decontamination.find_leaks(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and want
