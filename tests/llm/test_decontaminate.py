from __future__ import annotations

import random

import pytest

from opticlake.llm import decontaminate
from opticlake.llm.catalog import QUERIES, load_all
from opticlake.llm.decontaminate import find_leaks
from tests.llm import brute

load_all()

QUESTION = ("A farmer named Alice picks 12 apples and Alice sells 5 of them to Bob for 3 euros each so how many apples "
            "and how much money does Alice have after 12 days")


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, pos int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    return {(r["doc_id"], r["item_id"]): (r["n_windows"], r["n_changed"]) for r in find_leaks(d, b, **more).collect()}


def test_other_numbers_names_and_units(spark):
    other = QUESTION.replace("Alice", "Zoë").replace("Bob", "Max").replace("12", "37.5").replace("euros", "dollars").replace("5 of", "9 of")
    docs = [(1, f"Some words before, then: {QUESTION} and more."), (2, other.upper()[:1] + other[1:]),
            (3, other.replace("Zoë", "Max")), (4, other.replace("37.5 days", "40 days")), (5, QUESTION.replace("picks", "eats").replace("sells", "gives")),
            (6, "nothing of the kind " * 20)]
    found = run(spark, docs, [(7, QUESTION)])
    assert found[1, 7][1] == 0 and found[2, 7][1] > 3
    assert (3, 7) not in found  # two names of the item became one
    assert (4, 7) not in found  # one number of the item became two
    assert (6, 7) not in found and {d for d, _ in found} <= {1, 2, 5}


def test_slots_alone_are_no_evidence(spark):
    items = [(1, "Alice 1 Bob 2 Carl 3 Dora 4 Emil 5 Fritz 6 Gerd 7 has"), (2, "one two three four"), (3, "red green blue cyan pink")]
    docs = [(1, "so Anna 9 Berta 8 Cleo 7 Dirk 6 Eva 5 Finn 4 Gabi 3 has"), (2, "one two three four"), (3, "we see Red, green (blue) cyan pink!")]
    assert set(run(spark, docs, items)) == {(3, 3)}


@pytest.mark.parametrize("block", [10**6, 7])
def test_planted_passages_are_found_and_clean_texts_left(spark, block):
    rng = random.Random(2)
    items = [(i, " ".join(brute.random_words(rng, rng.randrange(13, 60), 10**5)).replace("w", "q")) for i in range(20)]
    docs, planted = [], set()
    for i in range(60):
        own = [w.replace("w", "v") for w in brute.random_words(rng, 80, 10**5)]
        if i % 3 == 0:
            item = rng.choice(items)
            own[40:40] = item[1].split(" ")
            planted.add((i, item[0]))
        docs.append((i, " ".join(own)))
    # Words with a digit are numbers here: spell them.
    spell = str.maketrans("0123456789", "abcdefghij")
    found = run(spark, [(i, t.translate(spell)) for i, t in docs], [(i, t.translate(spell)) for i, t in items], block=block)
    assert set(found) == planted and all(changed == 0 for _, changed in found.values())


def test_odd_rows(spark):
    text = "these are words of an item that is long enough to be a window"
    docs = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "x " * 50_000 + text + " y" * 50_000), (5, "... !!! ???")]
    items = [(1, text), (1, text), (2, None), (3, ""), (None, text), (4, text)]
    assert set(run(spark, docs, items)) == {(3, 1), (3, 4), (4, 1), (4, 4)}
    assert run(spark, [], items) == {} and run(spark, docs, []) == {}


def test_registered_query_finds_all_copies(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    whole = {(d, i) for d, t in docs for i, said in items if said in t}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_decontaminate"](spark, sf).collect()}
    assert whole and whole <= found
    grams = {tuple(brute.words(t.lower())[k : k + 9]) for _, t in items for k in range(len(brute.words(t)) - 8)}
    texts = dict(docs)
    for d, _ in found:  # nothing is found in texts without nine words of an item in a row
        own = brute.words(texts[d].lower())
        assert any(tuple(own[k : k + 9]) in grams for k in range(len(own) - 8))


def test_windows_over_many_sizes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHORTEST", 5)
    items = [(n, " ".join(f"{chr(97 + n)}{chr(97 + k)}x" for k in range(n))) for n in range(5, 20)]
    docs = [(n, f"start {t} end") for n, t in items]
    assert set(run(spark, docs, items)) == {(n, n) for n, _ in items}


def test_exact_passages_in_any_case_and_line_breaks(spark):
    greek = "Ο Γιώργος και η Μαρία πήγαν μαζί στην αγορά για να πάρουν φρέσκα ψάρια και λίγες ελιές"
    german = "Der Bauer fährt am Morgen mit dem großen Wagen über die Straße zum Markt und verkauft dort Äpfel"
    items = [(1, QUESTION), (2, greek), (3, german)]
    forms = [str.upper, str.lower, str.title, lambda t: t.replace(" ", "\n"), lambda t: t.replace(" ", ".\n", 3)]
    docs = [(10 * i + n, f"As follows: {form(t)} and so on") for i, t in items for n, form in enumerate(forms)]
    found = run(spark, docs, items)
    assert set(found) == {(d, d // 10) for d, _ in docs} and all(changed == 0 for _, changed in found.values())


def test_a_contradiction_leaves_the_windows_that_are_the_same(spark):
    other = QUESTION.replace("12 days", "40 days")  # the other 12 stays
    found = run(spark, [(1, other), (2, other.replace("5 of", "9 of").replace("3 euros", "4 euros"))], [(7, QUESTION)])
    assert found == {(1, 7): (21, 1), (2, 7): (2, 0)}  # 12 to 12 and 40: in the second only windows that are the same


def test_copies_of_items_that_are_mostly_slots(spark):
    items = [(1, "12 30 45 7 19 22 81 64 5 90 33 41 17 58 and 60"), (2, "Anna Berta Carl Dora Emil Fritz Gerd Hans Ida Jan Karl Lena Max Nora"),
             (3, "Add 3 to 4 and 9"), (4, "The Great Book Of Many Old Tales And Songs For Young Children Of All Ages")]
    docs = [(i, f"see here: {t} there") for i, t in items] + [(9, "see here: 13 31 46 8 20 23 82 65 6 91 34 42 18 59 and 61 there")]
    assert run(spark, docs, items) == {(1, 1): (4, 0), (2, 2): (2, 0), (3, 3): (1, 0), (4, 4): (3, 0)}


def test_names_that_open_sentences(spark):
    question = ("Alice has 3 apples. Bob buys 5 pears. Alice eats 2 of them. Carl sells 4 plums to Bob. How many pieces of "
                "fruit do Alice and Bob have now?")
    item = "The baker has 3 loaves. Bob buys 2 of the loaves."
    other = question.replace("Alice", "Zoë").replace("Bob", "Max").replace("Carl", "Ida").replace("3", "7").replace("5", "11")
    sold = item.replace("Bob", "Max").replace("3", "8")
    docs = [(1, f"As follows. {other}"), (2, other.replace(" ", "\n")), (3, f"It is said that {other}"), (4, other.replace("Max", "Zoë")),
            (5, "Consider this case: " + sold), (6, f"we know that {sold.replace('The', 'the')}"), (7, f"we know that {sold}"),
            (8, item.replace("Bob", "Max").replace("The", "A").replace("2 of the", "4 of her"))]
    found = run(spark, docs, [(7, question), (8, item)])
    assert set(found) == {(1, 7), (2, 7), (3, 7), (5, 8), (6, 8), (7, 8)} and all(changed >= 2 for _, changed in found.values())
