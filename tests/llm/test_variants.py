from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opticlake.llm import variants
from opticlake.llm.variants import near_long_words, near_words, spelling_variants, word_counts
from tests.llm.brute import LOWER

DOCS = "doc_id long, text string, word string, n int, level int"


def plain_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    return counts


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(counts, shortest=5, least=3):
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {w: min(near[w], key=lambda v: (-words[v], v), default=None) for w in words}
    form = {w: v if v is not None and words[v] >= 2 * words[w] else None for w, v in form.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def run(spark, counts, **more):
    frame = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, near string")
    found = spelling_variants(frame, **more).collect()
    assert len({r["word"] for r in found}) == len(found)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found}


def vocabulary(seed, words, letters, longest):
    """Words and their misspellings, few letters so that many are near."""
    rng = random.Random(seed)
    counts = Counter()
    for _ in range(words):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(3, longest)))
        counts[word] += rng.randint(1, 60)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word))
            counts[word[:at] + rng.choice(["", rng.choice(letters), word[at] + rng.choice(letters)]) + word[at + 1 :]] += rng.randint(1, 20)
    counts.pop("", None)
    return counts


@pytest.mark.parametrize("letters", ["ab", "abcdeéßÐ"])
def test_equal_to_all_pairs(spark, letters):
    counts = vocabulary(len(letters), 150, letters, 9)
    assert run(spark, counts) == plain(counts)


def test_edges_that_are_not_sent(spark, monkeypatch):
    monkeypatch.setattr(variants, "SEND_EDGES", 3)
    counts = vocabulary(7, 60, "abc", 6)
    assert run(spark, counts) == plain(counts)


@pytest.mark.parametrize("levels", [5, 7])
def test_words_of_more_letters_than_levels(spark, levels):
    counts = vocabulary(levels, 120, "abé", 10)
    assert run(spark, counts, levels=levels) == plain(counts)


def test_the_two_ways_agree(spark):
    words = spark.createDataFrame([(w,) for w in vocabulary(3, 100, "abc", 8)], "word string")
    short, long = ({tuple(r) for r in f(words, levels).collect()} for f, levels in ((near_words, 40), (near_long_words, 0)))
    assert short == long and short


def test_very_long_words(spark):
    one = "abécd" * 2_000
    counts = Counter({one: 9, one[:5_000] + one[5_001:]: 4, one[:-1] + "x": 3, "y" + one: 40, one + "zz": 5})
    assert run(spark, counts) == plain(counts)


def test_chains_of_forms_and_ties(spark):
    counts = Counter({"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "aaaac": 6, "aaaaz": 5, "zzzzz": 2, "zzzzy": 100})
    assert run(spark, counts) == plain(counts)
    assert run(spark, counts)["aaaaa"][:2] == ("aaaab", "bbbbb")


def test_counts(spark):
    rng = random.Random(1)
    words = ["Straße", "ÉTUDE", "naming", "a", "Ab", "Āx", "rhythm×s", "don't", "ÿ"]
    rows = [(i % 7 or None, " ".join(rng.choice(words) for _ in range(40))) for i in range(60)]
    rows += rows[:5] + [(1, None), (2, ""), (3, "12 34"), (4, "word " * 30_000)]
    found = word_counts(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)).collect()
    assert {r["word"]: r["n"] for r in found} == plain_counts(rows)


def test_words_of_documents(spark):
    rng = random.Random(2)
    pool = list(vocabulary(9, 40, "abcd", 8))
    rows = [(i, " ".join(rng.choice(pool) for _ in range(100))) for i in range(80)]
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)
    found = spelling_variants(word_counts(frame)).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found} == plain(plain_counts(rows))


def test_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert spelling_variants(word_counts(empty)).collect() == []
    assert run(spark, {"rare words": 1, "four": 9}) == {}


def test_edges(spark):
    words = spark.createDataFrame([("abc",), ("abd",), ("b",)], "word string")
    texts = variants.sides(words)
    assert {(r["side"], r["text"], r["start"]) for r in texts.collect()} == {
        (0, "abc", 1), (0, "abd", 1), (0, "b", 0), (1, "cba", 2), (1, "dba", 2), (1, "b", 1)}
    rows = {(r["level"], r["letter"]): (r["ends"], bin(r["next"]).count("1"), r["rest"]) for r in variants.trie_edges(texts.where("side = 0")).collect()}
    assert rows == {(level, ord(c)): v for (level, c), v in {
        (0, "a"): (False, 1, 4), (0, "b"): (True, 0, 1), (1, "b"): (False, 2, 2), (2, "c"): (True, 0, 1), (2, "d"): (True, 0, 1)}.items()}


def test_runs_end_with_their_text(spark):
    rows = [(1, "abcde"), (2, "fghij"), (3, "é"), (4, "É"), (5, " klmno "), (6, "pq"), (7, None), (8, "rs")]
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS).coalesce(1)
    assert {r["word"]: r["n"] for r in word_counts(frame).collect()} == plain_counts(rows)
