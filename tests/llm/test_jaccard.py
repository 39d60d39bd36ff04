from __future__ import annotations

import random

import numpy as np
import pytest

from opticlake.llm import jaccard
from opticlake.llm.components import connected_components
from tests.llm import brute

SCHEMA = "doc_id long, text string, n_shingles string"


def run(spark, docs):
    rows = jaccard.similar_components(spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)).collect()
    assert len(rows) == len(docs)
    return {r["doc_id"]: r["component_id"] for r in rows}, rows


def family(rng, n, copies, edits):
    """Copies of one text with some words replaced in each."""
    base = brute.random_words(rng, n)
    out = []
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(n)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = [*family(rng, 120, 90, 4), *family(rng, 12, 80, 1), *family(rng, 300, 6, 12), *family(rng, 40, 5, 2)]
    shared = " ".join(brute.random_words(rng, 30))
    texts += [f"{' '.join(brute.random_words(rng, rng.randrange(4, 40), 10**6))} {shared}" for _ in range(120)]
    texts += [" ".join(brute.random_words(rng, rng.randrange(1, 200), 10**6)) for _ in range(30)]
    texts += ["", None, " \t\n", "one", "ONE", "one two", "one two three four", "One  two\nthree four", "a b c d e", "A b c d e", "é b c d e"]
    texts += texts[:40]
    rng.shuffle(texts)
    docs = list(enumerate(texts, 100))
    found, rows = run(spark, docs)
    assert found == brute.components(docs)
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(brute.shingles(t)) for i, t in docs}


def test_groups_cut_and_compared_again(spark, monkeypatch):
    """Small limits force every path: parts of groups, rounds of stars, all members."""
    for name, value in {"SMALL": 2, "CHUNK": 10, "SEND_IDS": 3}.items():
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(4)
    texts = [t for _ in range(6) for t in family(rng, 60, 12, 5)]
    for _ in range(3):  # a chain: each member is like the next, not like the one after that
        own = brute.random_words(rng, 100)
        for _ in range(8):
            texts.append(" ".join(own))
            own = own[10:] + brute.random_words(rng, 10, 10**6)
    docs = list(enumerate(texts))
    assert run(spark, docs)[0] == brute.components(docs)


def test_prefixes_share_a_signature():
    """Linked sets share a signature, whatever tokens are frequent."""
    rng = np.random.default_rng(3)
    buckets = np.sort(rng.choice(1 << 20, 1 << 19, replace=False))
    counts = rng.integers(64, 10**6, len(buckets))
    frequent = jaccard.Frequent(buckets, counts, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for n in [*range(1, 40), 63, 64, 65, 100, 127, 128, 500]:
        for _ in range(6):
            tokens = np.unique(rng.integers(0, 2**64, 2 * n, dtype=np.uint64))
            both = tokens[: n - n * int(rng.integers(0, 25)) // 100]
            other = np.unique(np.concatenate([both, tokens[n : n + int(rng.integers(0, max(1, n // 8)))]]))
            mine = tokens[:n]
            if 100 * len(both) < 75 * (len(mine) + len(other) - len(both)):
                continue
            left, right = (jaccard.prefix_signatures(np.sort(x), frequent) for x in (mine, other))
            caps = {s: c for s, c in zip(left[0].tolist(), left[1].tolist(), strict=True)}
            fits = [s for s, c in zip(right[0].tolist(), right[1].tolist(), strict=True)
                    if s in caps and 175 * min(c, caps[s]) >= 75 * (len(mine) + len(other))]
            assert fits


def test_odd_rows(spark):
    text = "a b c d e f g h"
    docs = [(5, text), (5, "p q r s t u"), (3, "p q r s t u"), (9, text), (None, text), (7, None)]
    rows = jaccard.similar_components(spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in rows) == [
        (-1, 4, None), (3, 2, 3), (5, 2, 3), (5, 4, 3), (7, 0, 7), (9, 4, 3)]
    assert jaccard.similar_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_path_is_one_component(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7)]
    found = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_bound_from_least_hashes():
    rng = np.random.default_rng(5)
    for _ in range(300):
        pool = np.unique(rng.integers(0, 2**64, 60, dtype=np.uint64))
        x, y = (np.sort(rng.choice(pool, int(rng.integers(1, 50)), replace=False)) for _ in range(2))
        low, high = ((v[: int(rng.integers(1, len(v) + 1))] >> np.uint64(32)).astype(np.uint32) for v in (x, y))
        assert jaccard._most_shared(len(x), low, len(y), high) >= len(np.intersect1d(x, y))


def test_documents_of_a_family_meet_once(spark):
    """Sixty documents under fifty common tokens each are compared as one group; groups that share only their first member are not."""
    rows = [(sig, 60, 0, doc, (100 << 32) + sig, doc) for sig in range(1, 51) for doc in range(60)]
    rows += [(sig, 2, 1000, doc, (100 << 32) + 90, doc) for sig in range(100, 110) for doc in (1000, 1000 + sig)]
    found = jaccard._families(spark.createDataFrame(rows, "sig long, _n long, first long, doc long, meta long, label long"))
    family = found.where("first = 0").collect()
    assert sorted((r["doc"], r["sig"], r["_n"], r["n"], r["meta"]) for r in family) == [(d, 0, 60, 100, (100 << 32) + 50) for d in range(60)]
    assert sorted((r["sig"], r["doc"]) for r in found.where("first = 1000").collect()) == sorted(
        (sig, doc) for sig in range(100, 110) for doc in (1000, 1000 + sig))


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(6)
    for n in (1, 30, 31, 64, 500, 20_000, 40_000):
        tokens = np.unique(rng.integers(0, 2**64, 2 * n, dtype=np.uint64))
        x, y = tokens[: n], np.concatenate([tokens[n // 8 : n], tokens[n : n + n // 9]])
        left, right = (jaccard.bitmap(v) for v in (x, y))
        if len(left) != len(right):  # the wider one is folded
            left, right = (v if len(v) == min(len(left), len(right)) else v[: len(v) // 2] | v[len(v) // 2 :] for v in (left, right))
        differ = len(np.setxor1d(x, y))
        assert (differ == 0 or differ // 4 <= jaccard._far(left[None], right[None])[0, 0]) and jaccard._far(left[None], right[None])[0, 0] <= differ


@pytest.mark.parametrize("big", [5_000, 12])
def test_pairs_within_families_equal_brute_force(spark, monkeypatch, big):
    """Near-threshold texts of many sizes, in one task or dealt into blocks: every similar pair of different components is given."""
    monkeypatch.setattr(jaccard, "BIG", big)
    monkeypatch.setattr(jaccard, "PAIR_ROWS", 8)
    rng, rows, sets = random.Random(8), [], {}
    for base in (40, 300):
        words = [rng.randrange(2**64) for _ in range(base)]
        for _ in range(40):
            own = set(words[rng.randrange(base // 4) :]) | {rng.randrange(2**64) for _ in range(rng.randrange(1 + base // 6))}
            sets[len(sets)] = np.array(sorted(own), np.uint64)
    for doc, tokens in sets.items():
        rows.append((0, 0, 80, doc, len(tokens), (len(tokens) << 32) + len(tokens), doc // 2, bytearray(jaccard.bitmap(tokens).tobytes())))
    frame = spark.createDataFrame(rows, "first long, sig long, _n long, doc long, n long, meta long, label long, bits binary")
    found = {(r["a"], r["b"]) for r in jaccard._pairs_within(frame, 75).collect()}

    def alike(x, y):
        shared = len(np.intersect1d(sets[x], sets[y]))
        return 100 * shared >= 75 * (len(sets[x]) + len(sets[y]) - shared)

    want = {(x, y) for x in sets for y in sets if x < y and x // 2 != y // 2 and alike(x, y)}
    assert want and want <= found and all(x // 2 != y // 2 and x < y for x, y in found)
