from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from opticlake.llm import substring
from opticlake.llm.fm_index import FMIndex, RangeMinimum, WaveletTree
from tests.llm import brute

SCHEMA = "doc_id long, text string, n_words string"


def plain(docs):
    """(doc_id, n_words, n_removed, hash) with all windows in a dictionary."""
    least: dict[tuple[str, ...], int] = {}
    for i, text in docs:
        own = brute.words(text)
        for at in range(len(own) - 49) if i is not None else ():
            key = tuple(own[at : at + 50])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, text in docs:
        own = brute.words(text)
        gone = [False] * len(own)
        for at in range(len(own) - 49) if i is not None else ():
            if least[tuple(own[at : at + 50])] < i:
                gone[at : at + 50] = [True] * 50
        kept = [w for w, g in zip(own, gone, strict=True) if not g]
        out.append((i, len(own), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, docs):
    rows = substring.remove_repeats(spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows), key=str)


def texts(seed):
    rng = random.Random(seed)
    passages = [brute.random_words(rng, rng.choice([49, 50, 51, 60, 200]), 10**4) for _ in range(12)]
    out = []
    for _ in range(120):
        own = []
        for _ in range(rng.randrange(1, 5)):
            own += brute.random_words(rng, rng.randrange(0, 120), 10**4)
            some = rng.choice(passages)
            cut = rng.randrange(0, 8)
            own += some[cut:] if rng.random() < 0.5 else some[: len(some) - cut]
        out.append(" ".join(own))
    out += [out[3], out[3], out[7] + " tail", "  " + out[9].replace(" ", "\n", 3), "Is " * 300, "Is " * 40, "Is " * 49 + "Is", "was " * 120 + "Is " * 120]
    out += ["", None, " \t", "one", " ".join(passages[4]), " ".join(passages[4]).upper(), " ".join(brute.random_words(rng, 60))]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_all_windows(spark, seed):
    docs = [(3 * i, t) for i, t in enumerate(texts(seed))]
    assert run(spark, docs) == plain(docs)


def test_hot_anchors_and_small_shards(spark, monkeypatch):
    for name, value in {"HOT": 3, "SHARD_WORDS": 500, "SEND_IDS": 2}.items():
        monkeypatch.setattr(substring, name, value)
    docs = list(enumerate(texts(5)))
    assert run(spark, docs) == plain(docs)


def test_odd_rows(spark):
    rng = random.Random(9)
    a, b = (" ".join(brute.random_words(rng, 80)) for _ in range(2))
    docs = [(5, a), (5, a), (5, b), (5, a + " " + b), (None, a), (2, b + " x"), (9, a)]
    assert run(spark, docs) == plain(docs)
    assert run(spark, []) == []


def test_index_parts():
    rng = np.random.default_rng(2)
    seq = rng.integers(0, 37, 1000)
    tree = WaveletTree(seq, 37)
    symbols, places = rng.integers(0, 37, 200), rng.integers(0, 1001, 200)
    assert tree.rank(symbols, places).tolist() == [int((seq[:p] == s).sum()) for s, p in zip(symbols, places, strict=True)]
    low = rng.integers(0, 999, 300)
    high = np.minimum(1000, low + rng.integers(1, 400, 300))
    assert RangeMinimum(seq).least(low, high).tolist() == [int(seq[a:b].min()) for a, b in zip(low, high, strict=True)]
    text = np.concatenate([rng.integers(1, 4, 400), [0]])
    index = FMIndex(text, 9)
    for _ in range(100):
        size = int(rng.integers(1, 9))
        pattern = rng.integers(1, 4, size)
        low, high = np.array([0]), np.array([len(text)])
        for w in pattern[::-1]:
            low, high = index.extend(np.array([w]), low, high)
        assert int(high[0] - low[0]) == sum((text[i : i + size] == pattern).all() for i in range(len(text) - size + 1))


@pytest.mark.parametrize("hot", [3, 10**6])
def test_no_shard_holds_more_of_an_anchor_than_its_share(spark, monkeypatch, hot):
    rng = random.Random(4)
    passage = brute.random_words(rng, 70, 10**4)
    docs = [(i, " ".join(brute.random_words(rng, 60, 10**4) + passage[i % 3 :] + brute.random_words(rng, 60, 10**4))) for i in range(80)]
    docs += [(200, "Is " * 300), (201, "Is " * 90), (7, " ".join(passage))]
    monkeypatch.setattr(substring, "HOT", hot)
    monkeypatch.setattr(substring, "SHARD_WORDS", 600)
    dealt, own = [], substring._matches
    monkeypatch.setattr(substring, "_matches", lambda segments: dealt.append(segments) or own(segments))
    assert run(spark, docs) == plain(docs)
    assert dealt[0].groupBy("anchor").sum("length").where("`sum(length)` > 600").isEmpty()
