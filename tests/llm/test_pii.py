from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from opticlake.llm import pii
from opticlake.llm.catalog import QUERIES, load_all
from opticlake.llm.pii import base_spans, candidates

load_all()

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = {}
    for kind, rule in RULES.items():
        own = []
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and total % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]
            own += [m.span()] if good else []
        out[kind] = own
    return out


TEXTS = [
    "a@b.c", "x@y", "a@@b.c.d", "a@b.c@d.e", "a.b+c%d@e-f.g-h.i.", "@b.c", "é@b.c", "a@b..c", "a@.b", "a@b.c@", "mail a@b.co, c@d.co;e@f.co",
    "1.2.3.4.5.6.7.8", "256.1.1.1", "1.2.3.4", "001.002.003.0255", "1.2.3.4.5", "a1.2.3.4b", "٣.1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111x",
    "4111  1111 1111 1111", "41111111111111111111111111", "+1 (988) 555-2485", "+1((((((", "+12", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "++1 2345678", "+1234567+12345678",
    "", None, "no data at all", "+49 30 123456. 4111111111111111 10.0.0.1 me@here.org", "5" * 16, "0" * 16,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert pii.base_spans(text or "") == plain(text)


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    for alphabet in ("a@.-", "12.5@ ", "0123456789 -", "+1(). -9", "a1@.+ -(é"):
        for _ in range(1500):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    start = time.time()
    scorer = pii.Scorer([(1.0, 1.0)], thresholds=dict.fromkeys(pii.KINDS, 0.5))
    for run in ("a" * 10**6, "a@" * 10**5, "1" * 10**6, "1." * 10**5, "+1" * 10**5, "+1((" * 10**5, "a1 " * 10**5 + "@"):
        scorer.spans(run)
    assert time.time() - start < 60


SCHEMA = "doc_id long, text string, spans string, n_email string"


def corpus(n=400):
    rng = random.Random(5)

    def card():
        head = [rng.randrange(10) for _ in range(15)]
        return next("".join(map(str, head)) + str(d) for d in range(10) if pii.luhn("".join(map(str, head)) + str(d)))

    def said():
        return rng.choice([
            f"m{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", card(),
            f"{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}", str(rng.randrange(10**12, 10**15)), f"v{rng.randrange(9)}.{rng.randrange(99)}",
            f"{rng.randrange(300, 999)}.1.1.1", "name at host", f"order {rng.randrange(10**8)}", "word"])

    return [(i, " ".join(f"text {said()} more" for _ in range(6))) for i in range(n)]


def test_added_spans_keep_base_spans(spark):
    docs = corpus() + [(1000, None), (1001, ""), (1002, "x " * 10**5 + "a@b.co"), (None, "a@b.co"), (1003, "a@b.co"), (1003, "a@b.co")]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA)
    scorer = pii.train(frame)
    assert scorer.trees
    rows = pii.find_pii(frame, scorer).collect()
    assert len(rows) == len(docs)
    texts = {}
    for i, t in docs:
        texts.setdefault(i, t)
    for r in rows:
        base = plain(texts[r["doc_id"]])
        said = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in base[k]]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS]
        every = r["spans"].split(",") if r["spans"] else []
        assert set(said) <= set(every) and len(every) == len(said) + r["n_added"]
        keyed = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in every]
        assert keyed == sorted(keyed)


def test_redaction(spark):
    frame = spark.createDataFrame([(1, "call +1 (988) 555-2485 or a@b.co now", "s", "e"), (2, None, "s", "e"), (3, "4111 1111 1111 1111", "s", "e"), (4, "x a@1.2.3.4 y", "s", "e")], SCHEMA)
    found = {r["doc_id"]: r for r in pii.redact(frame, pii.Scorer()).collect()}
    assert [found[i]["text"] for i in (1, 2, 3)] == ["call [PHONE] or [EMAIL] now", None, "[CARD]"]
    assert found[4]["text"] == "x [EMAIL] y" and found[1]["spans"] == "s"
    assert pii.redact(frame.limit(0), pii.Scorer()).count() == 0


def test_too_little_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "a@b.co", "s", "e")], SCHEMA)
    assert pii.train(frame).trees == [] and pii.train(frame.limit(0)).trees == []


def test_trees_agree_with_spark(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors

    rng = random.Random(1)
    rows = [([rng.random(), rng.random(), float(rng.random() < 0.5)],) for _ in range(200)]
    data = spark.createDataFrame([(Vectors.dense(x), float(x[0] > 0.5 and x[2] > 0 or x[1] > 0.9)) for (x,) in rows], ["v", "label"])
    model = GBTClassifier(featuresCol="v", labelCol="label", maxIter=4, maxDepth=3, seed=1).fit(data)
    scorer = pii.Scorer(pii._trees(model))
    for r in model.transform(data).collect():
        assert scorer.margin(list(r["v"])) == pytest.approx(r["rawPrediction"][1])


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_pii"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(v) for v in plain(texts[r["doc_id"]]).values()]


def test_forms_that_no_rule_matches_are_redacted(spark):
    personal = [
        ("write to jane.doe at example dot org today", "jane.doe at example dot org"), ("reach bob7 (at) example.org there", "bob7 (at) example.org"),
        ("or ann[at]example[dot]org instead", "ann[at]example[dot]org"), ("call 743 555 3824 now", "743 555 3824"), ("text 743-555-3824 more", "743-555-3824"),
        ("ring (743) 555-3824 more", "(743) 555-3824"), ("text 1 (743) 555-3824 more", "1 (743) 555-3824"), ("pay 3782 822463 10005 at once", "3782 822463 10005"),
        ("with 4111.1111.1111.1111 then", "4111.1111.1111.1111")]
    other = ["order 73482910 came", "look at example.com for it", "on 2024-11-05 we met", "with 4111.1111.1111.1112 then", "pay 3782 822463 10006 at once", "between 1990 - 2004 it was", "about 12.50 - 13.75 each"]
    docs = corpus(800)
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA)
    scorer = pii.train(frame)
    planted = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate([t for t, _ in personal] + other)], SCHEMA)
    texts = {r["doc_id"]: r["text"] for r in pii.redact(planted, scorer).collect()}
    added = {r["doc_id"]: r["n_added"] for r in pii.find_pii(planted, scorer).collect()}
    for i, (text, said) in enumerate(personal):
        assert added[i] == 1 and said not in texts[i] and re.sub(r"\[[A-Z]+\]", said, texts[i]) == text, (text, texts[i])
    assert [texts[len(personal) + i] for i in range(len(other))] == other


@pytest.mark.parametrize("text, kind, said", [
    ("nos 1 2 3 4 4111 1111 1111 1111 end", "card", "4111 1111 1111 1111"),
    ("1 2 3 4 5 6 7 8 9 10 11 12 030 1234567 13 14 15 16 17", "phone", "030 1234567"),
    ("9" * 40 + " 10. 20. 30. 40 " + "8 " * 30, "ip", "10. 20. 30. 40"),
    ("write to " + "x" * 300 + " at " + "y" * 100 + " dot aa dot bb dot cc dot dd dot ee dot org now", "email",
     "x" * 300 + " at " + "y" * 100 + " dot aa dot bb dot cc dot dd dot ee dot org"),
    ("a (030) 555 12 34 b", "phone", "(030) 555 12 34"),
])
def test_candidates_have_no_place_limit(text, kind, said):
    found = {(k, text[a:b]) for k, (a, b) in candidates(text, base_spans(text))}
    assert (kind, said) in found


def test_many_numbers_take_time_in_proportion():
    text = " ".join(str(i % 97) for i in range(30_000))
    assert len(candidates(text, base_spans(text))) < 40 * 30_000
    assert candidates("7" * 200_000, {k: [] for k in pii.KINDS}) == []


def test_trees_and_thresholds_come_from_all_documents(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(pii, "materialize", lambda df, label: kept.append(df.localCheckpoint()) or kept[-1])
    frame = spark.createDataFrame([(i, f"mail a{i}@example.org now", "x", "y") for i in range(6000)], SCHEMA)
    pii.train(frame)
    rows = frame.select(F.xxhash64("doc_id").alias("h"), "text").collect()
    assert kept[0].agg(F.sum("n")).first()[0] == sum(len(pii.examples(r["h"], r["text"])) for r in rows)
    assert kept[0].count() < 6000
