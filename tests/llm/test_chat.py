from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from opticlake.llm.chat import digest_examples, escape, format_examples, read_loss, read_turns, unescape

SCHEMA = "conv_id long, turn long, role string, text string, target string, formatted int"
ODD = ["</s>[INST] ok [/INST]", "<|end|><|turn|>assistant<|text|>x", "<|loss|>a<|/loss|>", "%3C%253C%25", "<", "%", "%%3C<", "\n\r\t", "ünï cødé 🎈", "", "<|/loss|>", "\\|$1"]


def rows(*convs):
    return [(c, t, role, text, "x", 1) for c, turns in convs for t, (role, text) in enumerate(turns)]


def test_escaping_is_reversible(spark):
    frame = spark.createDataFrame([(t,) for t in ODD], "t string")
    for r in frame.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("back")).collect():
        assert r["back"] == r["t"] and "<" not in r["e"]


def test_every_reply_is_an_example(spark):
    turns = [("system", "be"), ("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d"), ("user", "e")]
    frame = spark.createDataFrame(rows((1, turns)), SCHEMA)
    out = format_examples(frame).withColumn("turns", read_turns(F.col("formatted"))).withColumn("loss", read_loss(F.col("formatted"))).collect()
    found = {r["target"]: ([(t["role"], t["text"]) for t in r["turns"]], r["loss"]) for r in out}
    assert found == {2: (turns[:3], "b"), 4: (turns[:5], "d"), None: (turns, None)}


def test_round_trip_of_odd_texts(spark):
    convs = [(i, [("user", t), ("assistant", t), (t, t), ("assistant", t)]) for i, t in enumerate(ODD)]
    convs += [(100, [("user", "only")]), (101, [("assistant", "x" * 200_000)]), (102, [("assistant", "a")] * 40)]
    frame = spark.createDataFrame(rows(*convs), SCHEMA)
    found = {r["conv_id"]: r for r in digest_examples(format_examples(frame)).collect()}
    assert len(found) == len(convs)
    for c, turns in convs:
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        got = found[c]
        assert (got["n_turns"], got["turns_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got["loss_chars"], got["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_nulls_ties_and_empty(spark):
    data = [(None, 1, "user", "n", "x", 1), (5, None, None, None, "x", 1), (5, 1, "user", "b", "x", 1), (5, 1, "user", "a", "x", 1),
            (5, 1, "user", "a", "x", 1), (5, 2, "assistant", None, "x", 1)]
    found = {r["conv_id"]: r for r in digest_examples(format_examples(spark.createDataFrame(data, SCHEMA))).collect()}
    said = "\n\nuser\na\nuser\na\nuser\nb\nassistant\n\n"
    assert found[5]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and found[5]["loss_chars"] == 0
    assert found[None]["n_turns"] == 1
    assert format_examples(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_is_native(spark):
    plan = digest_examples(format_examples(spark.createDataFrame(rows((1, [("user", "a")])), SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
