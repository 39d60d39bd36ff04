from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opticlake.llm import langid
from opticlake.llm.catalog import QUERIES, load_all

load_all()
SCHEMA = "doc_id long, text string, lang string, score string, source string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", "y") for i, t, lang in rows], SCHEMA)


def test_held_out_accuracy(spark):
    """On documents that were not learned from; the mark of them is crc32 of the number as text."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    rows = QUERIES["op5_language_id"](spark, sf).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held) > 0


def test_learns_from_the_allowed_rows_only(spark):
    rows = [(i, f"aa bb cc {i}", "x") for i in range(60)] + [(100 + i, f"zz yy ww {i}", "y") for i in range(60)]
    other = [(i, t if zlib.crc32(str(i).encode()) % 4 != 2 else "changed text", lang) for i, t, lang in rows]
    models = [langid.train(frame(spark, r).where(~langid.held_out(F.col("doc_id")))) for r in (rows, other)]
    assert np.array_equal(models[0].weights, models[1].weights)


def test_odd_rows(spark):
    rows = [(i, w * 9, lang) for i, (w, lang) in enumerate([("the cat is ", "en"), ("der hund ist ", "de")] * 20)]
    odd = [(200, None, "en"), (201, "", "de"), (202, "123 ... !?", None), (203, "the " * 200_000, None), (204, "漢字", None), (None, "hund der", "fr"),
           (205, "the cat", None), (205, "the cat", None), (206, "DER HUND IST", None), (207, "é", None)]
    docs = frame(spark, rows + odd)
    found = langid.identify(docs, langid.train(docs)).collect()
    by = {(r["doc_id"], r["text"]): r for r in found}
    assert len(found) == len(rows) + len(odd) and found[0]["source"] == "y"
    assert [by[i, t]["lang_pred"] for i, t, _ in odd[:3]] == ["und"] * 3 and by[200, None]["score"] == 0 and by[200, None]["ambiguous"]
    assert by[203, odd[3][1]]["lang_pred"] == "en" and by[204, "漢字"]["lang_pred"] in ("de", "en")
    assert by[206, "DER HUND IST"]["lang_pred"] == "de" and by[207, "é"]["lang_pred"] != "und"
    assert langid.train(docs.limit(0)) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}
    one = langid.identify(docs, langid.train(frame(spark, rows[:1])))
    assert {r["lang_pred"] for r in one.collect()} == {"und", "en"}
    assert langid.identify(docs.limit(0), None).count() == 0


@pytest.mark.parametrize("n", [2, 3, 6, 7, 40, 300])
def test_codewords_are_apart(n):
    code = langid.codewords(n)
    assert len(code) == n and len({tuple(c) for c in code.tolist()}) == n
    if n > 3:
        assert min((code[i] != code[i + 1 :]).sum(1).min() for i in range(n - 1)) >= 3


def test_a_wrong_bit_is_corrected():
    model = langid.Model(["a", "b", "c", "d"], langid.codewords(4), np.zeros((langid.DIMS + 1, 7), np.float32), np.ones(7))
    for i, word in enumerate(model.code):
        for flip in range(7):
            margins = 3 * word.copy()
            margins[flip] *= -1
            model.weights[-1] = margins
            best, score = model.decode(np.zeros((1, langid.DIMS), np.float32))
            assert best[0] == i and score[0] > 0.5


def test_whole_text_counts():
    long = ("abc " * 3000).encode()
    text = np.frombuffer(long + b"zz", np.uint8)
    counts = langid.ngram_counts(text, np.array([0, len(long), len(text)]))
    alone = langid.ngram_counts(np.frombuffer(b"zz", np.uint8), np.array([0, 2]))
    assert np.allclose(counts[1], alone[0]) and not np.allclose(counts[0], alone[0])


def test_many_short_texts_are_counted_in_blocks(monkeypatch):
    """Blocks are bounded by rows as well as by bytes."""
    from opticlake.llm.words import text_blocks

    texts = pa.array(["ab", None, "c" * 50, ""] * 500)
    blocks = list(text_blocks(texts, most=1 << 20, most_rows=langid.BLOCK_ROWS))
    assert max(len(rows) - 1 for _, _, rows in blocks) <= langid.BLOCK_ROWS
    assert [at for at, _, _ in blocks] == list(range(0, 2000, langid.BLOCK_ROWS))
    assert b"".join(data.tobytes() for _, data, _ in blocks) == "".join(t or "" for t in texts.to_pylist()).encode()
