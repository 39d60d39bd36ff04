from __future__ import annotations

import random
import re

import corpus_pipeline
from opticlake.llm.pii import base_spans
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) in (4, 5)
    stage = dict(corpus_pipeline.STAGES)

    known = stage["language_id"](spark, docs, SF)
    assert known.columns == docs.columns
    lettered = [r["doc_id"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")]
    assert set(ids(known)) <= set(lettered) and len(ids(known)) >= 0.97 * len(lettered)

    single = stage["near_duplicates"](spark, known, SF)
    component = brute.components([(r["doc_id"], r["text"]) for r in known.collect()])
    assert single.columns == docs.columns and ids(single) == sorted({c for c in component.values()})

    clean = stage["decontamination"](spark, single, SF)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = [r["doc_id"] for r in single.collect() if any(t in (r["text"] or "") for t in items)]
    assert clean.columns == docs.columns and not set(leaked) & set(ids(clean))
    assert len(ids(clean)) >= len(ids(single)) - 3 * len(leaked) - 2

    private = stage["personal_data"](spark, clean, SF)
    rows = private.collect()
    assert private.columns == docs.columns and ids(private) == ids(clean)
    assert not any(any(base_spans(r["text"] or "").values()) for r in rows)
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert all(r["text"] == before[r["doc_id"]] for r in rows if not any(base_spans(before[r["doc_id"]] or "").values()) and "[" not in (r["text"] or ""))

    mixed = stage["mixing"](spark, private, SF).collect()
    assert mixed and {r["doc_id"] for r in mixed} <= set(ids(private))
    total = sum(len(brute.words(r["text"])) for r in rows)
    assert 0.7 * (total // 2) < sum(r["n_tokens"] for r in mixed) <= total // 2


def test_run_and_empty_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 0
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "src1", 0), (2, "", None, None, 0), (3, "The cat sat.", "en", None, 12)], empty.schema)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and {3} <= {r["doc_id"] for r in out.collect()}, name


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, score string, Lang_pred string, ambiguous int, more int, place int, text_hash long, domain string, epoch int"


def test_clashing_names_nulls_copies_and_long_texts(spark):
    """Columns named like those that the stages add stay as they are; odd rows go or stay as stated."""
    rng = random.Random(5)
    prose = ["the cat and the dog went to the market because they had nothing left to eat at home that day",
             "der Hund und die Katze gingen zum Markt weil sie an diesem Tag nichts mehr zu essen im Haus hatten"]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").first()["text"]
    texts = [f"{prose[i % 2]} {' '.join(brute.random_words(rng, 30))}" for i in range(40)]
    rows = [(i, t, "en" if i % 2 == 0 else "de", f"src{i % 3}") for i, t in enumerate(texts)]
    rows += [rows[3]] * 3 + [(None, texts[5], "de", None), (None, f"{texts[6]} {item} {texts[8]}", "en", "src1"), (50, f"{item}", "en", "src1"),
                             (51, None, None, None), (52, "", "en", "src0"), (53, prose[0] + " word" * 60_000, "en", "src2"), (54, texts[7], "de", "src1")]
    docs = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), f"s{n}", "x", n, n, n, n, "dom", 3) for n, r in enumerate(rows)], CLASHING)
    stage = dict(corpus_pipeline.STAGES)
    known = stage["language_id"](spark, docs, SF)
    kept = known.collect()
    assert known.columns == docs.columns and {r["score"] for r in kept} <= {f"s{n}" for n in range(len(rows))}
    assert {51, 52} & {r["doc_id"] for r in kept} == set() and sum(r["doc_id"] is None for r in kept) == 2
    single = stage["near_duplicates"](spark, docs, SF)
    left = single.collect()
    assert single.columns == docs.columns and sorted(r["doc_id"] for r in left if r["doc_id"] is not None) == sorted({*range(40), 50, 51, 52, 53})
    assert sum(r["doc_id"] is None for r in left) == 2
    clean = stage["decontamination"](spark, docs, SF)
    found = clean.collect()
    assert clean.columns == docs.columns and not any(item in (r["text"] or "") for r in found)
    assert len(found) == len(rows) - 2 and sum(r["doc_id"] is None for r in found) == 1
    private = stage["personal_data"](spark, docs, SF)
    assert private.columns == docs.columns and private.count() == len(rows)
    assert stage["personal_data"](spark, docs.drop("n_chars"), SF).columns == docs.drop("n_chars").columns
    mixed = stage["mixing"](spark, docs, SF)
    assert len(set(mixed.columns)) == len(mixed.columns) and {"doc_id", "text", "epoch", "n_tokens", "score"} <= set(mixed.columns)
    assert {r["text"] for r in mixed.collect()} <= {r[1] for r in rows}
