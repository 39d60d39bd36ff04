from __future__ import annotations

import os

from opticlake.llm import jaccard
from opticlake.session import materialize, passing, scratch


def held(spark):
    root = os.path.dirname(os.path.dirname(scratch(spark, "probe")))
    return {f for f in os.listdir(root) if not f.startswith("probe")}


def test_tables_written_within_go_but_for_kept_ones(spark):
    before = held(spark)
    with passing(spark, "outer"):
        with passing(spark, "kept", "outer"):
            materialize(spark.range(3), "gone")
            kept, outer = materialize(spark.range(3), "kept"), materialize(spark.range(4), "outer")
        assert {f.split("-")[0] for f in held(spark) - before} == {"kept", "outer"} and kept.count() == 3
    assert {f.split("-")[0] for f in held(spark) - before} == {"outer"} and outer.count() == 4


def test_near_duplicates_leave_only_their_ids(spark):
    before = held(spark)
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"{text} {i % 4}") for i in range(1, 40)] + [(90, "other"), (None, text)], "doc_id long, text string")
    kept = jaccard.first_of_each(docs)
    assert {f.rsplit("-", 1)[0] for f in held(spark) - before} == {"jaccard-firsts"}
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 90]
