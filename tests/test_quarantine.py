from __future__ import annotations

from opticlake import schemas as S
from opticlake.operators import extract as X
from opticlake.session import materialize


def test_texts_of_good_replies_are_not_written(spark, monkeypatch):
    written = []

    def watched(df, label):
        written.append(materialize(df, label))
        return written[-1]

    monkeypatch.setattr(X, "materialize", watched)
    good = "<rpc-reply><interface-information><physical-interface><name>a</name></physical-interface></interface-information></rpc-reply>"
    docs = spark.createDataFrame(
        [("d1", "r", 5, good), ("d1", "r", 6, good[:-12]), ("d2", "r", 7, " "), ("d2", "r", 8, None)],
        "device string, rpc string, run_timestamp long, xml string")
    parsed, rejects = X.quarantine_malformed(docs, S.OPTICS_LANE_REPLY, keep=["device", "run_timestamp"])
    assert [tuple(r) for r in parsed.collect()] == [("d1", 5)] and parsed.columns == ["device", "run_timestamp"]
    assert {tuple(r) for r in rejects.collect()} == {
        ("d1", "r", "malformed", good[:-12]), ("d2", "r", "empty", " "), ("d2", "r", "missing", None)}
    assert len(written) == 1 and not any(good in (v or "") for r in written[0].collect() for v in r if isinstance(v, str))
    whole, others = X.quarantine_malformed(docs, S.OPTICS_LANE_REPLY, keep=True)
    assert [r["xml"] for r in whole.collect()] == [good] and sorted(map(str, others.collect())) == sorted(map(str, rejects.collect()))
