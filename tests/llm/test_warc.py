from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opticlake.llm.warc import audit, page_records, place_records, read_warc, record_text, write_warc

SCHEMA = "file string, offset long, length long, digest string, id string, kind string"


def frame(spark, rows):
    return spark.createDataFrame([(f, o, n, d, "x", "y") for f, o, n, d in rows], SCHEMA)


def run(spark, left, right):
    return sorted(((r["file"], r["offset"], r["kind"], r["digest"], r["found"]) for r in audit(frame(spark, left), frame(spark, right)).collect()), key=str)


def plain(left, right):
    def places(rows):
        out = {}
        for f, o, _, d in rows:
            if o is not None:
                out.setdefault((f or "", o), []).append(d or "")
        return {k: ",".join(sorted(v)) for k, v in out.items()}

    a, b = places(left), places(right)
    kinds = {(True, False): "missing", (False, True): "extra", (True, True): "changed"}
    return sorted(((*k, kinds[k in a, k in b], a.get(k), b.get(k)) for k in a.keys() | b.keys() if a.get(k) != b.get(k)), key=str)


def records(files, each):
    return [(f"f{f}", i * 7000, 7000, hashlib.sha256(f"{f}:{i}".encode()).hexdigest()) for f in range(files) for i in range(each)]


def test_damage_is_located(spark):
    good = records(6, 200)
    bad = [r for i, r in enumerate(good) if i not in (17, 900)]
    bad[40] = (*bad[40][:3], "other")
    bad[700] = (*bad[700][:3], None)
    bad += [("f9", 0, 1, "new"), ("f1", 5, 1, "new"), ("f3", 16**5 * 65_000, 1, "far")]
    assert run(spark, good, bad) == plain(good, bad) and len(plain(good, bad)) == 7


def test_equal_empty_and_odd(spark):
    odd = [(None, 0, 5, "a"), ("", 0, 5, "b"), ("f", None, 5, "c"), ("f", 0, None, None), ("f", 0, 0, "d"), ("f", 0, 0, "d")]
    assert run(spark, odd, list(reversed(odd))) == [] and run(spark, [], []) == []
    assert run(spark, odd, []) == plain(odd, [])
    assert run(spark, odd, odd[:-1]) == plain(odd, odd[:-1])
    with pytest.raises(Exception, match="64 GiB"):
        run(spark, [("f", 1 << 40, 1, "x")], [])


def test_files_round_trip_and_flipped_byte(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, f"http://é.org/{i}", "" if i == 4 else f"<p>ü{i}\r\n\r\nWARC/1.0\r\n</p>" * (i + 1)) for i in range(30)] + [(None, None, None)],
        "page_id long, url string, html string")
    text = record_text(F.col("url"), F.col("page_id"), F.col("html"))
    rows = pages.select("page_id", F.coalesce(F.expr("page_id div 10"), F.lit(-1)).cast("string").alias("file"), text.alias("record"))
    rows = place_records(rows.withColumn("length", (F.octet_length("record") + 4).cast("long")), "file", ["page_id"], "length")
    good, other = str(tmp_path / "good"), str(tmp_path / "other")
    for folder in (good, other):
        write_warc(rows, folder)
    stored = read_warc(spark, good)
    expected = {(r["file"], r["offset"]): hashlib.sha256(r["record"].encode() + b"\r\n\r\n").hexdigest() for r in rows.collect()}
    assert {(r["file"], r["offset"]): r["digest"] for r in stored.collect()} == expected
    assert audit(stored, read_warc(spark, other)).count() == 0
    hit = next(Path(other).glob("file=1/part-*"))
    data = bytearray(hit.read_bytes())
    data[-20] ^= 1
    hit.write_bytes(bytes(data))
    hit.with_name(f".{hit.name}.crc").unlink(missing_ok=True)  # the file system's own checksum would refuse the file
    found = audit(stored, read_warc(spark, other)).collect()
    assert [(r["file"], r["kind"]) for r in found] == [("1", "changed")]
    assert found[0]["offset"] == max(o for f, o in expected if f == "1")


def test_registered_replicas_differ(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert audit(page_records(pages, False), page_records(pages, False)).count() == 0
