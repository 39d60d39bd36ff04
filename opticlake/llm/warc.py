"""WARC fixity audit: hash trees over records and offset ranges, compared between replicas.

A replica is a table of records: file, offset, length and digest (SHA-256 of the record's bytes). The records that
start in the same 64 KiB of a file are a leaf range; 16 ranges, in the order of their offsets, make the next one, up
to the file (64 GiB at most, larger offsets are refused). The files, in 4096 groups by the MD5 of their name, make the
replica's root. Trees are written once, one folder per level. An audit compares the roots and then, level by level,
only the children of nodes that differ; records are read only for the leaf ranges that differ at the end.

Edge cases: records that share file and offset (repeated rows) count as one place with several digests; NULL in file is
the file '', NULL in digest the digest ''; records without an offset are left out; equal replicas, or two empty ones,
give no rows; against an empty replica every record is missing; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opticlake.llm.catalog import query
from opticlake.session import materialize

RANGE, FAN_OUT, LEVELS = 64 * 1024, 16, 6  # 16 ** 5 leaf ranges of a file at most
_END = "\r\n\r\n"


def record_text(url: Column, ident: Column, payload: Column) -> Column:
    """A response record without the two line ends after it."""
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(ident.cast("string"), F.lit("")),
        F.lit(">\r\nContent-Length: "), F.octet_length(F.coalesce(payload, F.lit(""))).cast("string"), F.lit(_END),
        F.coalesce(payload, F.lit("")),
    )


def place_records(rows: DataFrame, file: str, order: list[str], length: str) -> DataFrame:
    """Rows with `offset`: where each record starts in its file. A file, of a bounded number of records, is one group."""
    within = Window.partitionBy(file).orderBy(*order)
    return rows.withColumn("offset", F.sum(length).over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col(length))


def write_warc(records: DataFrame, folder: str) -> None:
    """Write records (file, offset, record) as WARC files, one per value of `file`, in the order of their offsets."""
    (records.repartition("file").sortWithinPartitions("file", "offset").select("file", F.col("record").alias("value"))
     .write.partitionBy("file").option("lineSep", _END).text(folder))


def _records(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, record with its line ends); whatever does not parse is one last record."""
    at, size = 0, len(content)
    while at < size:
        head = content.find(_END.encode(), at)
        length = None
        if content.startswith(b"WARC/", at) and head >= 0:
            for line in content[at:head].split(b"\r\n"):
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length" and value.strip().isdigit():
                    length = int(value)
        end = size if length is None else min(size, head + 4 + length + 4)
        yield at, content[at:end]
        at = end


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the WARC files that write_warc wrote: file, offset, length, digest. A file is read by one task."""
    import hashlib

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                name = path.rsplit("/file=", 1)[-1].split("/", 1)[0]
                yield pd.DataFrame(
                    [(name, at, len(r), hashlib.sha256(r).hexdigest()) for at, r in _records(bytes(content))],
                    columns=["file", "offset", "length", "digest"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInPandas(parse, "file string, offset long, length long, digest string")


def _joined(key: str, columns: str) -> Column:
    """Hash of the sorted children of a node."""
    return F.sha2(F.array_join(F.sort_array(F.collect_list(F.struct(key, F.expr(columns).alias("_t"))))["_t"], ","), 256)


def _clean(records: DataFrame) -> DataFrame:
    return records.select(
        F.coalesce("file", F.lit("")).alias("file"), F.col("offset").cast("long").alias("offset"),
        F.coalesce(F.col("length").cast("long"), F.lit(0)).alias("length"), F.coalesce("digest", F.lit("")).alias("digest"),
    ).where("offset IS NOT NULL").withColumn(
        "id", F.when(F.col("offset") < RANGE * FAN_OUT ** (LEVELS - 1), F.expr(f"offset div {RANGE}"))
        .otherwise(F.raise_error(F.lit("a record starts beyond 64 GiB"))))


def build_tree(records: DataFrame, label: str) -> tuple[DataFrame, list[DataFrame]]:
    """(records with their leaf range, nodes of each level from the leaves to the root): file, id, digest."""
    held = materialize(_clean(records), f"{label}-records")
    nodes = held.groupBy("file", "id").agg(_joined("offset", "concat_ws(':', offset, length, digest)").alias("digest"))
    levels = [materialize(nodes, f"{label}-0")]
    for level in range(1, LEVELS):
        up = levels[-1].select("file", F.col("id").alias("child"), "digest").withColumn("id", F.expr(f"child div {FAN_OUT}"))
        levels.append(materialize(up.groupBy("file", "id").agg(_joined("child", "concat_ws(':', child, digest)").alias("digest")), f"{label}-{level}"))
    grouped = levels[-1].withColumn("id", F.conv(F.substring(F.md5("file"), 1, 3), 16, 10).cast("long"))
    groups = grouped.groupBy("id").agg(_joined("file", "concat_ws(':', file, digest)").alias("digest")).select(F.lit("").alias("file"), "id", "digest")
    levels.append(materialize(groups, f"{label}-groups"))
    root = levels[-1].agg(_joined("id", "concat_ws(':', id, digest)").alias("digest")).select(F.lit("").alias("file"), F.lit(0).cast("long").alias("id"), "digest")
    levels.append(materialize(root.coalesce(1), f"{label}-root"))
    return held, levels


def _differ(left: DataFrame, right: DataFrame) -> DataFrame:
    a, b = left.withColumnRenamed("digest", "_a"), right.withColumnRenamed("digest", "_b")
    return a.join(b, ["file", "id"], "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).select("file", "id")


def audit(good: DataFrame, other: DataFrame) -> DataFrame:
    """Records that differ between two replicas: file, offset, length, kind (changed, missing, extra), digest, found."""
    (left, left_levels), (right, right_levels) = build_tree(good, "warc-good"), build_tree(other, "warc-other")
    above = _differ(left_levels[-1], right_levels[-1])
    if not above.isEmpty():  # the root's children are all groups
        above = _differ(left_levels[-2], right_levels[-2])
    group = F.conv(F.substring(F.md5("file"), 1, 3), 16, 10).cast("long")
    under = [level.withColumn("_up", group).join(above.select(F.col("id").alias("_up")), "_up", "left_semi").drop("_up")
             for level in (left_levels[-3], right_levels[-3])]
    bad = materialize(_differ(*under), "warc-differ")
    for level in range(LEVELS - 2, -1, -1):
        up = bad.select("file", F.col("id").alias("_up"))
        under = [side[level].withColumn("_up", F.expr(f"id div {FAN_OUT}")).join(up, ["file", "_up"], "left_semi").drop("_up")
                 for side in (left_levels, right_levels)]
        bad = materialize(_differ(*under), "warc-differ")
    sides = []
    for held, name in ((left, "digest"), (right, "found")):
        rows = held.join(bad, ["file", "id"], "left_semi")
        sides.append(rows.groupBy("file", "offset").agg(
            F.max("length").alias(f"_{name}"), F.array_join(F.sort_array(F.collect_list("digest")), ",").alias(name)))
    both = sides[0].join(sides[1], ["file", "offset"], "full").where("NOT digest <=> found")
    kind = F.when(F.col("found").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("changed")
    return both.select("file", "offset", F.coalesce("_digest", "_found").alias("length"), kind.alias("kind"), "digest", "found")


def page_records(pages: DataFrame, damaged: bool) -> DataFrame:
    """Pages as records of one replica, 1000 page numbers to a file; a damaged replica has changed and lost records."""
    text = record_text(F.col("url"), F.col("page_id"), F.col("html"))
    stored = F.concat(text, F.lit(_END))
    if damaged:
        stored = F.when(F.col("page_id") % 97 == 5, F.concat(F.lit("#"), F.substring(stored, 2, 2**31 - 1))).otherwise(stored)
    rows = pages.select(
        "page_id", F.coalesce(F.expr("page_id div 1000"), F.lit(-1)).cast("string").alias("file"),
        F.octet_length(stored).cast("long").alias("length"), F.sha2(stored, 256).alias("digest"))
    placed = place_records(rows, "file", ["page_id", "length", "digest"], "length")
    return placed.where("NOT coalesce(page_id % 149 = 7, false)") if damaged else placed


SQL = r"""
WITH stored AS (
  SELECT page_id, coalesce(CAST(page_id // 1000 AS VARCHAR), '-1') AS file,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
    || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM pages
), placed AS (
  SELECT *, strlen(record) AS length, CAST(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id) AS BIGINT) - strlen(record) AS "offset" FROM stored
)
SELECT file, "offset", length, CASE WHEN page_id % 149 = 7 THEN 'missing' ELSE 'changed' END AS kind, sha256(record) AS digest,
  CASE WHEN page_id % 149 <> 7 THEN sha256('#' || substr(record, 2)) END AS found
FROM placed WHERE page_id % 149 = 7 OR page_id % 97 = 5
"""


@query("op6_warc_audit", SQL)
def op6_warc_audit(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    return audit(page_records(pages, False), page_records(pages, True))
