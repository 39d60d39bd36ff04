"""URL filters: a memory-mapped array of sorted 64-bit keys, probed by binary search.

A rule is a host and the start of a path. It fits its host and all subdomains where the path of the URL starts with
the rule's; of several that fit, the longest (host and path together) wins, of equally long ones the first in byte
order, and where a rule is listed with both verdicts, block wins. The index holds the xxhash of each rule's text, sorted, beside the texts themselves: a key that
is found counts only if the stored text is the same, so colliding keys do no harm. The index is written in files of at
most `most` rules below spark.checkpoint.dir and mapped by the tasks; rules pass the driver one partition at a time.

Edge cases: a NULL URL or one without `://` has host and path ''; an empty rule list gives every URL the default;
rules with NULL host, path or verdict are left out; rows are judged one by one, so repeated rows and further columns
stay as they are (columns called host, path, rule or verdict are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticlake.llm.catalog import query
from opticlake.session import scratch

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VERDICTS = ["allow", "block"]


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path of a URL; both empty without `://`."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


@dataclass
class Block:
    """One index file: keys, ends of the texts, verdicts, then the texts."""

    path: str
    rules: int
    size: int
    shared: bool  # whether tasks can open the path themselves

    def load(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        file = self.path if self.shared else SparkFiles.get(self.path.rpartition("/")[2])
        n, held = self.rules, np.memmap(file, np.uint8, "r")
        return (held[: 8 * n].view(np.uint64), held[8 * n : 16 * n].view(np.int64), held[16 * n : 17 * n], held[17 * n :])


@dataclass
class Index:
    blocks: list[Block]
    depths: list[int]  # numbers of labels that rule hosts have
    lengths: list[int]  # lengths that rule paths have


def _block(rules: list[tuple[bytes, int]]) -> bytes:
    keyed = sorted((xxhash.xxh64_intdigest(text), text, verdict) for text, verdict in rules)
    ends = np.cumsum([len(text) for _, text, _ in keyed], dtype=np.int64)
    return b"".join([
        np.array([k for k, _, _ in keyed], np.uint64).tobytes(), ends.tobytes(),
        bytes(v for _, _, v in keyed), *[t for _, t, _ in keyed],
    ])


def build_index(rules: DataFrame, most: int = 1_000_000) -> Index:
    """Index of rules (host, path, verdict); host in lower case, without a leading dot."""
    spark: SparkSession = rules.sparkSession
    clean = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin(VERDICTS))
        .groupBy("host", "path").agg(F.max((F.col("verdict") == "block").cast("int")).alias("verdict"))
    )
    folder = scratch(spark, "url-index")
    files = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    shared = files.getScheme() == "file"
    blocks, depths, lengths, held = [], set(), set(), []

    def flush() -> None:
        data = _block(held)
        name = f"{folder}/{folder.rsplit('/', 2)[-2]}-{len(blocks)}"
        stream = files.create(spark._jvm.org.apache.hadoop.fs.Path(name))
        stream.write(data)
        stream.close()
        if not shared:
            spark.sparkContext.addFile(name)
        local = spark._jvm.org.apache.hadoop.fs.Path(name).toUri().getPath() if shared else name
        blocks.append(Block(local, len(held), len(data), shared))
        held.clear()

    for row in clean.toLocalIterator():
        depths.add(row["host"].count(".") + 1)
        lengths.add(len(row["path"]))
        held.append(((row["host"] + row["path"]).encode(), row["verdict"]))
        if len(held) >= most:
            flush()
    if held:
        flush()
    return Index(blocks, sorted(depths), sorted(lengths))


def _probes(host: str, path: str, index: Index) -> list[bytes]:
    """Texts of all rules that would fit, longest first."""
    labels = host.split(".")
    hosts = [".".join(labels[-d:]) for d in index.depths if d <= len(labels)]
    paths = [path[:n] for n in index.lengths if n <= len(path)]
    return sorted((f"{h}{p}".encode() for h in hosts for p in paths), key=lambda t: (-len(t), t))


def _find(block: tuple[np.ndarray, ...], keys: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """(number of the text, its verdict) for each text that the block holds."""
    own, ends, verdicts, held = block
    for i, at in enumerate(np.searchsorted(own, keys)):
        while at < len(own) and own[at] == keys[i]:
            start = int(ends[at - 1]) if at else 0
            if held[start : int(ends[at])].tobytes() == texts[i]:
                yield i, int(verdicts[at])
                break
            at += 1


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", most: int = 1_000_000) -> DataFrame:
    """All rows with host, path, rule (NULL where none fits) and verdict (the rule's, else the default)."""
    index = build_index(rules, most)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [b.load() for b in index.blocks]
        for batch in batches:
            parts = [split_url(u) for u in batch.column(url).to_pylist()]
            probes = [_probes(h, p, index) for h, p in parts]
            texts = [t for own in probes for t in own]
            owner = np.repeat(np.arange(len(parts)), [len(own) for own in probes])
            keys = np.array([xxhash.xxh64_intdigest(t) for t in texts], np.uint64)
            best: dict[int, tuple[int, int]] = {}  # of each row, the first text found: its longest rule
            for block in blocks:
                for i, verdict in _find(block, keys, texts):
                    row = int(owner[i])
                    best[row] = min(best.get(row, (i, verdict)), (i, verdict))
            columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {
                "host": pa.array([h for h, _ in parts], pa.string()),
                "path": pa.array([p for _, p in parts], pa.string()),
                "rule": pa.array([texts[best[i][0]].decode() if i in best else None for i in range(len(parts))], pa.string()),
                "verdict": pa.array([VERDICTS[best[i][1]] if i in best else default for i in range(len(parts))], pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = pages.drop("host", "path", "rule", "verdict")
    added = [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")]
    return rows.mapInArrow(judge, T.StructType([*rows.schema.fields, *added]))


#: Host, start of the path, verdict.
RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]

SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), named AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
  END AS rule
  FROM named
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op7_url_filter", SQL)
def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url"), rules).drop("url")
