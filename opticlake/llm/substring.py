"""Substring deduplication with a compressed FM-index per shard.

A window is 50 consecutive words of one document (words are kept as they are). Each word covered by a window whose
words also start in a document with a smaller doc_id is removed; all windows are judged on the input.

* Each window has an anchor, the least hash of the runs of ten words in it, so equal windows have equal anchors.
  Windows in a row with one anchor make a segment. Only anchors that occur in two different texts matter; of documents
  with the same words only the smallest doc_id is looked at, the others lose all their words.
* The segments of those anchors are dealt out to shards by anchor, equal segments as one with their smallest doc_id.
  Anchors of very many documents are refined by two more hashes, so that they spread over shards. Where the distinct
  segments of one anchor still hold more than SHARD_WORDS words (a passage that many documents share in different
  surroundings), their windows are grouped by a 128-bit hash with the smallest doc_id instead, which no task holds.
* A shard builds an FM-index of its segments, in the order of doc_id: suffixes sorted by prefix doubling, the
  Burrows-Wheeler transform in a wavelet tree. Every segment is streamed against it; backward search tells where its
  matches with earlier documents reach 50 words, and the intervals found are carried back to the documents.

Edge cases: NULL and empty texts and those under 50 words stay as they are; rows that share a doc_id do not remove each
other's words, and each is compared with smaller doc_ids only; rows with a NULL doc_id stay and remove nothing; an
empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opticlake.llm.catalog import query
from opticlake.llm.fm_index import FMIndex
from opticlake.llm.words import mix, run_hashes, span_hashes, text_blocks, word_spans
from opticlake.operators.joins import join_per_key
from opticlake.session import materialize

WINDOW, GRAM = 50, 10
HOT = 5_000  # documents beyond which an anchor is refined
SHARD_WORDS = 400_000
SEND_IDS = 1_000_000  # most document numbers that are sent to all executors


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Windows:
    """The windows of a block of texts and their anchors."""

    def __init__(self, data: np.ndarray, rows: np.ndarray):
        self.starts, self.ends, self.first = word_spans(data, rows)
        self.words = span_hashes(data, self.starts, self.ends)
        n = max(0, len(self.words) - WINDOW + 1)
        owner = np.repeat(np.arange(len(rows) - 1), np.diff(self.first))
        self.owner = owner[:n]
        self.whole = owner[:n] == owner[WINDOW - 1 :] if n else np.zeros(0, bool)
        self.grams = run_hashes(self.words, GRAM)
        self.anchors = _least(self.grams, WINDOW - GRAM + 1) if n else np.zeros(0, np.uint64)

    def refine(self, hot: np.ndarray) -> None:
        """Tell the windows of hot anchors apart by two further hashes."""
        at = np.flatnonzero(hot)
        if len(at):
            for salt in (1, 2):
                more = _least(mix(self.grams + np.uint64(salt)), WINDOW - GRAM + 1)
                self.anchors[at] = mix(self.anchors[at] + more[at] * np.uint64(2 * salt + 1))

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of each run of windows of one text with one anchor."""
        n = len(self.anchors)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        change = np.ones(n, bool)
        change[1:] = (self.anchors[1:] != self.anchors[:-1]) | (self.owner[1:] != self.owner[:-1]) | (self.whole[1:] != self.whole[:-1])
        begin = np.flatnonzero(change)
        end = np.concatenate([begin[1:], [n]]) + WINDOW - 1
        return begin[self.whole[begin]], end[self.whole[begin]]


def _joined(words: list[bytes]) -> tuple[bytes, str]:
    text = b" ".join(words)
    return text, hashlib.sha256(text).hexdigest()


def _survey(docs: DataFrame) -> DataFrame:
    """Rows of documents (doc_id, n_words, sha) and of their anchors (doc_id, anchor)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for at, data, rows in text_blocks(batch.column("text")):
                held = [data[a:b].tobytes().split() for a, b in zip(rows[:-1], rows[1:], strict=True)]
                own = ids.slice(at, len(held))
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array([len(w) for w in held], pa.int64()), pa.array([_joined(w)[1] for w in held]), pa.nulls(len(held), pa.int64())],
                    names=["doc_id", "n_words", "sha", "anchor"])
                windows = Windows(data, rows)
                begin, _ = windows.segments()
                n = len(begin)
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(windows.owner[begin])), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.array(windows.anchors[begin].view(np.int64))],
                    names=["doc_id", "n_words", "sha", "anchor"])

    return docs.mapInArrow(scan, "doc_id long, n_words long, sha string, anchor long")


def _segments(texts: DataFrame) -> DataFrame:
    """Segments of the wanted anchors of texts (doc_id, text, anchors, hot): one row each with its words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted, hot = (batch.column(c) for c in ("doc_id", "anchors", "hot"))
            for at, data, rows in text_blocks(batch.column("text")):
                windows = Windows(data, rows)
                good, heavy = np.zeros(len(windows.anchors), bool), np.zeros(len(windows.anchors), bool)
                for i in range(len(rows) - 1):
                    a, b = np.searchsorted(windows.owner, [i, i + 1])
                    for flags, column in ((good, wanted), (heavy, hot)):
                        flags[a:b] = np.isin(windows.anchors[a:b], column[at + i].values.to_numpy(zero_copy_only=False).view(np.uint64))
                windows.whole &= good | heavy
                windows.refine(heavy)
                begin, end = windows.segments()
                out = []
                for s, e in zip(begin.tolist(), end.tolist(), strict=True):
                    i = int(windows.owner[s])
                    text = b" ".join(data[windows.starts[s] : windows.ends[e - 1]].tobytes().split())
                    out.append((int(windows.anchors[s].view(np.int64)), hashlib.blake2b(text, digest_size=16).digest(),
                                ids[at + i].as_py(), i, s - int(windows.first[i]), e - s, text))
                shas = {i: _joined(data[rows[i] : rows[i + 1]].tobytes().split())[1] for i in {o[3] for o in out}}
                yield pa.RecordBatch.from_arrays([
                    pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary()),
                    pa.array([o[2] for o in out], pa.int64()), pa.array([shas[o[3]] for o in out], pa.string()),
                    pa.array([o[4] for o in out], pa.int64()), pa.array([o[5] for o in out], pa.int64()),
                    pa.array([o[6] for o in out], pa.binary()).cast(pa.string()),
                ], names=["anchor", "key", "doc_id", "sha", "start", "length", "words"])

    return texts.mapInArrow(scan, "anchor long, key binary, doc_id long, sha string, start long, length long, words string")


def _shard(keys: list[bytes], owners: np.ndarray, texts: pa.Array) -> list[tuple[bytes, int, int]]:
    """(key, from, to) of the stretches of each segment that an earlier document of the shard holds."""
    order = np.argsort(owners, kind="stable")
    owners = owners[order]
    parts = []
    for _, data, rows in text_blocks(texts.take(pa.array(order)), 1 << 22):
        starts, ends, first = word_spans(data, rows)
        parts.append((span_hashes(data, starts, ends), np.diff(first)))
    lengths = np.concatenate([p[1] for p in parts])
    numbers = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)[1] + 1
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    text = np.zeros(int(lengths.sum()) + len(lengths), np.int64)
    text[np.arange(len(numbers)) + np.repeat(np.arange(len(lengths)), lengths)] = numbers
    limit = begin[np.searchsorted(owners, owners)]  # where the owner's own segments begin
    found = FMIndex(text, WINDOW + 1).earlier_matches(begin, begin + lengths, limit, WINDOW)
    return [(keys[order[i]], a - int(begin[i]), b - int(begin[i])) for i, a, b in found]


def _windows(segments: DataFrame) -> DataFrame:
    """One row per window of segments (key, owner, words): its hash (a, b), key, owner and from."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, rows in text_blocks(batch.column("words")):
                windows = Windows(data, rows)
                begin = np.flatnonzero(windows.whole)
                row = windows.owner[begin]
                yield pa.RecordBatch.from_arrays([
                    *[pa.array(run_hashes(w, WINDOW)[begin].view(np.int64)) for w in (windows.words, mix(windows.words + np.uint64(1)))],
                    batch.column("key").take(pa.array(at + row)), batch.column("owner").take(pa.array(at + row)),
                    pa.array(begin - windows.first[row], pa.int64())], names=["a", "b", "key", "owner", "from"])

    return segments.select("key", "owner", "words").mapInArrow(scan, "a long, b long, key binary, owner long, from long")


def _window_matches(segments: DataFrame) -> DataFrame:
    """The same as _matches of segments of any number: no task holds those of an anchor."""
    windows = _windows(segments)
    first = windows.groupBy("a", "b").agg(F.min("owner").alias("_lo"), F.max("owner").alias("_hi")).where("_lo < _hi")
    later = join_per_key(windows, first, ["a", "b"], "inner").where("owner > _lo")
    return later.select("key", "from", (F.col("from") + WINDOW).alias("to"))


def _matches(segments: DataFrame) -> DataFrame:
    """(key, from, to) of stretches of segments (anchor, key, owner, words) that occur in an earlier owner's segments."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(rows: pa.Table) -> pa.RecordBatch:
            found = _shard(rows["key"].to_pylist(), rows["owner"].to_numpy(), rows["words"].combine_chunks()) if rows.num_rows > 1 else []
            return pa.RecordBatch.from_arrays([
                pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.int64()),
                pa.array([f[2] for f in found], pa.int64())], names=["key", "from", "to"])

        for batch in batches:
            held.append(batch)
            size += int(np.sum(batch.column("length").to_numpy()))
            if size >= SHARD_WORDS:
                rows = pa.Table.from_batches(held)
                anchors = rows["anchor"].to_numpy()
                cut = int(np.argmax(anchors == anchors[-1]))  # the last anchor may go on in the next batch
                if cut:
                    yield flush(rows.slice(0, cut))
                    held = rows.slice(cut).combine_chunks().to_batches()
                    size = int(np.sum(rows["length"].to_numpy()[cut:]))
        if held:
            yield flush(pa.Table.from_batches(held))

    return segments.mapInArrow(scan, "key binary, from long, to long")


def _some(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents in a table of distinct doc_id; a small one is sent to the readers of the texts."""
    small = ids.limit(SEND_IDS + 1).count() <= SEND_IDS
    return docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")


def _kept(texts: DataFrame) -> DataFrame:
    """What is left of texts (doc_id, text, sha, spans) where sha is that of the text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, (text, sha) in enumerate(zip(batch.column("text").to_pylist(), batch.column("sha").to_pylist(), strict=True)):
                words = (text or "").encode().split()
                if _joined(words)[1] == sha:
                    gone = np.zeros(len(words) + 1, np.int64)
                    for span in batch.column("spans")[i].as_py():
                        gone[span["from"]] += 1
                        gone[span["to"]] -= 1
                    left = [w for w, g in zip(words, np.cumsum(gone)[:-1].tolist(), strict=True) if not g]
                    out.append((batch.column("doc_id")[i].as_py(), sha, len(words) - len(left), *_joined(left)))
            yield pa.RecordBatch.from_arrays([
                pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.int64()),
                pa.array([o[3] for o in out], pa.binary()).cast(pa.string()), pa.array([o[4] for o in out], pa.string())],
                names=["doc_id", "sha", "n_removed", "kept", "kept_sha256"])

    return texts.mapInArrow(scan, "doc_id long, sha string, n_removed long, kept string, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of documents (doc_id, text): doc_id, n_words, n_removed, kept (text left where words went, else NULL), kept_sha256."""
    docs = docs.select("doc_id", "text")
    survey = materialize(_survey(docs), "repeats-survey")
    rows = survey.where("anchor IS NULL").select("doc_id", "n_words", "sha")
    long = rows.where(f"doc_id IS NOT NULL AND n_words >= {WINDOW}")
    first = long.groupBy("sha").agg(F.min("doc_id").alias("first"))
    owned = materialize(join_per_key(long, first, ["sha"], "inner").select("doc_id", "sha", "first"), "repeats-owned")
    copies = owned.where("doc_id <> first").select("doc_id", "sha").distinct()
    originals = owned.where("doc_id = first").select("doc_id").distinct()
    only_copies = copies.select("doc_id").distinct().join(originals, "doc_id", "left_anti")

    anchors = survey.where("anchor IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "anchor")
    anchors = anchors.join(only_copies, "doc_id", "left_anti")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi"), F.count("*").alias("_n")).where("_lo < _hi")
    wanted = join_per_key(anchors, shared.select("anchor", (F.col("_n") > HOT).alias("hot")), ["anchor"], "inner")
    wanted = materialize(wanted.groupBy("doc_id").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("anchor"))).alias("anchors"), F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot")), "repeats-wanted")
    texts = _some(docs, wanted.select("doc_id")).join(wanted, "doc_id")
    found = materialize(_segments(texts), "repeats-segments")

    distinct = found.groupBy("anchor", "key", "length", "words").agg(F.min("doc_id").alias("owner"))
    owners = materialize(distinct, "repeats-distinct")
    total = owners.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // SHARD_WORDS)
    # There are at most total / SHARD_WORDS such anchors.
    large = owners.groupBy("anchor").agg(F.sum("length").alias("n")).where(F.col("n") > SHARD_WORDS).select("anchor")
    large = F.broadcast(materialize(large, "repeats-large"))
    dealt = owners.join(large, "anchor", "left_anti").repartition(shards, "anchor").sortWithinPartitions("anchor")
    matches = _matches(dealt).unionByName(_window_matches(owners.join(large, "anchor", "left_semi")))
    stretches = matches.groupBy("key").agg(F.collect_list(F.struct("from", "to")).alias("inner"))
    per = join_per_key(owners.select("key", "owner").groupBy("key").agg(F.min("owner").alias("owner")), stretches, ["key"])
    placed = join_per_key(found.select("key", "doc_id", "sha", "start", "length"), per, ["key"], "inner")
    own = F.when(F.col("doc_id") > F.col("owner"), F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("length").alias("to")))).otherwise(F.col("inner"))
    spans = placed.select("doc_id", "sha", F.transform(own, lambda s: F.struct(
        (s["from"] + F.col("start")).alias("from"), (s["to"] + F.col("start")).alias("to"))).alias("spans")).where("size(spans) > 0")
    gone = materialize(spans.groupBy("doc_id", "sha").agg(F.flatten(F.collect_list("spans")).alias("spans")), "repeats-gone")
    left = materialize(_kept(_some(docs, gone.select("doc_id").distinct()).join(gone, "doc_id")), "repeats-kept").distinct()

    none = F.sha2(F.lit(""), 256)
    gone_whole = copies.select("doc_id", "sha", F.lit(True).alias("_copy"))
    out = rows.join(gone_whole, ["doc_id", "sha"], "left").join(left, ["doc_id", "sha"], "left")
    return out.select(
        "doc_id", "n_words", F.when(F.col("_copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("_copy"), F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(F.col("_copy"), none).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


@query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf}/documents.parquet")).drop("kept")
