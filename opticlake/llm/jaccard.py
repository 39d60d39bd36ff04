"""N-gram Jaccard join by token-combination prefixes, and the components of its links.

A document's set holds its distinct shingles of five words (A-Z in lower case); a shorter document is one shingle, one
without words has none and no links. Two sets link at a Jaccard similarity of 0.75 or more.

* Order. Tokens (shingle hashes) are put in one global order: rare ones first. Very frequent ones are found from counts
  of 2**20 hash buckets over all documents, in which a task reports only its outstanding buckets; the others from the
  index itself: tokens under which it holds more than SMALL sets are frequent from then on, and the documents that have
  one are indexed again. The order decides the cost, never the result.
* Prefixes. Of n tokens two linked sets differ in at most t = n - ceil(0.75 n) of x's, so one of its first t + 1 tokens
  is shared. Rare tokens are indexed singly. Frequent ones are dealt into parts by hash, and pairs of tokens of the same
  part are indexed: the prefix is extended until the rare tokens and, per part, the tokens beyond the first come to
  t + 1, so that two linked sets share a rare token or a pair. The number of parts goes by the power of two below n,
  and a set near the next power is indexed under both.
* Candidates. Sets under one signature are paired if sizes and positions allow the overlap (all pairs of up to SMALL
  sets; in larger groups each with the first). Larger groups are kept; those that then hold sets of different components
  are compared with their first member, at last with all members of other components. So copies are
  not expanded to all pairs, and no link between different texts is lost. Groups with the same first member, which mostly
  hold the same documents, are one family there, so that two documents meet once and not under each token that they share.
* Verification. The smallest quarter of two sets' hashes bounds what they can share, in the last comparison the bits in which
  bitmaps of the whole sets differ; pairs that pass are intersected.

Equal sets are one node, the smallest doc_id, so exact copies cost nothing. Hot signatures are salted or, where groups
are compared again, joined in a way that adaptive execution can split.

Edge cases: NULL and empty texts have n_shingles 0 and are their own component; rows that share a doc_id are one
document (linked with each other); a NULL doc_id takes no part and gets a NULL component; an empty table gives no rows;
further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opticlake.llm.catalog import fresh, query
from opticlake.llm.components import connected_components
from opticlake.llm.words import LOWER, mix, run_hashes, span_hashes, text_blocks, word_spans
from opticlake.operators.joins import join_per_key
from opticlake.session import materialize, passing, release

SIZE, PERCENT = 5, 75
SMALL = 16  # groups up to this size are paired in full at once
PHASES = 3  # times that documents with frequent tokens are indexed
SALTS = 8  # parts that the groups of frequent tokens are cut into at first
BUCKET_BITS = 20
FREQUENT = 1 << 18  # most buckets, and most tokens, that are known as frequent: a few MB in each task
SEND_IDS = 1_000_000  # most document numbers that are sent to all executors
LEAST = 64  # hashes of a set that are compared first, where a quarter of it is less
FILE_ROWS = 50_000  # rows of a file of a small table
BIG = 5_000  # most members of a group whose pairs are compared by one task
PAIR_ROWS = 64  # members of a group that are compared with all others at once
MOST_BITS = 1 << 15  # of the bitmap of a set
CHUNK = 200_000  # most rows of a group that a task holds

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def shingle_sets(texts: pa.Array, size: int = SIZE) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for at, data, rows in text_blocks(texts):
        data = LOWER[data]
        starts, ends, first = word_spans(data, rows)
        words = span_hashes(data, starts, ends)
        runs = run_hashes(words, size)
        for i in range(len(rows) - 1):
            low, n = int(first[i]), int(first[i + 1] - first[i])
            if n >= size:
                yield at + i, np.unique(runs[low : low + n - size + 1])
            elif n:
                yield at + i, mix(run_hashes(words[low : low + n], n) + _C * np.uint64(n))
            else:
                yield at + i, np.zeros(0, np.uint64)


def _sketch(docs: DataFrame, size: int) -> DataFrame:
    """Rows of documents (doc_id, n_shingles, digest) and of outstanding buckets (bucket, n_shingles is their count)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, waiting = np.zeros(1 << BUCKET_BITS, np.int64), [], 0
        names = ["doc_id", "n_shingles", "digest", "bucket"]
        for batch in batches:
            n, digests = [], []
            for _, tokens in shingle_sets(batch.column("text"), size):
                n.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                held.append(tokens >> np.uint64(64 - BUCKET_BITS))
                waiting += len(tokens)
                if waiting > 1_000_000:
                    counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(counts))
                    held, waiting = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.nulls(len(n), pa.int64())], names=names)
        if held:
            counts += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(counts))
        top = np.flatnonzero(counts >= max(8, 4 * counts.mean()))
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(top), pa.int64()), pa.array(counts[top]), pa.nulls(len(top), pa.binary()), pa.array(top)], names=names)

    return docs.mapInArrow(scan, "doc_id long, n_shingles long, digest binary, bucket long")


@dataclass
class Frequent:
    """What is known of frequent tokens: sorted buckets and sorted tokens, and how often each was met."""

    buckets: np.ndarray
    bucket_counts: np.ndarray
    tokens: np.ndarray
    token_counts: np.ndarray

    def counts(self, tokens: np.ndarray) -> np.ndarray:
        """0 for rare tokens."""
        out = np.zeros(len(tokens), np.int64)
        for held, counts, own in ((self.buckets, self.bucket_counts, (tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)),
                                  (self.tokens, self.token_counts, tokens)):
            if len(held):
                at = np.searchsorted(held, own)
                at[at == len(held)] = 0
                out = np.where(held[at] == own, counts[at], out)
        return out

    def also(self, more: DataFrame) -> Frequent:
        """With the tokens of `more` (sig, n) too, the most frequent first as far as there is room."""
        rows = more.orderBy(F.desc("n"), "sig").limit(max(0, FREQUENT - len(self.tokens))).toArrow()
        tokens = np.concatenate([self.tokens, rows["sig"].to_numpy().view(np.uint64)])
        counts = np.concatenate([self.token_counts, rows["n"].to_numpy()])
        order = np.argsort(tokens)
        return Frequent(self.buckets, self.bucket_counts, tokens[order], counts[order])


def _frequent(sketch: DataFrame) -> Frequent:
    total = sketch.where("bucket IS NULL").agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("n")).first()["n"]
    sums = sketch.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n_shingles").alias("n"))
    top = sums.where(F.col("n") >= max(64, 8 * total >> BUCKET_BITS)).orderBy(F.desc("n"), "bucket").limit(FREQUENT).toArrow()
    order = np.argsort(top["bucket"].to_numpy())
    return Frequent(top["bucket"].to_numpy()[order], top["n"].to_numpy()[order], np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _pairs_before(sizes: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j), i before j in the same run of rows; j is paired with the first most[run] rows before it."""
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    begin = np.repeat(starts, sizes)
    take = np.minimum(np.arange(len(begin)) - begin, np.repeat(most, sizes))
    j = np.repeat(np.arange(len(begin)), take)
    ends = np.cumsum(take)
    i = np.arange(len(j)) - np.repeat(ends - take, take) + begin[j]
    return i, j


def prefix_signatures(tokens: np.ndarray, frequent: Frequent, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, int]:
    """(signatures, most tokens that sets can share if this is the first signature they share, number of rare ones)."""
    n = len(tokens)
    need = n + (-n * percent // 100) + 1
    counts = frequent.counts(tokens)
    common = counts > 0
    rare = tokens[~common]
    singles = min(len(rare), need)
    signatures, caps = [rare[:singles]], [n - np.arange(singles)]
    if singles < need:
        own = tokens[common][np.lexsort((tokens[common], counts[common]))]
        low = n.bit_length() - 1
        for power in (low, low + 1):
            if power > low and n * 100 < (1 << power) * percent:
                continue
            salt = _C * np.uint64(power + 1)
            if power < 4:
                few = own[: need - singles]
                signatures.append(mix(few + salt))
                caps.append(n - singles - np.arange(len(few)))
                continue
            parts = (1 << power) // 8
            part = ((own >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)
            further = np.ones(len(own), np.int64)
            further[np.unique(part, return_index=True)[1]] = 0
            length = int(np.searchsorted(np.cumsum(further), need - singles)) + 1
            order = np.argsort(part[:length], kind="stable")
            sizes = np.unique(part[:length], return_counts=True)[1]
            i, j = (order[x] for x in _pairs_before(sizes, np.full(len(sizes), length)))
            signatures.append(mix(own[i] * _A + own[j] * _B + salt))
            # The rare tokens are not shared, or one of them is the first signature; before j a part holds one shared token.
            caps.append(np.minimum(parts - j, 0) + n - singles)
    return np.concatenate(signatures), np.concatenate(caps), singles


def _index(docs: DataFrame, frequent: Frequent, size: int, percent: int) -> DataFrame:
    """Rows of (sig, salt, doc, meta): meta holds the set's size and the most tokens that it can share."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            sigs, salts, owners, metas, waiting = [], [], [], [], 0

            def flush() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (sigs, salts, owners, metas)], names=["sig", "salt", "doc", "meta"])

            for row, tokens in shingle_sets(batch.column("text"), size):
                if not len(tokens):
                    continue
                sig, cap, rare = prefix_signatures(tokens, frequent, percent)
                salt = np.zeros(len(sig), np.int32)
                salt[rare:] = 1 + int(ids[row]) % SALTS
                sigs.append(sig.view(np.int64))
                salts.append(salt)
                owners.append(np.full(len(sig), ids[row], np.int64))
                metas.append((np.int64(len(tokens)) << np.int64(32)) + cap)
                waiting += len(sig)
                if waiting > 100_000:
                    yield flush()
                    sigs, salts, owners, metas, waiting = [], [], [], [], 0
            if sigs:
                yield flush()

    return docs.mapInArrow(scan, "sig long, salt int, doc long, meta long")


def _may_link(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and positions allow the similarity."""
    n, m = left >> 32, right >> 32
    cap = np.minimum(left & 0xFFFFFFFF, right & 0xFFFFFFFF)
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((100 + percent) * cap >= percent * (n + m))


def _group_pairs(index: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (sig NULL, a, b) of each group, and the rows (sig, doc, meta, single) of groups that are not done."""

    def grouped(sig: np.ndarray, salt: np.ndarray, doc: np.ndarray, meta: np.ndarray, cut: bool) -> pa.RecordBatch:
        edge = np.flatnonzero((sig[1:] != sig[:-1]) | (salt[1:] != salt[:-1])) + 1
        sizes = np.diff(np.concatenate([[0], edge, [len(sig)]]))
        i, j = _pairs_before(sizes, np.where(sizes <= SMALL, SMALL, 1))
        good = _may_link(meta[i], meta[j], percent) & (doc[i] != doc[j])
        pairs = np.unique(np.stack([np.minimum(doc[i], doc[j])[good], np.maximum(doc[i], doc[j])[good]], 1), axis=0)
        kept = np.repeat((sizes > SMALL) | cut, sizes) | (salt > 0)
        none, no = pa.nulls(len(pairs), pa.int64()), pa.nulls(len(pairs), pa.bool_())
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([none, pa.array(sig[kept])]), pa.array(np.concatenate([pairs[:, 0], doc[kept]])),
            pa.array(np.concatenate([pairs[:, 1], meta[kept]])), pa.concat_arrays([no, pa.array(salt[kept] == 0)])], names=["sig", "a", "b", "single"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        cut = False  # a part of the group that is held has been given out already
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("sig", "salt", "doc", "meta")]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            sig, salt = rows[:2]
            if len(sig) < 50_000:
                held = rows
                continue
            last = len(sig) - 1
            same = (sig == sig[last]) & (salt == salt[last])
            end = int(np.argmax(same))
            if end:
                yield grouped(*[x[:end] for x in rows], cut)
                cut = False
            if len(sig) - end > CHUNK:
                yield grouped(*[x[end:] for x in rows], True)
                held, cut = [x[:0] for x in rows], True
            else:
                held = [x[end:] for x in rows]
        if held is not None and len(held[0]):
            yield grouped(*held, cut)

    dealt = index.repartition("sig", "salt").sortWithinPartitions("sig", "salt", "doc")
    return dealt.mapInArrow(scan, "sig long, a long, b long, single boolean")


def _tokens(docs: DataFrame, ids: DataFrame, size: int, percent: int, whole: bool) -> DataFrame:
    """(doc, n, tokens) of the documents in distinct ids: the whole sets, or 32 bits of the least hashes of about a quarter."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, out = batch.column("doc_id").to_pylist(), []
            for row, tokens in shingle_sets(batch.column("text"), size):
                n = len(tokens)
                if n:
                    held = tokens if whole else (tokens[: max(LEAST, n + (-n * percent // 100) + 1)] >> np.uint64(32)).astype(np.uint32)
                    out.append((numbers[row], n, held.tobytes()))
            yield pa.RecordBatch.from_arrays([
                pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())],
                names=["doc", "n", "tokens"])

    return materialize(_only(docs, ids, "left_semi").mapInArrow(scan, "doc long, n long, tokens binary"), "jaccard-tokens")


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """A set in at least two bits a token, the power of two: its words of 64 bits.

    A bit that is set in one of two bitmaps alone stands for a token that the other set has not.
    """
    width = min(MOST_BITS, max(64, 1 << (2 * len(tokens) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _bitmaps(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(doc, n, bits) of the documents in distinct ids."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, out = batch.column("doc_id").to_pylist(), []
            for row, tokens in shingle_sets(batch.column("text"), size):
                if len(tokens):
                    out.append((numbers[row], len(tokens), bitmap(tokens).tobytes()))
            yield pa.RecordBatch.from_arrays([
                pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())],
                names=["doc", "n", "bits"])

    return _only(docs, ids, "left_semi").mapInArrow(scan, "doc long, n long, bits binary")


def _held(df: DataFrame, label: str, most: int) -> DataFrame:
    """A table of at most so many rows, in few files where that is little."""
    return materialize(df.coalesce(1 + most // FILE_ROWS), label) if most < 20 * FILE_ROWS else materialize(df, label)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b"))


def _most_shared(n: int, x: np.ndarray, m: int, y: np.ndarray) -> int:
    """Upper bound of the tokens that two sets of n and m share, from the least hashes x and y of each."""
    whole = 1 << 32
    bar = min(int(x[-1]) if len(x) < n else whole, int(y[-1]) if len(y) < m else whole)
    low, high = x[: np.searchsorted(x, bar)], y[: np.searchsorted(y, bar)]
    shared = len(low) + len(high) - len(np.unique(np.concatenate([low, high])))
    return shared + min(n - len(low), m - len(high))


def _only(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Documents that are (or are not) in a table of distinct doc_id; a small one is sent to the readers of the texts."""
    small = ids.limit(SEND_IDS + 1).count() <= SEND_IDS
    return docs.join(F.broadcast(ids) if small else ids, "doc_id", how)


def _compare(pairs: DataFrame, held: DataFrame, percent: int, whole: bool) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, or may be by their least hashes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for n, x, m, y in zip(*(batch.column(c).to_pylist() for c in ("n", "x", "m", "y")), strict=True):
                if whole:
                    left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    shared = n + m - len(np.unique(np.concatenate([left, right])))
                else:
                    shared = _most_shared(n, np.frombuffer(x, np.uint32), m, np.frombuffer(y, np.uint32))
                good.append((100 + percent) * shared >= percent * (n + m))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    right = join_per_key(pairs.select("a", "b"), held.select(F.col("doc").alias("b"), F.col("n").alias("m"), F.col("tokens").alias("y")), ["b"], "inner")
    both = join_per_key(right, held.select(F.col("doc").alias("a"), "n", F.col("tokens").alias("x")), ["a"], "inner")
    return materialize(both.select("a", "b", "n", "x", "m", "y").mapInArrow(scan, "a long, b long"), "jaccard-compared")


def _regroup(kept: DataFrame, labels: DataFrame, texts: DataFrame, how: str, size: int, percent: int) -> DataFrame:
    """Pairs of different components in the groups that still hold some: with the first member, or all that may be similar."""
    rows = join_per_key(kept, labels.withColumnRenamed("node", "doc"), ["doc"]).withColumn("label", F.coalesce("label", "doc"))
    rows = materialize(rows.select("sig", "doc", "meta", "label"), "jaccard-kept")
    groups = rows.groupBy("sig").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"), F.count("*").alias("_n"), F.min(F.struct("doc", "meta", "label")).alias("_c"))
    mixed = groups.where("_lo < _hi")
    if how == "first":
        both = join_per_key(rows, mixed.select("sig", F.col("_c.doc").alias("_d"), F.col("_c.meta").alias("_m"), F.col("_c.label").alias("_l")), ["sig"], "inner").where("label <> _l")
        return _fitting(both, percent)
    rows = materialize(join_per_key(rows, mixed.select("sig", "_n", F.col("_c.doc").alias("first")), ["sig"], "inner"), "jaccard-mixed")
    members = materialize(_families(rows), "jaccard-families")
    ids = materialize(members.select(F.col("doc").alias("doc_id")).distinct(), "jaccard-ids")
    return _pairs_within(join_per_key(members, _bitmaps(texts, ids, size), ["doc", "n"], "inner"), percent).distinct()


def _families(rows: DataFrame) -> DataFrame:
    """(first, sig, _n, doc, n, meta, label): groups with the same first member as one, sig 0, where that makes fewer pairs.

    The most that a member can share there is the most under any of its signatures.
    """
    rows = rows.withColumn("n", F.shiftright("meta", 32))
    each = rows.groupBy("first").agg(F.sum("_n").alias("_each"))  # the sum of the squares of the sizes of its groups
    members = rows.groupBy("first", "doc", "n").agg(F.max("meta").alias("meta"), F.max("label").alias("label"))
    sizes = members.groupBy("first").agg(F.count("*").alias("_all")).join(each, "first")
    sizes = materialize(sizes.withColumn("_one", F.col("_all") * F.col("_all") <= F.col("_each")), "jaccard-sizes")
    as_one = sizes.where("_one").select("first", F.col("_all").alias("_n"))
    apart = join_per_key(rows, sizes.where("NOT _one").select("first", "_one"), ["first"], "inner").drop("_one")
    return join_per_key(members, as_one, ["first"], "inner").withColumn("sig", F.lit(0).cast("long")).unionByName(apart)


def _fitting(both: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of rows whose sizes and positions allow the similarity."""
    n, m = F.shiftright("meta", 32), F.shiftright("_m", 32)
    cap = F.least(F.col("meta").bitwiseAND(0xFFFFFFFF), F.col("_m").bitwiseAND(0xFFFFFFFF))
    fits = (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (cap * (100 + percent) >= (n + m) * percent)
    return both.where(fits).select(F.least("doc", "_d").alias("a"), F.greatest("doc", "_d").alias("b")).distinct()


def _far(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """In how many bits each of some bitmaps differs from each of others; a row is a bitmap."""
    out = np.zeros((len(own), len(other)), np.uint16)
    for x, y in zip(own.T, np.ascontiguousarray(other.T), strict=True):
        out += np.bitwise_count(x[:, None] ^ y)
    return out


def _pairs_within(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components within groups (first, sig) that may be similar by sizes, positions and bitmaps.

    The members of a group of more than BIG are dealt into blocks of half that size by a hash, and each pair of blocks is
    compared by itself, so no task holds more than BIG of them.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def group(part: pa.Table) -> Iterator[np.ndarray]:
            doc, meta, label, n, block = (part[c].to_numpy() for c in ("doc", "meta", "label", "n", "block"))
            across = part["low"][0].as_py() != part["high"][0].as_py()
            bits = part["bits"].to_pylist()
            words = np.array([len(x) // 8 for x in bits])
            before, maps = np.zeros(0, np.int64), np.zeros((0, 0), np.uint64)  # rows of half the width, and their bitmaps
            for width in np.unique(words):
                rows = np.flatnonzero(words == width)
                own = np.frombuffer(b"".join(bits[i] for i in rows), np.uint64).reshape(len(rows), width)
                # Sets of a fourth of the width are too small to be similar.
                shorter = own[:, : width // 2] | own[:, width // 2 :] if maps.shape[1] * 2 == width else None
                for at in range(0, len(rows), PAIR_ROWS):
                    some = slice(at, at + PAIR_ROWS)
                    sides = [(rows[: at + PAIR_ROWS], own[some], own[: at + PAIR_ROWS])]
                    if shorter is not None:
                        sides.append((before, shorter[some], maps))
                    for others, left, right in sides:
                        i, j = rows[some, None], others
                        good = (label[i] != label[j]) & (doc[i] != doc[j]) & _may_link(meta[i], meta[j], percent)
                        if others is not before:
                            good &= j < i
                        if across:
                            good &= block[i] != block[j]
                        if good.any():
                            both = n[i] + n[j]
                            good &= (100 + percent) * (both - _far(left, right)) >= 2 * percent * both
                            x, y = np.nonzero(good)
                            x, y = doc[rows[some][x]], doc[others[y]]
                            yield np.stack([np.minimum(x, y), np.maximum(x, y)])
                before, maps = rows, own

        def edges(part: pa.Table) -> np.ndarray:
            """First rows of groups, but for the first group."""
            change = np.zeros(part.num_rows - 1, bool)
            for c in ("first", "sig", "low", "high"):
                own = part[c].to_numpy()
                change |= own[1:] != own[:-1]
            return np.flatnonzero(change) + 1

        def flush(part: pa.Table) -> pa.RecordBatch:
            edge = [0, *edges(part).tolist(), part.num_rows]
            found = [pairs for a, b in zip(edge[:-1], edge[1:], strict=True) for pairs in group(part.slice(a, b - a))]
            pairs = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *found], 1), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part])
            change = edges(part) if part.num_rows else []
            cut = int(change[-1]) if len(change) else 0  # the last group may go on in the next batch
            if cut:
                yield flush(part.slice(0, cut))
            held = part.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield flush(held)

    blocks = F.greatest(F.lit(1), F.ceil(F.col("_n") * 2 / BIG)).cast("int")
    own = rows.withColumn("block", F.pmod(F.xxhash64("doc"), blocks).cast("int"))
    sides = F.transform(F.sequence(F.lit(0), blocks - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("low"), F.greatest(x, F.col("block")).alias("high")))
    own = own.where(F.col("_n") <= BIG).withColumns({"block": F.lit(0), "low": F.lit(0), "high": F.lit(0)}).unionByName(
        own.where(F.col("_n") > BIG).withColumn("_s", F.explode(sides)).withColumns({"low": F.col("_s.low"), "high": F.col("_s.high")}).drop("_s"))
    wanted = own.select("first", "sig", "low", "high", "block", "doc", "meta", "label", "n", "bits")
    dealt = wanted.repartition("first", "sig", "low", "high").sortWithinPartitions("first", "sig", "low", "high")
    return dealt.mapInArrow(scan, "a long, b long")


def similar_components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row per row of documents (doc_id, text): doc_id, n_shingles, component_id."""
    docs = docs.select("doc_id", "text")
    sketch = materialize(_sketch(docs, size), "jaccard-sketch")
    frequent = _frequent(sketch)
    rows = sketch.where("bucket IS NULL").select("doc_id", "n_shingles", "digest")
    known = rows.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    # Equal sets are one node.
    first = known.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    members = materialize(join_per_key(known, first, ["digest"], "inner").select("doc_id", "n_shingles", "rep"), "jaccard-members")
    nodes = members.where("doc_id = rep").select("doc_id").distinct()
    copies = members.where("doc_id <> rep").select("doc_id").distinct().join(nodes, "doc_id", "left_anti")
    texts = _only(docs.where("doc_id IS NOT NULL"), materialize(copies, "jaccard-copies"), "left_anti")

    pairs, todo = None, texts
    for phase in range(PHASES):
        found = materialize(_group_pairs(_index(todo, frequent, size, percent), percent), "jaccard-found")
        release(docs.sparkSession)  # the index of this phase
        new = found.where("sig IS NULL").select("a", "b")
        pairs = new if pairs is None else pairs.unionByName(new)
        kept = found.where("sig IS NOT NULL").select("sig", F.col("a").alias("doc"), F.col("b").alias("meta"), "single")
        more = kept.where("single").groupBy("sig").agg(F.count("*").alias("n")).where(F.col("n") > SMALL)
        known = len(frequent.tokens)
        frequent = frequent.also(more)
        if phase == PHASES - 1 or len(frequent.tokens) == known:
            break
        todo = _only(texts, materialize(kept.select(F.col("doc").alias("doc_id")).distinct(), "jaccard-again"), "left_semi")
    pairs = materialize(pairs.distinct(), "jaccard-pairs")

    held = kept.select("doc").distinct()
    quarters = _tokens(texts, materialize(_ends(pairs).unionAll(held).distinct(), "jaccard-ids"), size, percent, False)

    def verify(some: DataFrame) -> DataFrame:
        n = some.count()
        with passing(docs.sparkSession, "jaccard-verified"):
            ids = _held(_ends(some).distinct(), "jaccard-ids", 2 * n)
            return _held(_compare(some, _tokens(texts, ids, size, percent, True), percent, True).distinct(), "jaccard-verified", n)

    # Rows of one doc_id with different sets are one document.
    twice = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("_max")).where("a <> _max").select("doc_id", "a")
    links = members.join(twice, "doc_id").select("a", F.col("rep").alias("b")).where("a <> b").distinct()

    # First the pairs of small groups and stars, then what the larger groups still hold of different components.
    tried = _compare(pairs, quarters, percent, False)
    links = materialize(links.unionByName(verify(tried)), "jaccard-links")
    labels = connected_components(links)
    for how in ("first", "all"):
        more = _regroup(kept, labels, texts, how, size, percent).join(tried, ["a", "b"], "left_anti")
        more = materialize(more, "jaccard-more")
        if more.isEmpty():
            continue
        tried = tried.unionByName(more)
        new = verify(_compare(more, quarters, percent, False) if how == "first" else more)
        if not new.isEmpty():
            links = links.unionByName(new)
            labels = connected_components(links)

    own = join_per_key(members, labels.select(F.col("node").alias("rep"), "label"), ["rep"])
    linked = own.select("doc_id", "n_shingles", F.coalesce("label", "rep").alias("component_id"))
    lone = rows.where("doc_id IS NULL OR digest IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(lone)


def first_of_each(docs: DataFrame) -> DataFrame:
    """The documents that are the smallest of their component; all rows without a doc_id stay.

    Rows that share a doc_id are one document: of several, the one with the smallest text stays.
    """
    more, place = fresh("more", docs.columns), fresh("place", docs.columns)
    with passing(docs.sparkSession, "jaccard-firsts"):
        firsts = similar_components(docs).where("doc_id = component_id").groupBy("doc_id").agg((F.count("*") > 1).alias(more))
        ids = materialize(firsts, "jaccard-firsts")
    kept = docs.join(ids, "doc_id").unionByName(docs.where("doc_id IS NULL").withColumn(more, F.lit(False)))
    if ids.where(F.col(more)).isEmpty():
        return kept.select(*docs.columns)
    rest = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first())
    ranked = kept.where(F.col(more)).withColumn(place, F.row_number().over(rest)).where(F.col(place) == 1)
    return kept.where(~F.col(more)).select(*docs.columns).unionByName(ranked.select(*docs.columns))


@query("op2_ngram_jaccard")
def op2_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return similar_components(spark.read.parquet(f"{sf}/documents.parquet"))
