"""Grouping of spelling variants by a relational trie.

The vocabulary is a trie kept as a table of edges: a node (a prefix, named by its hash), a letter, the child, whether a word ends
there, the letters that follow and the lengths of what may still follow. A table of states (word, position, node, edits) goes
down this trie level by level, one join with the edges of a level at a time:

* without an edit so far, a state follows its own letter, and branches: another letter (replaced), the same position
  (inserted), or, beside its own letter, the next position (deleted);
* after the edit only its own letters are left.

Near the root every letter can follow, and a branch for each edge and word would do nothing but end a level later. So there
are two tries in the table, of the words and of the words read backwards: an edit in the second half of a word is found in the
one, an edit in the first half in the other, and a text starts at the node of its first half. A branch is kept only
where the child can go on with the text's next letter and holds words of the right remaining length. States that use up their
text at the end of another one are its neighbours. Of equal edits (one of two equal letters) one way is followed. The edges of a
level are sent to the tasks while there are few (SEND_EDGES), else they meet the states in a join. The states of each level
are written to the shared folder.

A level is one letter, so words of more than LEVELS letters would take a join for each of them. These are matched by what is
left of them without one letter: two words are one edit apart exactly if they agree in the place of the removed letter and in
what is left, or one is what is left of the other. Groups of this kind hold at most one word per letter of the alphabet.
Hashes only name nodes and rests: every pair is compared as text at last.

Edge cases: NULL and empty texts have no words; a NULL doc_id is the empty text in the hash that alters runs; rows that
repeat count as often as they occur; runs that lose a letter and fall short are no words; an empty table gives no rows;
further columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opticlake.llm.catalog import query
from opticlake.llm.words import LOWER, mix, powers, span_hashes, text_blocks
from opticlake.operators.joins import join_per_key
from opticlake.session import materialize

SHORTEST, LEAST, EVERY = 5, 3, 97
LEVELS = 32
SEND_EDGES = 500_000  # most edges of a level that are sent to all tasks, twice (40 bytes each)
BLOCK = 1 << 20  # bytes of texts that a task counts at a time
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]+"

_LETTER = np.zeros(256, bool)
_LETTER[[b for b in range(128) if chr(b).isalpha()]] = True
#: U+00C0 to U+00FF are this byte and one that follows it.
_LEAD = 0xC3


def _crc_table() -> np.ndarray:
    """What each byte does to a crc32, from its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()


def _runs(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte and row of each maximal run of letters."""
    inside = _LETTER[data]
    lead = data == _LEAD
    inside |= lead
    inside[1:] |= lead[:-1]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    cuts = np.unique(rows[(rows > 0) & (rows < len(data))])  # once also where texts are empty
    split = cuts[inside[cuts] & inside[cuts - 1]]  # a run that ends with its text where the next text begins with one
    edge = np.sort(np.concatenate([edge, split, split]))
    edge = np.concatenate([[0] if len(data) and inside[0] else [], edge, [len(data)] if len(data) and inside[-1] else []]).astype(np.int64)
    starts, ends = edge[::2], edge[1::2]
    return starts, ends, np.searchsorted(rows, starts, "right") - 1


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each span, after what was read before it; all spans a byte at a time, the longest last."""
    order = np.argsort(starts - ends, kind="stable")
    crc, at, length = before[order], starts[order], (ends - starts)[order]
    for i in range(int(length[0]) if len(length) else 0):
        n = int(np.searchsorted(-length, -i, "left"))  # spans longer than i
        own = crc[:n]
        crc[:n] = _CRC[(own ^ data[at[:n] + i]) & np.uint32(255)] ^ (own >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = ~crc
    return out


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow column."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    held = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(held))]).cast(pa.string())


def word_counts(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """(word, n) of all runs of letters in lower case; of some, picked by a hash, one letter is left out.

    A task counts what is equal in a block of texts, by a 64-bit hash; the sums go by the words themselves.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [f"{'' if i is None else i}:".encode() for i in batch.column("id").to_pylist()]
            for at, raw, rows in text_blocks(batch.column("text"), BLOCK):
                data = LOWER[raw]
                starts, ends, owner = _runs(data, rows)
                if not len(starts):
                    continue
                first = np.array([zlib.crc32(ids[at + i]) ^ 0xFFFFFFFF for i in range(len(rows) - 1)], np.uint32)
                h = _checksums(data, starts, ends, first[owner])
                altered = h % np.uint32(every) == 0
                words = Counter()
                for a, b, own in zip(starts[altered].tolist(), ends[altered].tolist(), h[altered].tolist(), strict=True):
                    run = data[a:b].tobytes().decode()
                    place = own % len(run)
                    words[run[:place] + run[place + 1 :]] += 1
                starts, ends = starts[~altered], ends[~altered]
                _, one, n = np.unique(span_hashes(data, starts, ends), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([_texts(data, starts[one], ends[one]), pa.array(n.astype(np.int64))], names=["word", "n"])
                yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

    counted = docs.select(F.col("doc_id").cast("string").alias("id"), "text").mapInArrow(scan, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _letter(word: str | Column, at: Column) -> Column:
    return F.substring(word, at + 1, F.lit(1))


def _shift(name: str, value: Column, places: Column) -> Column:
    return F.call_function(name, value, places)


def _bit(letter: Column) -> Column:
    """The bit of a letter; letters that share one are told apart by the join of the next level."""
    return _shift("shiftleft", F.lit(1).cast("long"), F.ascii(letter) % 64)


def _node(side: str | Column, prefix: Column) -> Column:
    return F.xxhash64(side, prefix)


def sides(words: DataFrame) -> DataFrame:
    """(text, side, start): each word as it is and backwards, and the place from which it may be edited there."""
    half = F.floor(F.length("word") / 2).cast("int")
    both = F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("text"), half.alias("start")),
                   F.struct(F.lit(1).alias("side"), F.reverse("word").alias("text"), (F.length("word") - half).alias("start")))
    return words.select(F.inline(both))


def trie_edges(texts: DataFrame) -> DataFrame:
    """(level, node, letter, child, ends, next, rest): whether a word ends at the child, and what follows it.

    next holds the bits of letters that follow the child, rest those of the lengths that follow it (0 to 62, 63 for more).
    """
    length = F.length("text")
    steps = texts.select("text", "side", F.explode(F.sequence(F.lit(0), length - 1)).alias("level"))
    after = length - F.col("level") - 1
    paths = steps.select(
        "level", _node("side", F.substring("text", F.lit(1), F.col("level"))).alias("node"), F.ascii(_letter("text", F.col("level"))).alias("letter"),
        _node("side", F.substring("text", F.lit(1), F.col("level") + 1)).alias("child"), (after == 0).alias("ends"),
        F.when(after > 0, _bit(_letter("text", F.col("level") + 1))).otherwise(F.lit(0).cast("long")).alias("next"),
        _shift("shiftleft", F.lit(1).cast("long"), F.least(after, F.lit(63))).alias("rest"))
    return paths.groupBy("level", "node", "letter", "child").agg(
        F.max("ends").alias("ends"), F.bit_or("next").alias("next"), F.bit_or("rest").alias("rest"))


def _meeting(edges: DataFrame) -> DataFrame:
    """Edges by what looks for them: the node, for states without an edit, and the node and letter, for the others."""
    both = F.array(F.col("node"), F.xxhash64("node", "letter"))
    return edges.select(F.explode(both).alias("meets"), "letter", "child", "ends", "next", "rest")


def _step(states: DataFrame, meeting: DataFrame) -> DataFrame:
    """The states (text, side, pos, node, edits, done) of the next level; those that are done or without edges end."""
    length, pos, free = F.length("text"), F.col("pos"), F.col("edits") == 0
    own = F.when(pos < length, F.ascii(_letter("text", pos))).otherwise(-1)
    keyed = states.where(free | ~F.col("done")).withColumn("own", own).withColumn(
        "meets", F.when(free, F.col("node")).otherwise(F.xxhash64("node", "own")))
    met = keyed.select("text", "side", "pos", "edits", "own", "meets").join(meeting, "meets")
    same = F.col("letter") == F.col("own")

    def lives(at: Column) -> Column:
        """Whether the child can take the text's letters from a position on, as they are."""
        left = length - at
        fits = _shift("shiftright", F.col("rest"), F.least(left, F.lit(63))).bitwiseAND(F.lit(1)) == 1
        follows = _shift("shiftright", F.col("next"), F.ascii(_letter("text", at)) % 64).bitwiseAND(F.lit(1)) == 1
        return (left >= 0) & fits & ((left == 0) | follows)

    # On the own letter: the way on, and without an edit so far also with the next letter left out; of equal letters the last one.
    # On another letter: it stands for the own one, or it is one more.
    skips = (pos + 1 < length) & (_letter("text", pos + 1) != F.when(pos + 2 < length, _letter("text", pos + 2)).otherwise(F.lit("")))
    marked = met.withColumns({
        "_on": F.when(same, free | lives(pos + 1)).otherwise(free & (pos < length) & lives(pos + 1)),
        "_aside": free & F.when(same, skips & lives(pos + 2)).otherwise(lives(pos)), "_same": same})
    ways = F.array(
        F.struct(F.col("_on").alias("good"), (pos + 1).alias("to"), F.when(F.col("_same"), F.col("edits")).otherwise(1).alias("e")),
        F.struct(F.col("_aside").alias("good"), F.when(F.col("_same"), pos + 2).otherwise(pos).alias("to"), F.lit(1).alias("e")))
    each = marked.where("_on OR _aside").select("text", "side", F.col("child").alias("node"), "ends", F.inline(ways).alias("good", "pos", "edits")).where("good")
    return each.select("text", "side", "pos", "node", "edits", (F.col("ends") & (F.col("pos") == length)).alias("done"))


def near_words(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Pairs (word, near) of words of at most `levels` letters that are one inserted, deleted or replaced letter apart."""
    texts = materialize(sides(words.where(F.length("word") <= levels).select("word")), "trie-texts")
    longest = texts.agg(F.max(F.length("text")).alias("n")).first()["n"] or 0
    edges = materialize(trie_edges(texts), "trie-edges")
    sizes = {r["level"]: r["count"] for r in edges.groupBy("level").count().collect()}  # one row per level
    start = F.col("start")
    here = _node("side", F.substring("text", F.lit(1), start)).alias("node")
    plain = texts.select("text", "side", start.alias("pos"), here, F.lit(0).alias("edits"), F.lit(False).alias("done"), start.alias("level"))
    # The first letter that may be left out. Where nothing follows it, the node may be a word.
    left_out = texts.where(F.coalesce(_letter("text", start) != _letter("text", start + 1), F.lit(False)) & (start < F.length("text")))
    less = left_out.select("text", "side", (start + 1).alias("pos"), here, F.lit(1).alias("edits"), (start + 1 == F.length("text")).alias("done"), start.alias("level"))
    begun = materialize(plain.unionByName(less), "trie-starts")
    pairs = begun.where("done").select("text", "side", "node")
    states = begun.where("false").drop("level")
    for level in range(longest + 1):
        own = _meeting(edges.where(F.col("level") == level))
        few = sizes.get(level, 0) <= SEND_EDGES
        states = states.unionByName(begun.where((F.col("level") == level) & ~F.col("done")).drop("level"))
        # Words with a common beginning meet the same edges: joins of many edges are split where a beginning is hot.
        states = materialize(_step(states, F.broadcast(own) if few else own), f"trie-level-{level + 1}")
        pairs = pairs.unionByName(states.where("edits = 1 AND done").select("text", "side", "node"))
    ends = texts.select(_node("side", F.col("text")).alias("node"), F.col("text").alias("near"))
    both = join_per_key(pairs, ends, ["node"], "inner").where(F.levenshtein("text", "near", 1) == 1)
    turned = [F.when(F.col("side") == 1, F.reverse(c)).otherwise(F.col(c)).alias(name) for c, name in (("text", "word"), ("near", "near"))]
    return both.select(*turned).distinct()


def _rests(words: DataFrame) -> DataFrame:
    """(id, place, rest): hashes of each word without its letter at each place, and of the whole word (place -1)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for row, data, _ in text_blocks(batch.column("word"), 1):  # one word at a time
                n, starts = len(data), np.flatnonzero((data & 0xC0) != 0x80)
                ends = np.append(starts[1:], n)
                up, down = powers(n + 1)
                upto = np.zeros(n + 1, np.uint64)
                np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=upto[1:])
                # What follows the letter moves to the letter's place.
                rest = upto[starts] + (upto[n] - upto[ends]) * down[ends - starts]
                hashes = mix(np.append(rest, upto[n]))
                places = np.append(np.arange(len(starts)), -1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(places), ids[row])), pa.array(places.astype(np.int64)), pa.array(hashes.view(np.int64))],
                    names=["id", "place", "rest"])

    return words.select("id", "word").mapInArrow(scan, "id long, place long, rest long")


def near_long_words(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Pairs (word, near), one of them of more than `levels` letters, that are one edit apart."""
    long = materialize(words.where(F.length("word") >= levels).select(F.xxhash64("word").alias("id"), "word"), "variants-long")
    rests = materialize(_rests(long), "variants-rests")
    less = rests.where("place >= 0")
    other = less.withColumnRenamed("id", "other")
    replaced = less.join(other, ["place", "rest"]).where("id <> other").select("id", "other")
    whole = rests.where("place = -1").select(F.col("id").alias("other"), "rest")
    deleted = less.join(whole, "rest").select("id", "other")
    pairs = replaced.unionByName(deleted).unionByName(deleted.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct()
    both = join_per_key(pairs, long, ["id"], "inner").drop("id")
    both = join_per_key(both, long.select(F.col("id").alias("other"), F.col("word").alias("near")), ["other"], "inner")
    return both.where(F.levenshtein("word", "near", 1) == 1).select("word", "near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last. A form is twice as frequent, so paths are short; each round doubles the steps taken."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = materialize(join_per_key(at, onward, ["root"]), "variants-roots")
        if moved.where("_next IS NOT NULL").isEmpty():
            return at
        at = moved.select("word", F.coalesce("_next", "root").alias("root"))


def spelling_variants(counts: DataFrame, shortest: int = SHORTEST, least: int = LEAST, levels: int = LEVELS) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of (word, n) that are long and frequent enough."""
    words = materialize(counts.where((F.length("word") >= shortest) & (F.col("n") >= least)).select("word", "n"), "variants-words")
    pairs = near_words(words, levels)
    if not words.where(F.length("word") > levels).isEmpty():
        pairs = pairs.unionByName(near_long_words(words, levels)).distinct()
    met = join_per_key(materialize(pairs, "variants-pairs"), words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), ["near"], "inner")
    best = met.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    own = join_per_key(words, best, ["word"])
    good = -F.col("best.less") >= 2 * F.col("n")
    own = materialize(own.select(
        "word", F.when(good, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, -F.col("best.less")).alias("form_n")), "variants-forms")
    ended = join_per_key(own, roots(own.where("form IS NOT NULL")), ["word"])
    return ended.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: One character of a single byte for each letter, as the SQL's distance counts bytes: a-z stay, the others take what is left.
_OTHERS = "".join(chr(c) for c in range(0xC0, 0x100))
_BYTES = "".join(c for c in map(chr, range(33, 127)) if c not in SMALL)[: len(_OTHERS)].replace("'", "''")

SQL = f"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t FROM range(256) AS r(b)
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{RUN}')) AS run FROM documents
), each AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode(id || ':' || run))),
      lambda i: CAST('0x' || substr(hex(encode(id || ':' || run)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS BIGINT) + 1])), 4294967295) AS h FROM each, bits
), vocabulary AS (
  SELECT CASE WHEN h % {EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(n) AS BIGINT) AS n FROM hashed GROUP BY 1
), words AS (
  SELECT word, n, translate(word, '{_OTHERS}', '{_BYTES}') AS bytes FROM vocabulary WHERE length(word) >= {SHORTEST} AND n >= {LEAST}
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM words a JOIN words b
  ON abs(length(a.bytes) - length(b.bytes)) <= 1 AND a.word <> b.word AND levenshtein(a.bytes, b.bytes) = 1
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS here, 0 AS steps FROM formed
  UNION ALL SELECT walk.word, formed.form, steps + 1 FROM walk JOIN formed ON walk.here = formed.word WHERE formed.form IS NOT NULL
)
SELECT word, form, (SELECT arg_max(here, steps) FROM walk WHERE walk.word = formed.word) AS root, n, n_near, form_n FROM formed
"""


@query("op13_spelling_variants", SQL)
def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(word_counts(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")))
