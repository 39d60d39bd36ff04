"""Benchmark decontamination by template canonicalisation.

Words lose outer punctuation and case. Windows of 13 words (the whole item where it is shorter, 5 words at least) of all
documents are joined with those of the benchmark on hash and text, so a passage is found whatever its capitals and line
breaks. Words also become a template: a word with a digit is <num>, a unit after a number <unit>, a capitalised word
<name>; other words stay. A capitalised word that opens a sentence is read both as a word and as a name. Windows of
template words are joined in the same way. Those whose slots hold other values than the item's must be consistent along a
diagonal of document and item: one value in the item always stands for one value in the document, and two names never for
the same one; where openers read as names are not, the windows without them still may be. So a question with other
numbers, names or units is found, and a text that merely has the same shape of slots is not: windows of a template need 7
literal words of 13, among which openers count that are the same. Windows that agree in every word always count, whatever
the others of their diagonal hold.

Benchmark windows go to the tasks in blocks of at most `block` hashes (8 bytes each), one pass over the documents per
block; they only preselect the document windows that enter the join.

Edge cases: NULL and empty texts have no windows; items under 5 words find nothing; rows that share a doc_id or item_id
are taken as one text said several times, so repeated rows change nothing; rows with a NULL doc_id or item_id take no part
in `find_leaks`, as nothing could name them, but `without_leaks` looks at their texts too; empty tables give no rows;
further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opticlake.llm.catalog import fresh, query
from opticlake.llm.words import LOWER, run_hashes, span_hashes, text_blocks, word_spans
from opticlake.session import materialize

WINDOW, SHORTEST = 13, 5
BLOCK = 1_000_000
UNITS = """
mm cm dm m km in ft yd mi mile miles mg g kg t lb lbs oz ton tons ml cl l litre litres liter liters gallon gallons
s sec secs second seconds min mins minute minutes h hour hours day days week weeks month months year years
percent degree degrees euro euros dollar dollars cent cents pound pounds eur usd gbp kmh mph w kw v a hz khz mhz ghz
meter meters metre metres stunde stunden tag tage jahr jahre heure heures jour jours hora horas
""".split()

_CORE = np.zeros(256, bool)
_CORE[[b for b in range(128) if chr(b).isalnum()]] = True
_CORE[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?:"]] = True
#: Kinds of words; a capitalised word that opens a sentence and is read as a name has a kind of its own.
_NAME, _OPENER = 3, 4
_SLOTS = {1: "<num>", 2: "<unit>", _NAME: "<name>", _OPENER: "<name>"}


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return span_hashes(data, np.concatenate([[0], ends[:-1]]), ends)


_UNIT_HASHES = np.sort(_hash_words(UNITS))
_SLOT_HASHES = _hash_words([f"\x00{i}" for i in (0, 1, 2, _NAME, _NAME)])


def _among(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(held):
        return np.zeros(len(values), bool)
    at = np.searchsorted(held, values)
    at[at == len(held)] = 0
    return held[at] == values


def _folded_words(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts with all case folded, and start and end of each word in them without outer punctuation.

    Folding keeps letters letters and separators separators, so there are as many words as in the texts themselves.
    """
    raw = data.tobytes()
    if raw.isascii():
        data = LOWER[data]
    else:
        texts = [raw[a:b].decode("utf-8", "replace").casefold().encode() for a, b in zip(rows[:-1], rows[1:], strict=True)]
        data = np.frombuffer(b"".join(texts), np.uint8)
        rows = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    starts, ends, _ = word_spans(data, rows)
    core = np.flatnonzero(_CORE[data])
    if not len(core):
        return data, starts[:0], ends[:0]
    low, high = np.searchsorted(core, starts), np.searchsorted(core, ends)
    held = high > low
    return data, core[low[held]], core[high[held] - 1] + 1


def _least(size):
    """Literal words that a window with changed slots needs."""
    return (size + 2) // 2


class Templates:
    """Words of a block of texts, as they are and as a template."""

    def __init__(self, data: np.ndarray, rows: np.ndarray, quoted: bool = False):
        """quoted: whether there are further readings, for texts that are quoted within a sentence."""
        starts, ends, first = word_spans(data, rows)
        core = np.flatnonzero(_CORE[data])
        if not len(core):
            starts, ends = starts[:0], ends[:0]
        low = np.searchsorted(core, starts)
        high = np.searchsorted(core, ends)
        held = high > low
        owner = np.repeat(np.arange(len(rows) - 1), np.diff(first)) if len(starts) else np.zeros(0, np.int64)
        opens = np.ones(len(starts), bool)  # starts a sentence
        if len(starts) > 1:
            opens[1:] = _ENDS[data[ends[:-1] - 1]] | (data[starts[1:] - 1] == 10) | (owner[1:] != owner[:-1])
        owner, opens = owner[held], opens[held]
        starts, ends = (core[low[held]], core[high[held] - 1] + 1) if len(core) else (starts, ends)
        lower = LOWER[data]
        folds = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1  # capitals of Latin-1
        lower[folds] += 32
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        head = data[starts] if len(starts) else np.zeros(0, np.uint8)
        capital = (head != lower[starts]) if len(starts) else np.zeros(0, bool)
        if len(starts):
            after = starts + (head == 0xC3)
            capital |= data[after] != lower[after]
        self.data, self.starts, self.ends = _folded_words(data, rows)
        words = span_hashes(self.data, self.starts, self.ends)
        names = np.where(capital, np.where(opens, _OPENER, _NAME), 0).astype(np.int8)
        fixed = np.zeros(len(starts), np.int8)
        number = digits[ends] > digits[starts] if len(starts) else np.zeros(0, bool)
        fixed[number] = 1
        fixed[1:][number[:-1] & ~number[1:] & (owner[1:] == owner[:-1]) & _among(words[1:], _UNIT_HASHES)] = 2
        inner = np.where(names == _OPENER, 0, names)
        readings = [inner, names]
        if quoted:
            head = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(starts) else capital
            readings += [np.where(head, names, inner), np.where(head, 0, names)]
        #: Kinds of words in each reading: all words as they are, then templates.
        self.kinds = [np.zeros(len(starts), np.int8), *[np.where(fixed > 0, fixed, r) for r in readings]]
        self.hashes = [np.where(k > 0, _SLOT_HASHES[k], words) for k in self.kinds]
        self.first = np.searchsorted(owner, np.arange(len(rows)))
        self.owner = owner

    def windows(self, size: int, reading: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each window within one text; that of a template has a slot, an opener after the first."""
        hashes = run_hashes(self.hashes[reading], size)
        n = len(hashes)
        if not n:
            return np.zeros(0, np.int64), hashes
        good = self.owner[:n] == self.owner[size - 1 :]
        if reading:
            slot = np.concatenate([[0], np.cumsum(self.kinds[reading] > 0 if reading == 1 else self.kinds[reading] == _OPENER)])
            good &= slot[size:] > slot[:n]
        at = np.flatnonzero(good)
        return at, hashes[at]

    def enough(self, at: np.ndarray, size: int, reading: int) -> np.ndarray:
        """Which windows have literal words enough to count with changed slots, if no opener changes."""
        literal = np.concatenate([[0], np.cumsum(np.isin(self.kinds[reading], (0, _OPENER)))])
        return literal[at + size] - literal[at] >= _least(size)

    def describe(self, at: int, size: int, reading: int) -> tuple[str, list[int], list[str]]:
        """Text of a window in a reading, and the kinds and values of its slots."""
        words = [self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace") for i in range(at, at + size)]
        kinds = self.kinds[reading][at : at + size].tolist()
        return (" ".join(_SLOTS.get(k, w) for k, w in zip(kinds, words, strict=True)), [k for k in kinds if k],
                [w for k, w in zip(kinds, words, strict=True) if k])


_SCHEMA = "{id} long, size int, hash long, pos long, template string, kinds array<int>, slots array<string>"
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string())]


def _batch(name: str, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _TYPES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)],
                                      names=[name, "size", "hash", "pos", "template", "kinds", "slots"])


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per window of each item: item_id, size, hash, pos, template, kinds, slots.

    A document may quote an item within a sentence, so its first word has the other reading as well, whatever its other openers are.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for at, data, rows in text_blocks(batch.column("text")):
                for i in range(len(rows) - 1):
                    text = Templates(data[rows[i] : rows[i + 1]], np.array([0, rows[i + 1] - rows[i]]), quoted=True)
                    size = min(window, len(text.starts))
                    for reading in range(len(text.kinds) if size >= SHORTEST else 0):
                        places, own = text.windows(size, reading)
                        good = text.enough(places, size, reading)
                        yield _batch("item_id", [
                            (ids[at + i], size, int(h.view(np.int64)), int(p), *text.describe(int(p), size, reading))
                            for p, h in zip(places[good], own[good], strict=True)])

    return items.where("item_id IS NOT NULL").select("item_id", "text").mapInArrow(cut, _SCHEMA.format(id="item_id"))


def _document_windows(docs: DataFrame, wanted: dict[int, np.ndarray]) -> DataFrame:
    """The windows of documents whose hash is wanted, by size of window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at, data, rows in text_blocks(batch.column("text")):
                texts = Templates(data, rows)
                for size, hashes in wanted.items():
                    for reading in range(len(texts.kinds)):
                        places, own = texts.windows(size, reading)
                        hit = _among(own, hashes)
                        for some in np.array_split(np.flatnonzero(hit), max(1, int(hit.sum()) // 5000)):
                            yield _batch("doc_id", [
                                (ids[at + int(texts.owner[p])], size, int(h.view(np.int64)), int(p - texts.first[texts.owner[p]]),
                                 *texts.describe(int(p), size, reading)) for p, h in zip(places[some], own[some], strict=True)])

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(cut, _SCHEMA.format(id="doc_id"))


def _blocks(windows: DataFrame, block: int) -> Iterator[dict[int, np.ndarray]]:
    """Hashes by size of window, at most `block` at a time."""
    hashes = windows.select("size", "hash").distinct()
    parts = max(1, -(-hashes.count() // block) * 2 - 1) if not windows.isEmpty() else 0
    for i in range(parts):
        rows = hashes.where(F.pmod("hash", F.lit(parts)) == i).toArrow()
        size, held = rows["size"].to_numpy(), rows["hash"].to_numpy().view(np.uint64)
        if len(size):
            yield {int(s): np.sort(held[size == s]) for s in np.unique(size)}


def _consistent(pairs: Column) -> Column:
    """Whether one item value stands for one document value, and names also the other way round."""
    seen = F.array_distinct(pairs)
    left = F.array_distinct(F.transform(seen, lambda p: F.struct(p["kind"], p["want"])))
    names = F.filter(seen, lambda p: p["kind"] == 3)
    return (F.size(left) == F.size(seen)) & (F.size(F.array_distinct(F.transform(names, lambda p: p["found"]))) == F.size(names))


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per document and item that it holds windows of: doc_id, item_id, n_windows, n_changed (slot values)."""
    held = materialize(benchmark_windows(items, window).dropDuplicates(["item_id", "hash", "pos", "template", "kinds", "slots"]), "benchmark-windows")
    found = None
    for wanted in _blocks(held, block):
        part = _document_windows(docs, wanted)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = _document_windows(docs, {})
    theirs = held.select("item_id", "hash", "template", F.col("pos").alias("_pos"), F.col("kinds").alias("_kinds"), F.col("slots").alias("_slots"))
    both = found.join(theirs, ["hash", "template"])
    zipped = F.arrays_zip("_kinds", "_slots", "slots")
    openers = F.filter(zipped, lambda p: (p["_kinds"] == _OPENER) & (p["_slots"] == p["slots"]))
    pairs = F.transform(zipped, lambda p: F.struct(
        F.least(p["_kinds"], F.lit(_NAME)).alias("kind"), p["_slots"].alias("want"), p["slots"].alias("found")))
    lines = both.select(
        "doc_id", "item_id", (F.col("pos") - F.col("_pos")).alias("diagonal"), "_pos", pairs.alias("pairs"),
        (F.array_contains("_kinds", _OPENER) | F.array_contains("kinds", _OPENER)).alias("opens"),
        (F.col("size") - F.size("slots") + F.size(openers) >= F.floor((F.col("size") + 2) / 2)).alias("enough"),
        F.exists(F.zip_with("_slots", "slots", lambda a, b: a != b), lambda p: p).alias("changed"),
    ).where("enough OR NOT changed")
    # Slots repeat in overlapping windows: each distinct pair of a diagonal is kept once, at most as many as an item has words.
    plain = F.col("changed") & ~F.col("opens")
    per = lines.groupBy("doc_id", "item_id", "diagonal").agg(
        F.count_distinct("_pos").alias("n_all"), F.count_distinct(F.when(~F.col("changed"), F.col("_pos"))).alias("n_same"),
        F.count_distinct(F.when(plain | ~F.col("changed"), F.col("_pos"))).alias("n_plain"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.col("changed"), F.col("pairs"))))).alias("pairs"),
        F.array_distinct(F.flatten(F.collect_set(F.when(plain, F.col("pairs"))))).alias("plain"))

    def first_that_fits(every: Column, without_openers: Column, same: Column) -> Column:
        return F.when(_consistent(F.col("pairs")), every).when(_consistent(F.col("plain")), without_openers).otherwise(same).cast("long")

    def changes(name: str) -> Column:
        return F.size(F.filter(name, lambda p: p["want"] != p["found"]))

    good = per.select(
        "doc_id", "item_id", first_that_fits(F.col("n_all"), F.col("n_plain"), F.col("n_same")).alias("n_windows"),
        first_that_fits(changes("pairs"), changes("plain"), F.lit(0)).alias("n_changed")).where("n_windows > 0")
    return good.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.min("n_changed").alias("n_changed"))


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which nothing of the benchmark is found, all columns; texts without a doc_id are known by their hash."""
    leaks = materialize(find_leaks(docs, items).select("doc_id").distinct(), "leaks")
    named = docs.where("doc_id IS NOT NULL").join(leaks, "doc_id", "left_anti").select(*docs.columns)
    nameless = docs.where("doc_id IS NULL")
    if nameless.isEmpty():
        return named
    hashed = F.xxhash64("text")
    found = find_leaks(nameless.select(hashed.alias("doc_id"), "text"), items).select("doc_id").distinct()
    key = fresh("text_hash", docs.columns)
    texts = materialize(found.withColumnRenamed("doc_id", key), "leaks-nameless")
    return named.unionByName(nameless.withColumn(key, hashed).join(texts, key, "left_anti").select(*docs.columns))


@query("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return find_leaks(docs, spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text"))
