"""Language identification with error-correcting output codes.

Each language gets a codeword of bits. For every bit a linear classifier over hashed byte n-grams (1 to 3 bytes, whole
text, ASCII and Latin-1 capitals folded, digits and ASCII punctuation as spaces) tells whether the language's bit is
set. Decoding takes the codeword with the least logistic loss, each bit weighted by how well its classifier does on the
training sample; a document is ambiguous if the best codeword leads the next by too little.

The classifiers are fitted on the driver on a bounded sample: `sample` documents (2,000), the same number of each
language, picked by a hash of doc_id, each as a whole and as a short piece so that short texts are learned too.
Everything else reads all rows. Languages are collected; more than `MOST_LANGUAGES` are refused.

Edge cases: NULL text or text without a letter is `und` with score 0; without any labelled row all are `und`; with one
language all others are that one; rows without doc_id or lang are not learned from; each row is judged by itself, so
repeated rows get the same answer; columns besides doc_id, text and lang are not looked at. Texts are counted in blocks of
at most BLOCK_ROWS, so many short ones take no more memory than a long one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from opticlake.llm.catalog import query
from opticlake.llm.words import text_blocks

DIMS = 4096
BLOCK_ROWS = 256  # most texts whose counts a task holds at a time, 32 KB each
MOST_LANGUAGES = 1000
PIECE = 40  # bytes of the short training pieces
AMBIGUOUS = 0.6  # least score of an unambiguous answer

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32
_LETTER = np.zeros(256, bool)
_LETTER[[b for b in range(128) if chr(b).isalpha()]] = True


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of doc_id, as text, leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def ngram_counts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Counts of hashed n-grams, one row per text, scaled to length 1 after taking roots."""
    n = len(rows) - 1
    folded = _FOLD[data]
    if len(data) > 1:  # capitals of Latin-1 in UTF-8: C3 80 to C3 9E
        folded[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)] += 32
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(rows))
    counts = np.zeros(n * DIMS)
    gram = np.zeros(len(folded), np.uint32)
    for size in (1, 2, 3):
        if len(folded) < size:
            break
        ends = len(folded) - size + 1
        gram = gram[:ends] * np.uint32(257) + folded[size - 1 :] + np.uint32(1)
        slot = (gram * np.uint32(0x9E3779B1) + np.uint32(size)) >> np.uint32(20)
        own = owner[:ends] * DIMS + slot
        whole = owner[:ends] == owner[size - 1 :]
        counts += np.bincount(own[whole], minlength=n * DIMS)
    out = np.sqrt(counts.reshape(n, DIMS)).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def codewords(languages: int, seed: int = 5) -> np.ndarray:
    """One row of +1 and -1 per language: all splits of up to 6 languages, else the best of seeded random codes."""
    if languages <= 6:
        splits = range(1, 1 << (languages - 1))
        bits = [[1 if i == 0 or s >> (i - 1) & 1 == 0 else -1 for s in splits] for i in range(languages)]
        return np.array(bits, np.float32).reshape(languages, -1)
    rng, best, code = np.random.default_rng(seed), -1, None
    for _ in range(50):
        tried = rng.choice(np.array([-1, 1], np.float32), (languages, 4 * int(np.ceil(np.log2(languages))) + 8))
        apart = int(min(((tried[i] != tried[i + 1 :]).sum(1).min() for i in range(languages - 1)), default=0))
        usable = (np.abs(tried.sum(0)) < languages).all()
        if usable and apart > best:
            best, code = apart, tried
    return code


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # DIMS + 1 x bits
    trust: np.ndarray  # weight of each bit

    def decode(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest language and its score, from 0 to 1."""
        if len(self.languages) == 1:
            return np.zeros(len(features), np.int64), np.ones(len(features))
        margins = (features @ self.weights[:-1] + self.weights[-1]).astype(np.float64)
        loss = np.stack([(np.logaddexp(0, -word * margins) * self.trust).sum(1) for word in self.code], 1)
        near = np.exp(loss.min(1, keepdims=True) - loss)
        return loss.argmin(1), 1 / near.sum(1)


def fit(features: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 5, epochs: int = 12) -> Model:
    """Logistic classifiers of all bits at once, by seeded mini-batches with adaptive steps."""
    code = codewords(len(languages))
    bits = code.shape[1]
    target = code[labels]
    weights = np.zeros((DIMS + 1, bits), np.float32)

    def rows(own: np.ndarray) -> np.ndarray:
        """A batch with a constant; only batches are held as floats."""
        return np.hstack([features[own].astype(np.float32), np.ones((len(own), 1), np.float32)])

    squares = np.full_like(weights, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs if bits else 0):
        order = rng.permutation(len(features))
        for at in range(0, len(order), 32):
            own = order[at : at + 32]
            x = rows(own)
            pull = -target[own] / (1 + np.exp(target[own] * (x @ weights)))
            slope = x.T @ pull / len(own) + 1e-5 * weights
            squares += slope * slope
            weights -= 0.5 * slope / np.sqrt(squares)
    right = np.ones(bits)
    if bits and len(features):
        parts = np.array_split(np.arange(len(features)), -(-len(features) // 256))
        right = sum(((rows(own) @ weights) * target[own] > 0).sum(0) for own in parts) / len(features)
    trust = np.clip(2 * right - 1, 0.05, 1.0).astype(np.float64)
    return Model(languages, code, weights, trust)


def train(docs: DataFrame, sample: int = 2000) -> Model | None:
    """A model from rows of (doc_id, text, lang); NULL doc_id, text or lang is left out."""
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return None
    languages = sorted(counts)
    each = max(1, sample // len(languages))
    # A hash keeps somewhat more than enough rows before the exact choice, so that few texts are moved.
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, 2 * each / counts[lang] + 0.01))])
    picked = known.withColumn("_h", F.xxhash64("doc_id")).where(F.pmod("_h", F.lit(1_000_000)) < F.element_at(shares, F.col("lang")) * 1_000_000)
    order = Window.partitionBy("lang").orderBy("_h", "doc_id")
    picked = picked.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= each).select("lang", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, rows in text_blocks(batch.column("text"), most_rows=BLOCK_ROWS):
                middle = (rows[:-1] + rows[1:] - min(PIECE, len(data))) // 2
                start = np.maximum(middle, rows[:-1])
                end = np.minimum(start + PIECE, rows[1:])
                pieces = np.concatenate([data[s:e] for s, e in zip(start, end, strict=True)])
                short = np.concatenate([[0], np.cumsum(end - start)])
                langs = batch.column("lang").to_pylist()[at : at + len(rows) - 1]
                for held in (ngram_counts(data, rows), ngram_counts(pieces, short)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(langs), pa.array([r.tobytes() for r in held.astype(np.float16)])], names=["lang", "features"])

    rows = picked.mapInArrow(features, "lang string, features binary").toArrow()
    if not rows.num_rows:
        return None
    # Sorted, so that the order in which the rows came in does not matter. The numbers stay in one Arrow buffer: a bytes object
    # for each row would leave the driver's memory in pieces.
    rows = rows.sort_by([("lang", "ascending"), ("features", "ascending")])
    y = np.searchsorted(languages, rows["lang"].to_numpy())
    packed = rows["features"].combine_chunks()
    del rows
    first = packed.offset * DIMS
    model = fit(np.frombuffer(packed.buffers()[2], np.float16)[first : first + len(packed) * DIMS].reshape(-1, DIMS), y, languages)
    del packed
    pa.default_memory_pool().release_unused()
    return model


def identify(docs: DataFrame, model: Model | None, names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """All rows with lang_pred, score and ambiguous, or other names for them; columns of docs with such a name are replaced."""

    def has_letter(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
        plain = np.concatenate([[0], np.cumsum(_LETTER[data])])
        found = plain[rows[1:]] > plain[rows[:-1]]
        for i in np.flatnonzero(~found & (np.diff(rows) > 0)):
            found[i] = any(c.isalpha() for c in data[rows[i] : rows[i + 1]].tobytes().decode("utf-8", "replace"))
        return found

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs: list[str] = []
            scores: list[float] = []
            for _, data, rows in text_blocks(batch.column("text"), most_rows=BLOCK_ROWS):
                letters = has_letter(data, rows)
                if model is None:
                    letters[:] = False
                best, score = np.zeros(len(letters), np.int64), np.zeros(len(letters))
                if letters.any():
                    best, score = model.decode(ngram_counts(data, rows))
                langs += [model.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
                scores += np.where(letters, score, 0.0).tolist()
            columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {
                names[0]: pa.array(langs, pa.string()), names[1]: pa.array(scores, pa.float64()),
                names[2]: pa.array([s < AMBIGUOUS for s in scores], pa.bool_()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = docs.drop(*names)
    added = [T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.BooleanType()), strict=True)]
    return rows.mapInArrow(predict, T.StructType([*rows.schema.fields, *added]))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model).drop("text")
