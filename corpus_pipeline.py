"""Documents to a training mix: language, near copies, benchmark leaks, personal data, source weights.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame; its result is written as Parquet and read
again as the next one's documents. All stages but the last keep the columns of documents, whatever they are called.

Edge cases: a NULL or empty text has no language and goes in the first stage, as does an ambiguous one; of rows that share a
doc_id the near-duplicate stage keeps one, rows without a doc_id stay there; a text of the benchmark goes whether or not it
has a doc_id; n_chars follows the redacted text where there is such a column; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opticlake.llm.catalog import fresh, prepare
from opticlake.llm.decontaminate import without_leaks
from opticlake.llm.jaccard import first_of_each
from opticlake.llm.langid import identify
from opticlake.llm.langid import train as train_languages
from opticlake.llm.mixing import mix_documents
from opticlake.llm.pii import redact
from opticlake.llm.pii import train as train_pii
from opticlake.session import materialize, passing

#: The least score of a document that the language stage keeps.
LEAST_SCORE = 0.4


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without a letter, or with no language clearly nearest, go."""
    prepare(spark)
    lang, score, ambiguous = (fresh(n, docs.columns) for n in ("lang_pred", "score", "ambiguous"))
    judged = identify(docs, train_languages(docs), (lang, score, ambiguous))
    return judged.where((F.col(lang) != "und") & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    prepare(spark)
    return first_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    prepare(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars is that of the new text."""
    prepare(spark)
    clean = redact(docs, train_pii(docs))
    counted = {c: F.length("text").cast(t) for c, t in docs.dtypes if c.lower() == "n_chars"}
    return clean.withColumns(counted).select(*docs.columns) if counted else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents and epochs taken for the target weights, with their texts."""
    prepare(spark)
    return mix_documents(docs, docs.columns)


STAGES = [
    ("language_id", keep_languages), ("near_duplicates", keep_one_of_each), ("decontamination", drop_leaks),
    ("personal_data", redact_pii), ("mixing", mix),
]

#: Classifiers and similarity joins have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        if number == len(STAGES) - 1:
            return stage(spark, docs, sf_dir)
        with passing(spark, f"stage-{name}"):
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
