"""From raw documents to packed token sequences: five stages, each on all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``. ``n_chars`` follows the text where a stage changes it.

Null texts and texts without a letter go in the first stage. Nulls in other columns, repeated rows and further
columns are kept by every stage that does not say otherwise; an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve.llm import language, packing, pii, simhash, suffix_dedup
from clipsieve.llm.queries import WORD_VOCABULARY, held_out
from clipsieve.llm.stages import write_stage
from clipsieve.session import prepare_session


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; the model learns from the labelled four fifths of them."""
    return language.keep_identified(docs, language.fit(docs.where(~held_out())))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings that an earlier text has. What is left of a cut character goes with it."""
    found = suffix_dedup.remove_repeats(docs)
    columns = [F.col("text" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns]
    text = F.when(F.col("row.text").isNotNull(), F.col("kept_text"))
    return _with_length(found.withColumn("text", text).select(*columns))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _with_length(pii.mask(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of 4,096 tokens, every source at its share in each of them."""
    return packing.pack(docs, WORD_VOCABULARY)


STAGES = [
    ("language", keep_languages),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; they are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    prepare_session(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
