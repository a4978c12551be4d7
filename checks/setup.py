"""Inputs shared by the Spark queries and the SQL texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve import Settings, prepare_session
from clipsieve.settings import DEFAULT_LEXICONS

# Frequent words of the given texts, so that scores are not all zero; "as" is listed twice on purpose.
CHECK_LEXICONS = {
    **DEFAULT_LEXICONS,
    "function_words": {"be_form": ["be", "are", "was"], "preposition": ["as", "by", "at", "as"]},
    "sentiment": {
        "positive": [*DEFAULT_LEXICONS["sentiment"]["positive"], "are", "as"],
        "negative": [*DEFAULT_LEXICONS["sentiment"]["negative"], "was", "by"],
    },
}
# Words left out of cluster keywords in the checks.
CHECK_STOP_WORDS = [
    "be", "are", "was", "as", "by", "at", "not", "from", "have", "he",
    "der", "die", "und", "das", "le", "la", "les", "de", "el", "los",
]
SETTINGS = Settings(run_id="check", lexicons=CHECK_LEXICONS)


# Tables of fewer splits (1 GB at most) are dealt out once, as a small file may be a single row group.
_FEW_SPLITS = 8


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(_FEW_SPLITS) if rows.rdd.getNumPartitions() < _FEW_SPLITS else rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table as posts."""
    prepare_session(spark)
    return as_posts(dealt(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")))


def as_posts(documents: DataFrame) -> DataFrame:
    """Links, handles and inline tags are added to most texts, and the hashtag column cycles through its
    input formats."""
    doc_id, lang, source = F.col("doc_id"), F.col("lang"), F.col("source")
    suffix = F.concat(
        F.lit(" https://v.example/"), doc_id.cast("string"), F.lit(" @"), source, F.lit(" #"), lang
    )
    challenges = (
        F.when(doc_id % 4 == 0, F.concat(F.lit('["#'), lang, F.lit('_life","'), source, F.lit(' tv"]')))
        .when(doc_id % 4 == 1, F.concat(lang, F.lit(", #"), source))
        .when(
            doc_id % 4 == 2,
            F.concat(
                F.lit('[{"title":"'), source, F.lit(' records"},{"name":"'), lang, F.lit('"},7,null]')
            ),
        )
    )
    return documents.select(
        doc_id.cast("string").alias("video_id"),
        source.alias("author_id"),
        (doc_id * 3600 + 1700000000).cast("double").alias("created_at"),
        F.when(doc_id % 10 == 9, F.col("text"))
        .otherwise(F.concat("text", suffix))
        .alias("desc_raw"),
        challenges.alias("challenges_raw"),
        "lang",
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``embeddings`` table as clustered vectors; the given label is the cluster."""
    prepare_session(spark)
    rows = dealt(table(spark, sf_dir, "embeddings"))
    return rows.select(
        F.lit(SETTINGS.run_id).alias("run_id"),
        F.col("vec_id").cast("string").alias("video_id"),
        F.col("label").alias("cluster_id"),
        "embedding",
    )
