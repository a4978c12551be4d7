"""TF-IDF: one weighting over all posts, and a separate one inside every cluster.

Raw counts, ``idf = ln((1 + n) / (1 + df)) + 1``, rows scaled to length 1; the vocabulary is the
``max_terms`` terms with the largest total counts, ties by term.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipsieve.functions import text
from clipsieve.functions.arrays import is_any_of
from clipsieve.operators import heavy
from clipsieve.operators.ranking import top_n
from clipsieve.session import deal_out, materialize
from clipsieve.settings import Settings

KEYWORD_LIMIT = 15
# A space-separated word and its immediate repetitions.
_RUN = r"(?<![^ ])([^ ]+)(?: \1(?![^ ]))*"
# Scores are compared at this many decimals, so that the order in which partial sums are added
# cannot change the ranking of equal terms.
_SCORE_DECIMALS = 10


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def _idf(documents: Column, document_frequency: Column) -> Column:
    return F.log((documents + 1) / (document_frequency + 1)) + 1


def _first_terms() -> list[Column]:
    return [F.desc("total"), F.asc("term")]


def vocabulary(evidence: DataFrame, settings: Settings) -> DataFrame:
    """``term, total, df``: at most ``max_terms`` rows over all topic texts.

    Every text is followed by its distinct terms: occurrences give the totals and distinct terms the
    document frequencies, in one pass and one map-side sum. So a very frequent term sends one partial
    sum per task. With ``settings.summary_values`` a summary chooses the terms that can be among the first, if
    it can prove them, and only these are counted; the rows are the same.
    """
    found = evidence.select(text.terms(F.col("topic_text")).alias("_terms"))
    listed = found.select(
        F.size("_terms").alias("_n"),
        F.posexplode_outer(F.concat("_terms", F.array_distinct("_terms"))).alias("_pos", "term"),
    )
    occurrence = F.col("_pos") < F.col("_n")
    listed = listed.filter(F.col("term").isNotNull())
    if settings.summary_values:
        values = listed.filter(occurrence).select(F.col("term").alias("value"))
        chosen = heavy.candidates(values, settings.max_terms, settings.summary_values)
        if chosen is not None:
            listed = listed.join(chosen, listed["term"] == chosen["value"], "left_semi")
    return (
        listed.groupBy("term")
        .agg(F.count_if(occurrence).alias("total"), F.count_if(~occurrence).alias("df"))
        .orderBy(*_first_terms())
        .limit(settings.max_terms)
    )


def tfidf_vectors(evidence: DataFrame, settings: Settings) -> tuple[DataFrame, list[str]]:
    """Sparse unit vectors ``run_id, video_id, indices, values`` and the alphabetical vocabulary.

    Two passes: the vocabulary (at most ``max_terms`` rows come to the driver), then a narrow
    transformation of every row. A post without a known term has empty arrays.
    """
    documents = evidence.count()
    rows = sorted(vocabulary(evidence, settings).collect(), key=lambda row: row["term"])
    names = [row["term"] for row in rows]
    if not names:
        none = F.array()
        empty = evidence.select(
            "run_id",
            "video_id",
            none.cast("array<int>").alias("indices"),
            none.cast("array<double>").alias("values"),
        )
        return empty, names
    idf = [math.log((1 + documents) / (1 + row["df"])) + 1 for row in rows]
    tokens = evidence.select("run_id", "video_id", text.terms(F.col("topic_text")).alias("_terms"))
    counted = CountVectorizerModel.from_vocabulary(names, inputCol="_terms", outputCol="_counts")
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_counts", outputCol="_scaled")
    unit = Normalizer(p=2.0, inputCol="_scaled", outputCol="_unit")
    vectors = unit.transform(scaled.transform(counted.transform(tokens)))
    sparse = F.unwrap_udt("_unit")
    return (
        vectors.select(
            "run_id",
            "video_id",
            sparse["indices"].alias("indices"),
            sparse["values"].alias("values"),
        ),
        names,
    )


def _term_runs(source: Column) -> Column:
    """Each distinct term of a text, repeated as often as it occurs: "car", "race race", …

    Terms hold no spaces, so equal neighbours of the sorted terms are found by a back reference. This
    counts inside the row with compiled functions only.
    """
    ordered = F.array_join(F.sort_array(text.terms(source)), " ")
    return F.regexp_extract_all(ordered, F.lit(_RUN), F.lit(0))


def _cluster_terms(texts: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """``cluster_id, video_id, view, term, n`` of the description and hashtag texts, in one pass."""
    counted = texts.select(
        "cluster_id",
        "video_id",
        _term_runs(F.col("topic_text")).alias("_desc"),
        _term_runs(F.array_join("hashtags_list_norm", " ")).alias("_tags"),
    )
    listed = counted.select(
        "cluster_id",
        "video_id",
        F.size("_desc").alias("_first_tag"),
        F.posexplode_outer(F.concat("_desc", "_tags")).alias("_pos", "_run"),
    ).filter(F.col("_run").isNotNull())
    terms = listed.select(
        "cluster_id",
        "video_id",
        F.when(F.col("_pos") < F.col("_first_tag"), F.lit("desc")).otherwise(F.lit("hashtags")).alias("view"),
        F.substring_index("_run", " ", 1).alias("term"),
        (F.length("_run") + 1).alias("_length"),
    )
    times = (F.col("_length") / (F.length("term") + 1)).cast("bigint")
    return terms.filter(~is_any_of(F.col("term"), stop_words)).select(
        "cluster_id", "video_id", "view", "term", times.alias("n")
    )


def cluster_keywords(
    texts: DataFrame, settings: Settings, stop_words: Sequence[str], limit: int = KEYWORD_LIMIT
) -> DataFrame:
    """``cluster_id, view, rank, term, score``: the best mean weights of each cluster and view.

    ``texts`` has one row per member: ``cluster_id, video_id, topic_text, hashtags_list_norm``. Nothing
    is gathered per cluster: terms are counted with partial sums, the vocabulary (at most
    ``max_terms`` per cluster and view) is written once and joined back, and the length of a
    document is a window over that document only. The weighing pass deals texts out by ``video_id`` before
    they become terms, so the window finds its rows in place.
    """
    terms = _cluster_terms(texts, stop_words)
    sizes = texts.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("documents"))
    counted = terms.groupBy("cluster_id", "view", "term").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("df")
    )
    known = (
        top_n(counted, ["cluster_id", "view"], _first_terms(), settings.max_terms)
        .join(sizes, "cluster_id")
        .select(
            "cluster_id",
            "view",
            "term",
            "documents",
            _idf(F.col("documents"), F.col("df")).alias("idf"),
        )
    )
    known = materialize(known)
    dealt = _cluster_terms(deal_out(texts, "video_id"), stop_words)
    weighted = dealt.join(known, ["cluster_id", "view", "term"]).withColumn(
        "weight", F.col("n") * F.col("idf")
    )
    square = F.col("weight") * F.col("weight")
    document = Window.partitionBy("video_id")
    desc_norm = F.sum(F.when(F.col("view") == "desc", square)).over(document)
    tags_norm = F.sum(F.when(F.col("view") == "hashtags", square)).over(document)
    length = F.sqrt(F.when(F.col("view") == "desc", desc_norm).otherwise(tags_norm))
    scores = (
        weighted.select("cluster_id", "view", "term", "documents", (F.col("weight") / length).alias("unit"))
        .groupBy("cluster_id", "view", "term")
        .agg((F.sum("unit") / F.first("documents")).alias("score"))
        .withColumn("score", F.round("score", _SCORE_DECIMALS))
    )
    return top_n(scores, ["cluster_id", "view"], [F.desc("score"), F.asc("term")], limit)


def keyword_lists(keywords: DataFrame) -> DataFrame:
    """One row per cluster with both ranked lists and their overlap (Jaccard; 0 if one is empty)."""

    def ranked(view: str) -> Column:
        # At most KEYWORD_LIMIT items per cluster and view.
        rows = F.collect_list(F.when(F.col("view") == view, F.struct("rank", "term", "score")))
        return F.transform(
            F.array_sort(rows), lambda item: F.struct(item["term"].alias("term"), item["score"].alias("score"))
        )

    desc = F.transform("keywords_desc", lambda item: item["term"])
    tags = F.transform("keywords_hashtags", lambda item: item["term"])
    shared = F.size(F.array_intersect(desc, tags)) / F.greatest(
        F.size(F.array_union(desc, tags)), F.lit(1)
    )
    return (
        keywords.groupBy("cluster_id")
        .agg(ranked("desc").alias("keywords_desc"), ranked("hashtags").alias("keywords_hashtags"))
        .withColumn("keyword_congruence", shared)
    )
