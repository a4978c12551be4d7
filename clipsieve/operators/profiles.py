"""What a cluster is about: keywords, anchors, samples and trust rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsieve.functions.vectors import ratio
from clipsieve.operators.ranking import top_n
from clipsieve.operators.tfidf import cluster_keywords, default_stop_words, keyword_lists
from clipsieve.session import deal_out, materialize
from clipsieve.settings import Settings

ANCHOR_LIMIT = 10
SAMPLE_LIMIT = 20
MIN_ANCHOR_SHARE = 0.05


def cluster_size(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))


def cluster_texts(clusters: DataFrame, evidence: DataFrame) -> DataFrame:
    """Members with their topic text and normalised tags. Members without evidence drop out; a run reports
    the number that ``missing_evidence`` gives."""
    texts = evidence.select("video_id", "topic_text", "hashtags_list_norm")
    return clusters.select("video_id", "cluster_id").join(texts, "video_id")


def missing_evidence(clusters: DataFrame, evidence: DataFrame) -> DataFrame:
    return (
        clusters.select("video_id")
        .join(evidence.select("video_id"), "video_id", "left_anti")
        .agg(F.count(F.lit(1)).alias("missing"))
    )


def median_topic_length(texts: DataFrame) -> DataFrame:
    """``cluster_id, median_topic_length`` in words; an empty text has none.

    The exact median's state holds one count per distinct length, which text length bounds.
    """
    words = F.size(F.filter(F.split("topic_text", " "), lambda word: word != ""))
    return texts.groupBy("cluster_id").agg(F.median(words).cast("double").alias("median_topic_length"))


def anchors(clusters: DataFrame, mentions: DataFrame, limit: int = ANCHOR_LIMIT) -> DataFrame:
    """``cluster_id, type, rank, entity, support, coverage``: most mentioned entities per type.

    Coverage is mentions per member and may exceed 1. Ties go by entity.
    """
    members = clusters.select("video_id", "cluster_id")
    counted = (
        mentions.select("video_id", F.col("entity_type").alias("type"), F.col("entity_canon").alias("entity"))
        .join(members, "video_id")
        .groupBy("cluster_id", "type", "entity")
        .agg(F.count(F.lit(1)).alias("support"))
    )
    best = top_n(counted, ["cluster_id", "type"], [F.desc("support"), F.asc("entity")], limit)
    return best.join(cluster_size(clusters), "cluster_id").select(
        "cluster_id",
        "type",
        "rank",
        "entity",
        "support",
        ratio(F.col("support"), F.col("size")).alias("coverage"),
    )


def anchored_members(clusters: DataFrame, mentions: DataFrame) -> DataFrame:
    """Members that have at least one mention."""
    return clusters.select("video_id", "cluster_id").join(
        mentions.select("video_id"), "video_id", "left_semi"
    )


def anchor_quality(clusters: DataFrame, mentions: DataFrame, listed: DataFrame) -> DataFrame:
    """``cluster_id, anchor_coverage, anchor_garbage_rate``; both are 0 where nothing was found."""
    with_anchor = anchored_members(clusters, mentions).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("_anchored")
    )
    weak = F.when(F.col("coverage") < MIN_ANCHOR_SHARE, 1.0).otherwise(0.0)
    garbage = listed.groupBy("cluster_id").agg(F.avg(weak).alias("_garbage"))
    return (
        cluster_size(clusters)
        .join(with_anchor, "cluster_id", "left")
        .join(garbage, "cluster_id", "left")
        .select(
            "cluster_id",
            ratio(F.col("_anchored"), F.col("size")).alias("anchor_coverage"),
            F.coalesce("_garbage", F.lit(0.0)).alias("anchor_garbage_rate"),
        )
    )


def anchors_by_type(listed: DataFrame) -> DataFrame:
    """One row per cluster: a map from type to its ranked anchors (at most ``ANCHOR_LIMIT`` each)."""
    item = F.struct("rank", "entity", "coverage", "support", "type")
    ranked = F.transform(
        F.array_sort(F.collect_list(item)),
        lambda anchor: F.struct(
            anchor["entity"].alias("entity"),
            anchor["coverage"].alias("coverage"),
            anchor["support"].alias("support"),
            anchor["type"].alias("type"),
        ),
    )
    per_type = listed.groupBy("cluster_id", "type").agg(ranked.alias("_anchors"))
    return per_type.groupBy("cluster_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "_anchors")))).alias(
            "anchors_by_type"
        )
    )


def sample_rows(clusters: DataFrame, limit: int = SAMPLE_LIMIT) -> DataFrame:
    """``cluster_id, video_id, rank``: the first ids of every cluster in id order."""
    return top_n(clusters.select("cluster_id", "video_id"), ["cluster_id"], [F.asc("video_id")], limit)


def sample_ids(clusters: DataFrame, limit: int = SAMPLE_LIMIT) -> DataFrame:
    return (
        sample_rows(clusters, limit)
        .groupBy("cluster_id")
        .agg(F.sort_array(F.collect_list("video_id")).alias("sample_video_ids"))
    )


def build_profiles(
    evidence: DataFrame,
    clusters: DataFrame,
    metrics: DataFrame,
    mentions: DataFrame,
    settings: Settings,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """One row per cluster. Every part is aggregated before it is joined, so the joins see one row
    per cluster and side."""
    words = default_stop_words() if stop_words is None else stop_words
    # Joined once; the vocabulary, the weights and the text lengths are all taken from what is written. Dealt out
    # without a key: by that of the join, the planner would leave the rows where the join put them.
    texts = materialize(deal_out(cluster_texts(clusters, evidence)))
    listed = anchors(clusters, mentions)
    parts = [
        metrics.select(
            "cluster_id",
            "coherence",
            F.col("pct_insufficient_topic").alias("pct_insufficient_topic_evidence"),
        ),
        keyword_lists(cluster_keywords(texts, settings, words)),
        anchors_by_type(listed),
        sample_ids(clusters),
        anchor_quality(clusters, mentions, listed),
        median_topic_length(texts),
    ]
    profile = cluster_size(clusters)
    for part in parts:
        profile = profile.join(part, "cluster_id", "left")
    no_keywords = F.array().cast("array<struct<term:string,score:double>>")
    no_anchors = F.create_map().cast(
        "map<string,array<struct<entity:string,coverage:double,support:bigint,type:string>>>"
    )
    return profile.select(
        F.lit(settings.run_id).alias("run_id"),
        "cluster_id",
        "size",
        "coherence",
        "pct_insufficient_topic_evidence",
        F.coalesce("keywords_desc", no_keywords).alias("keywords_desc"),
        F.coalesce("keywords_hashtags", no_keywords).alias("keywords_hashtags"),
        F.coalesce("anchors_by_type", no_anchors).alias("anchors_by_type"),
        "sample_video_ids",
        "anchor_coverage",
        "anchor_garbage_rate",
        F.coalesce("keyword_congruence", F.lit(0.0)).alias("keyword_congruence"),
        F.coalesce("median_topic_length", F.lit(0.0)).alias("median_topic_length"),
    )
