"""The review index and one Markdown card per cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsieve.functions.numbers import fixed
from clipsieve.operators.integrity import low_anchor_quality
from clipsieve.operators.lexicon import cluster_sentiment, lexicon_overlay
from clipsieve.operators.profiles import cluster_size, sample_rows
from clipsieve.operators.quantiles import strength_quantiles
from clipsieve.session import materialize
from clipsieve.settings import Settings

EXEMPLAR_LIMIT = 20
SNIPPET_LENGTH = 180
MAX_INSUFFICIENT = 0.5
MIN_CONGRUENCE = 0.1


def recommended_action(flags: Column) -> Column:
    """From the ``;``-joined flags. ``mixed_topic`` is understood though no stage sets it."""
    names = F.split(flags, ";")

    def has(flag: str) -> Column:
        return F.array_contains(names, flag)

    return (
        F.when(has("platform_bucket") | has("low_anchor_coverage"), F.lit("quarantine_low_evidence"))
        .when(has("mixed_topic") | has("low_congruence"), F.lit("review"))
        .otherwise(F.lit("good"))
    )


def card_flags(profiles: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``flags`` and ``recommended_action``. Missing profile values count as 0, a missing
    congruence as 1."""

    def known(name: str, default: float = 0.0) -> Column:
        return F.coalesce(F.col(name), F.lit(default))

    weak = low_anchor_quality(known("anchor_coverage"), known("anchor_garbage_rate"), settings)
    flags = F.concat_ws(
        ";",
        F.when(known("pct_insufficient_topic_evidence") > MAX_INSUFFICIENT, F.lit("platform_bucket")),
        F.when(known("keyword_congruence", 1.0) < MIN_CONGRUENCE, F.lit("low_congruence")),
        F.when(weak, F.lit("low_anchor_coverage")),
    )
    return profiles.withColumn("flags", flags).withColumn(
        "recommended_action", recommended_action(F.col("flags"))
    )


def cluster_index(clusters: DataFrame, profiles: DataFrame, settings: Settings) -> DataFrame:
    """One row per cluster with trust values, flags and the recommended action, unsorted."""
    known = profiles.drop("size", "run_id")
    joined = (
        cluster_size(clusters)
        .join(strength_quantiles(clusters), "cluster_id", "left")
        .join(known, "cluster_id", "left")
    )

    def value(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    return card_flags(joined, settings).select(
        "cluster_id",
        "size",
        value("coherence").alias("coherence_score"),
        "strength_median",
        "strength_iqr",
        value("pct_insufficient_topic_evidence").alias("pct_insufficient_topic_evidence"),
        value("keyword_congruence").alias("keyword_congruence_score"),
        value("anchor_coverage").alias("anchor_coverage"),
        value("anchor_garbage_rate").alias("anchor_garbage_rate"),
        "flags",
        "recommended_action",
    )


def exemplars(clusters: DataFrame, evidence: DataFrame, limit: int = EXEMPLAR_LIMIT) -> DataFrame:
    """``cluster_id, rank, video_id, snippet, hashtags``; both texts are null without evidence.

    The exemplars (at most ``limit`` per cluster) are written once and broadcast into the evidence,
    which is filtered and not shuffled.
    """
    chosen = materialize(sample_rows(clusters, limit))
    texts = (
        evidence.select("video_id", "desc_raw", "hashtags_list_norm")
        .join(chosen.select("video_id"), "video_id", "left_semi")
        .select(
            "video_id",
            F.substring("desc_raw", 1, SNIPPET_LENGTH).alias("snippet"),
            F.array_join("hashtags_list_norm", " ").alias("hashtags"),
        )
    )
    return chosen.join(texts, "video_id", "left").select(
        "cluster_id", "rank", "video_id", "snippet", "hashtags"
    )


def _lines(rows: DataFrame, name: str, line: Column, *order: str) -> DataFrame:
    """Join the lines of each cluster in order. The inputs are top-n tables, a few rows per cluster."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, line.alias("_line"))))
    text = F.array_join(F.transform(ordered, lambda item: item["_line"]), "\n")
    return rows.groupBy("cluster_id").agg(text.alias(name))


def _keyword_lines(keywords: Column) -> Column:
    lines = F.transform(
        keywords, lambda item: F.format_string("- %s (%s)", item["term"], fixed(item["score"], 3))
    )
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n"))


def _anchor_lines(by_type: Column) -> Column:
    def block(entry: Column) -> Column:
        items = F.transform(
            entry["value"],
            lambda anchor: F.format_string(
                "  - %s (coverage %s, support %d)",
                anchor["entity"],
                fixed(anchor["coverage"], 2),
                anchor["support"],
            ),
        )
        return F.concat_ws("\n", F.concat(F.lit("- **"), entry["key"], F.lit("**")), F.array_join(items, "\n"))

    blocks = F.transform(F.map_entries(by_type), block)
    return F.when(F.size(blocks) > 0, F.array_join(blocks, "\n"))


def _overlay_text(clusters: DataFrame, scores: DataFrame, settings: Settings) -> DataFrame:
    """Per cluster: families in the order of the settings, then the labels that had hits."""
    item = F.struct("rank", F.format_string("%s (%s)", "token", fixed("weight", 2)).alias("text"))
    per_label = (
        lexicon_overlay(clusters, scores)
        .groupBy("cluster_id", "family", "label")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(item)), lambda entry: entry["text"]), ", "
            ).alias("snippet")
        )
    )
    line = F.format_string("  - %s: %s", "label", "snippet")
    per_family = per_label.groupBy("cluster_id").agg(
        F.collect_list(F.struct("family", "label", line.alias("line"))).alias("_found")
    )
    blocks = []
    for family in settings.lexicons:
        lines = F.transform(
            F.array_sort(F.filter("_found", _family_is(family))), lambda entry: entry["line"]
        )
        blocks += [F.lit(f"- **{family}**"), F.when(F.size(lines) > 0, F.array_join(lines, "\n"))]
    return per_family.select("cluster_id", F.concat_ws("\n", *blocks).alias("_overlay"))


def _family_is(family: str):
    return lambda entry: entry["family"] == family


def cards(
    clusters: DataFrame,
    evidence: DataFrame,
    profiles: DataFrame,
    scores: DataFrame,
    settings: Settings,
) -> DataFrame:
    """``cluster_id, card_md``. All joined parts hold one row per cluster."""
    index = cluster_index(clusters, profiles, settings)
    rows = exemplars(clusters, evidence)
    example = F.concat_ws(
        "\n",
        F.concat(F.lit("- Video "), F.col("video_id")),
        F.concat(F.lit("  - desc: "), F.col("snippet")),
        F.concat(F.lit("  - hashtags: "), F.col("hashtags")),
    )
    card = (
        index.join(
            profiles.select("cluster_id", "keywords_desc", "keywords_hashtags", "anchors_by_type"),
            "cluster_id",
            "left",
        )
        .join(cluster_sentiment(clusters, scores), "cluster_id", "left")
        .join(_overlay_text(clusters, scores, settings), "cluster_id", "left")
        .join(_lines(rows, "_examples", example, "rank"), "cluster_id", "left")
    )
    hidden = low_anchor_quality(F.col("anchor_coverage"), F.col("anchor_garbage_rate"), settings)
    polarity = F.when(
        F.col("mean_polarity").isNotNull(), F.format_string("- mean polarity: %s", fixed("mean_polarity", 3))
    ).otherwise(F.lit("- sentiment unavailable"))
    families = "\n".join(f"- **{family}**" for family in settings.lexicons)
    text = F.concat_ws(
        "\n",
        F.format_string("# Cluster %s", F.col("cluster_id").cast("string")),
        F.lit(f"Run: {settings.run_id}"),
        F.format_string("Size: %d", "size"),
        F.format_string("Coherence: %s", fixed("coherence_score", 3)),
        F.format_string("Strength median/IQR: %s / %s", fixed("strength_median", 3), fixed("strength_iqr", 3)),
        F.format_string("Anchor coverage: %s (garbage %s)", fixed("anchor_coverage", 2), fixed("anchor_garbage_rate", 2)),
        F.lit("\n## What it's about"),
        F.lit("### Description keywords"),
        _keyword_lines(F.col("keywords_desc")),
        F.lit("### Hashtag keywords"),
        _keyword_lines(F.col("keywords_hashtags")),
        F.lit("\n## Entities/Anchors (typed)"),
        F.when(hidden, F.lit("Anchors withheld due to quality thresholds.")).otherwise(
            _anchor_lines(F.col("anchors_by_type"))
        ),
        F.lit("\n## Sentiment"),
        polarity,
        F.lit("\n## Lexicon overlays (top contributing tokens)"),
        F.coalesce("_overlay", F.lit(families)),
        F.lit("\n## Exemplars"),
        F.col("_examples"),
    )
    return card.select("cluster_id", text.alias("card_md"))
