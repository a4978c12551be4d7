"""Keyword scores per post. All per-post values are computed inside the row, without a shuffle."""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve.functions.arrays import bind, empty_array, explode_items, is_any_of, string_list, value_counts
from clipsieve.functions.text import drop_normal_noise
from clipsieve.operators.ranking import top_n
from clipsieve.settings import Lexicons, Settings

TOP_TOKENS = 5
OVERLAY_TOKENS = 5
LEXICON_COLUMNS = "family string, label string, keyword string, pos int"
_ENTRIES = "array<struct<family:string,label:string,keyword:string,pos:int>>"
_ENTRY_FIELDS = ("family", "label", "keyword", "pos")
_TOKEN = "struct<token:string,weight:double>"
_CONTRIBUTION = "struct<family:string,label:string,keyword:string,pos:int,weight:double>"


def lexicon_rows(lexicons: Lexicons) -> list[tuple[str, str, str, int]]:
    """Lexicon as ``(family, label, keyword, pos)``; a keyword listed twice gives two rows."""
    return [
        (family, label, keyword.lower(), pos)
        for family, labels in lexicons.items()
        for label, keywords in labels.items()
        for pos, keyword in enumerate(keywords)
    ]


def lexicon_frame(spark: SparkSession, lexicons: Lexicons) -> DataFrame:
    return spark.createDataFrame(lexicon_rows(lexicons), LEXICON_COLUMNS)


def scoring_tokens(settings: Settings) -> Column:
    """Noise-free tokens followed by the whole normalised tags, repeated by the hashtag weight."""
    tags = F.filter("hashtags_list_norm", lambda tag: tag != "")
    repeated = F.flatten(F.array_repeat(tags, settings.hashtag_repeat))
    return F.concat(drop_normal_noise(F.col("lex_tokens"), settings.noise), repeated)


def lexicon_hits(evidence: DataFrame, lexicon: DataFrame, settings: Settings) -> DataFrame:
    """``video_id, family, label, keyword, pos, n`` by joining tokens with a lexicon table.

    For lexicons that live in a table. The inner join comes first, so only tokens that hit a keyword
    reach the shuffle, already counted map-side; the lexicon is broadcast only if it is proven small.
    """
    keywords = lexicon.select("family", "label", F.lower("keyword").alias("keyword"), "pos")
    tokens = explode_items(evidence, ["video_id"], scoring_tokens(settings), "keyword")
    return (
        tokens.join(keywords, "keyword")
        .groupBy("video_id", "family", "label", "keyword", "pos")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _constant(rows: list[dict], kind: str) -> Column:
    """A literal array of structs; parsed once, when the plan is made."""
    return F.from_json(F.lit(json.dumps(rows)), kind)


def _contributions(settings: Settings, weight: float) -> Column:
    """Keywords that occur in the row with their weights, in lexicon order."""
    rows = lexicon_rows(settings.lexicons)
    if not rows:
        return empty_array(_CONTRIBUTION)
    entries = _constant([dict(zip(_ENTRY_FIELDS, row)) for row in rows], _ENTRIES)
    keywords = sorted({keyword for _, _, keyword, _ in rows})
    noise = set(settings.noise.all_words)
    # The scoring tokens that are keywords; a keyword that is also noise counts only as a tag.
    words = F.filter(
        "lex_tokens", lambda token: is_any_of(token, [word for word in keywords if word not in noise])
    )
    tags = F.filter("hashtags_list_norm", lambda tag: is_any_of(tag, keywords))
    found = F.concat(words, F.flatten(F.array_repeat(tags, settings.hashtag_repeat)))

    def weigh(counts: Column) -> Column:
        weighted = F.transform(
            entries,
            lambda entry: F.struct(
                entry["family"].alias("family"),
                entry["label"].alias("label"),
                entry["keyword"].alias("keyword"),
                entry["pos"].alias("pos"),
                (F.coalesce(F.try_element_at(counts, entry["keyword"]), F.lit(0)) * weight)
                .cast("double")
                .alias("weight"),
            ),
        )
        return F.filter(weighted, lambda item: item["weight"] > 0)

    def weigh_hits(hits: Column) -> Column:
        counts = F.map_from_entries(value_counts(hits))
        return F.when(F.size(hits) > 0, bind(counts, weigh)).otherwise(empty_array(_CONTRIBUTION))

    return bind(found, weigh_hits)


def contributions(evidence: DataFrame, settings: Settings, weight: float = 1.0) -> DataFrame:
    """``run_id, video_id, contributions``: one row per post, in the same partitions as the input."""
    return evidence.select("run_id", "video_id", _contributions(settings, weight).alias("contributions"))


def _top(items: Column) -> Column:
    """Largest weights first, ties by position in the lexicon."""
    ranked = F.array_sort(
        F.transform(
            items, lambda item: F.struct(-item["weight"], item["pos"], item["keyword"].alias("token"))
        )
    )
    return F.transform(
        F.slice(ranked, 1, TOP_TOKENS),
        lambda item: F.struct(item["token"].alias("token"), (-item["col1"]).alias("weight")),
    )


def _graded(settings: Settings) -> Column:
    """Score and top tokens of every label, in the order of the settings; null without any hit."""
    labels = _constant(
        [
            {"family": family, "label": label}
            for family, names in settings.lexicons.items()
            for label in names
        ],
        "array<struct<family:string,label:string>>",
    )

    def grade(found: Column, label: Column) -> Column:
        own = F.filter(
            found,
            lambda item: (item["family"] == label["family"]) & (item["label"] == label["label"]),
        )
        return bind(
            own,
            lambda items: F.struct(
                label["label"].alias("label"),
                F.aggregate(items["weight"], F.lit(0.0), lambda total, w: total + w).alias("score"),
                _top(items).alias("top"),
            ),
        )

    graded = bind(
        F.col("contributions"), lambda found: F.transform(labels, lambda label: grade(found, label))
    )
    return F.when(F.size("contributions") > 0, graded)


def lexicon_scores(evidence: DataFrame, settings: Settings, weight: float = 1.0) -> DataFrame:
    """One row per post: a score map and a top-token map per family, polarity and all evidence.

    Score maps hold every label (0.0 without a hit), top-token maps only labels with hits. Narrow: every
    map is built from the row's own contributions; a family's labels are a fixed slice of the graded ones.
    """
    hit = F.col("_graded").isNotNull()
    columns, found_maps, empty_maps, start = [], [], [], 1
    polarity = F.lit(0.0)
    for family, labels in settings.lexicons.items():
        part = F.slice("_graded", start, len(labels))
        start += len(labels)
        # Rows without a hit, the most frequent kind, take maps that are constants of the plan.
        names = string_list(list(labels))
        zeros = F.map_from_arrays(names, F.array_repeat(F.lit(0.0), len(labels)))
        no_tokens = F.map_from_arrays(names, F.array_repeat(empty_array(_TOKEN), len(labels)))
        scores = F.map_from_arrays(part["label"], part["score"])
        tops = F.map_from_arrays(part["label"], part["top"])
        with_hits = F.map_filter(tops, lambda _, items: F.size(items) > 0)
        no_labels = F.create_map().cast(f"map<string,array<{_TOKEN}>>")
        columns.append(F.when(hit, scores).otherwise(zeros).alias(f"{family}_scores_raw"))
        columns.append(F.when(hit, with_hits).otherwise(no_labels).alias(f"{family}_top_tokens"))
        found_maps += [F.lit(family), tops]
        empty_maps += [F.lit(family), no_tokens]
        if family == "sentiment":
            positive, negative = (
                F.coalesce(F.try_element_at(scores, F.lit(name)), F.lit(0.0))
                for name in ("positive", "negative")
            )
            polarity = F.when(hit, positive - negative).otherwise(F.lit(0.0))
    all_evidence = F.when(hit, F.create_map(*found_maps)).otherwise(F.create_map(*empty_maps))
    graded = contributions(evidence, settings, weight).withColumn("_graded", _graded(settings))
    return graded.select(
        "run_id",
        "video_id",
        *columns,
        polarity.alias("sentiment_polarity"),
        all_evidence.alias("lexicon_evidence"),
    )


def score_rows(scores: DataFrame, settings: Settings) -> DataFrame:
    """Long form of the score maps: ``video_id, family, label, score``."""
    per_family = [
        F.transform(
            F.map_entries(f"{family}_scores_raw"), partial(_score_entry, family)
        )
        for family in settings.lexicons
    ]
    return explode_items(scores, ["video_id"], F.concat(*per_family)).select("video_id", "item.*")


def _score_entry(family: str, entry: Column) -> Column:
    return F.struct(
        F.lit(family).alias("family"), entry["key"].alias("label"), entry["value"].alias("score")
    )


def top_token_rows(scores: DataFrame) -> DataFrame:
    """Long form of the evidence: ``video_id, family, label, rank, token, weight``."""
    entries = F.flatten(
        F.transform(
            F.map_entries("lexicon_evidence"),
            lambda family: F.flatten(
                F.transform(
                    F.map_entries(family["value"]),
                    lambda label: F.transform(
                        label["value"],
                        lambda item, pos: F.struct(
                            family["key"].alias("family"),
                            label["key"].alias("label"),
                            (pos + 1).alias("rank"),
                            item["token"].alias("token"),
                            item["weight"].alias("weight"),
                        ),
                    ),
                )
            ),
        )
    )
    return explode_items(scores, ["video_id"], entries).select("video_id", "item.*")


def cluster_sentiment(clusters: DataFrame, scores: DataFrame) -> DataFrame:
    """``cluster_id, mean_polarity, scored``: mean over the members that have scores."""
    return (
        clusters.select("video_id", "cluster_id")
        .join(scores.select("video_id", "sentiment_polarity"), "video_id")
        .groupBy("cluster_id")
        .agg(F.avg("sentiment_polarity").alias("mean_polarity"), F.count(F.lit(1)).alias("scored"))
    )


def lexicon_overlay(clusters: DataFrame, scores: DataFrame, limit: int = OVERLAY_TOKENS) -> DataFrame:
    """Top per-post token weights of each cluster, family and label; posts are not summed.

    Ties go by token, then by id. Map tasks keep only their own top rows, so a hot cluster stays cheap.
    """
    members = clusters.select("video_id", "cluster_id")
    rows = top_token_rows(scores).drop("rank").join(members, "video_id")
    return top_n(
        rows,
        ["cluster_id", "family", "label"],
        [F.desc("weight"), F.asc("token"), F.asc("video_id")],
        limit,
    )
