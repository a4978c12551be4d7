"""One query per operator over the given tables.

Lists are shown as joined text and doubles are rounded, so that both engines give equal values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.setup import CHECK_STOP_WORDS, SETTINGS, as_posts, members, table, videos
from clipsieve.functions import text
from clipsieve.functions.arrays import explode_items
from clipsieve.functions.dates import epoch_seconds, utc_date
from clipsieve.operators import (
    cards, clustering, entities, hooks, integrity, lexicon, noise, profiles, quantiles, reconcile, reports, tfidf,
)
from clipsieve.operators.embedding import embed as embed_stage
from clipsieve.operators.evidence import insufficient, language_columns, prepare_evidence
from clipsieve.session import materialize, prepare_session, stage_root
from clipsieve.sources import posts, sinks
from clipsieve.sources.colocated import write_colocated

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def shown(values: Column | str) -> Column:
    return F.array_join(values, "|")


def rounded(value: Column | str) -> Column:
    # Adding 0 turns a negative zero into a plain one.
    return F.round(value, 6) + F.lit(0.0)


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts.ingest(videos(spark, sf_dir))


def evidence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_evidence(ingested(spark, sf_dir), SETTINGS)


def found_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.candidates(evidence_rows(spark, sf_dir), SETTINGS)


def found_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.mentions(found_entities(spark, sf_dir))


def with_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members with their largest cosine to the labels' mean vectors (one row per label collected)."""
    rows = members(spark, sf_dir)
    means = clustering.centroids(rows).orderBy("cluster_id").collect()
    return clustering.membership_strength(rows, [row["centroid"] for row in means])


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_metrics(members(spark, sf_dir), evidence_rows(spark, sf_dir))


def profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of the given clusters; evidence and mentions are written once, as in a full run. No profile reads
    the lexicon's columns."""
    evidence = materialize(evidence_rows(spark, sf_dir).drop("lex_tokens", "noise_hits"))
    mentions = materialize(entities.mentions(entities.candidates(evidence, SETTINGS)))
    rows = members(spark, sf_dir)
    return profiles.build_profiles(
        evidence,
        rows,
        clustering.cluster_metrics(rows, evidence),
        mentions,
        SETTINGS,
        CHECK_STOP_WORDS,
    )


# Scans and columns


@query
def scan_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = posts.scan(spark, f"{sf_dir}/documents.parquet")
    rows = as_posts(raw)
    return rows.select("video_id", "author_id", "created_at", "desc_raw", "challenges_raw")


@query
def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = videos(spark, sf_dir).select(
        F.col("video_id").alias("aweme_id"),
        F.when(F.col("lang") != "de", F.col("author_id")).alias("user_id"),
        F.col("created_at").alias("createTime"),
        F.col("desc_raw").alias("description"),
        F.col("desc_raw"),
    )
    return posts.normalize_columns(raw)


@query
def ingest_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = videos(spark, sf_dir)
    return posts.ingest_checks(
        raw.withColumns(
            {
                "video_id": F.when(F.col("lang") != "es", F.col("video_id")),
                "author_id": F.when(F.col("lang") != "de", F.col("author_id")),
            }
        )
    )


@query
def parse_challenges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingested(spark, sf_dir).select(
        "video_id",
        shown("hashtags_list_raw").alias("tags"),
        F.size("hashtags_list_raw").cast("bigint").alias("n"),
    )


@query
def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingested(spark, sf_dir).withColumn("hashtags_list_raw", shown("hashtags_list_raw"))


@query
def created_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingested(spark, sf_dir).select(
        "video_id", "created_at", utc_date(F.col("created_at")).alias("created_date")
    )


@query
def created_date_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    events = table(spark, sf_dir, "events")
    seconds = epoch_seconds(F.col("ts"), events.schema["ts"].dataType)
    return events.select("event_id", utc_date(seconds).alias("created_date"))


@query
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = videos(spark, sf_dir).select(F.col("author_id").alias("video_id"))
    return posts.duplicate_ids(rows)


@query
def keep_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = videos(spark, sf_dir).select("author_id", "created_at", F.col("video_id").alias("kept_id"))
    return posts.keep_one(rows, [F.desc("created_at"), F.asc("kept_id")], "author_id")


# Text views


@query
def normalize_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_items(ingested(spark, sf_dir), ["video_id"], F.col("hashtags_list_raw"), "tag")
    return rows.select("video_id", "tag", text.normalize_token(F.col("tag")).alias("token"))


@query
def hashtag_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.transform("hashtags_list_raw", text.normalize_tag)
    return (
        ingested(spark, sf_dir)
        .select("video_id", tags.alias("tags"))
        .select("video_id", shown("tags").alias("tags"), shown(text.tag_words(F.col("tags"))).alias("words"))
    )


@query
def topic_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence_rows(spark, sf_dir).select("video_id", "topic_text")


@query
def ner_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence_rows(spark, sf_dir).select("video_id", "ner_text")


@query
def lex_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence_rows(spark, sf_dir).select("video_id", shown("lex_tokens").alias("lex_tokens"))


@query
def noise_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence_rows(spark, sf_dir).select("video_id", shown("noise_hits").alias("noise_hits"))


@query
def noise_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("desc_raw", " ")
    return videos(spark, sf_dir).select(
        "video_id", shown(text.drop_noise(words, SETTINGS.noise)).alias("kept")
    )


@query
def insufficient_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingested(spark, sf_dir).select(
        "video_id", F.transform("hashtags_list_raw", text.normalize_tag).alias("tags"), "desc_raw"
    )
    tokens = F.concat(
        text.topic_tokens(text.without_links(F.col("desc_raw"))), text.tag_words(F.col("tags"))
    )
    kept = rows.select("video_id", text.drop_noise(tokens, SETTINGS.noise).alias("tokens"))
    return kept.select(
        "video_id",
        F.size("tokens").cast("bigint").alias("n"),
        insufficient(F.col("tokens"), SETTINGS).alias("insufficient_topic_evidence"),
    )


@query
def language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    def by_column(_: Column) -> Column:
        return F.struct(F.col("lang"), F.lit(0.9).alias("conf"))

    return (
        videos(spark, sf_dir)
        .withColumns(language_columns(F.col("desc_raw"), SETTINGS, by_column))
        .filter("language_keep")
        .select("video_id", "language_pred", "language_conf", "language_keep")
    )


@query
def prepare_evidence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ["hashtags_list_raw", "hashtags_list_norm", "lex_tokens", "noise_hits"]
    return evidence_rows(spark, sf_dir).withColumns({name: shown(name) for name in lists})


QUERIES["prepare_evidence"] = QUERIES.pop("prepare_evidence_rows")


@query
def token_noise_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = noise.token_noise_report(evidence_rows(spark, sf_dir), SETTINGS)
    return report.withColumn("rank", F.col("rank").cast("bigint"))


# Lexicon scores


@query
def lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon_table = lexicon.lexicon_frame(spark, SETTINGS.lexicons)
    rows = lexicon.lexicon_hits(evidence_rows(spark, sf_dir), lexicon_table, SETTINGS)
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


@query
def lexicon_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lexicon.lexicon_scores(evidence_rows(spark, sf_dir), SETTINGS)
    return lexicon.score_rows(scores, SETTINGS)


@query
def lexicon_top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lexicon.top_token_rows(lexicon.lexicon_scores(evidence_rows(spark, sf_dir), SETTINGS))
    return rows.withColumn("rank", F.col("rank").cast("bigint"))


@query
def sentiment_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lexicon.lexicon_scores(evidence_rows(spark, sf_dir), SETTINGS)
    return scores.select("video_id", "sentiment_polarity")


@query
def lexicon_evidence_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lexicon.lexicon_scores(evidence_rows(spark, sf_dir), SETTINGS)
    return scores.select(
        "video_id",
        F.size("lexicon_evidence").cast("bigint").alias("families"),
        F.size(F.col("lexicon_evidence")["function_words"]).cast("bigint").alias("labels"),
        F.size("function_words_top_tokens").cast("bigint").alias("labels_with_hits"),
    )


# Entities


@query
def entity_canon(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_items(ingested(spark, sf_dir), ["video_id"], F.col("hashtags_list_raw"), "tag")
    return rows.select("video_id", "tag", entities.canonical(F.col("tag")).alias("canon"))


def _mentions_of(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return found_mentions(spark, sf_dir).filter(F.col("source") == source).drop("run_id")


@query
def handle_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions_of(spark, sf_dir, "HANDLE_REGEX")


@query
def hashtag_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions_of(spark, sf_dir, "HASHTAG_PARSE")


@query
def phrase_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions_of(spark, sf_dir, "DESC_MODEL")


@query
def structured_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("music_title"),
        F.lit(None).cast("string").alias("poi_name"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"),
        F.lit("").alias("music_title"),
        F.col("s_name").alias("poi_name"),
    )
    evidence = prepare_evidence(posts.ingest(parts.unionByName(suppliers)), SETTINGS)
    return entities.mentions(entities.candidates(evidence, SETTINGS)).drop("run_id")


@query
def hashtag_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_items(evidence_rows(spark, sf_dir), ["video_id"], F.col("hashtags_list_norm"), "tag")
    return rows.select("video_id", "tag", entities.tag_type(F.col("tag")).alias("type"))


@query
def entity_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = explode_items(videos(spark, sf_dir), ["video_id"], F.split("desc_raw", " "), "word")
    reason = entities.reject_reason(F.col("word"), F.lit("PERSON"), SETTINGS.noise)
    return (
        words.select("word", F.coalesce(reason, F.lit("accepted")).alias("reason"))
        .groupBy("word", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_mentions(spark, sf_dir)


@query
def entities_by_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = entities.entities_by_video(found_entities(spark, sf_dir))
    entries = explode_items(rows, ["video_id"], F.map_entries("entities_by_type"))
    return entries.select(
        "video_id", F.col("item.key").alias("entity_type"), shown("item.value").alias("entities")
    )


@query
def reject_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.reject_counts(found_entities(spark, sf_dir))


@query
def top_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.top_reject_reasons(entities.entities_by_video(found_entities(spark, sf_dir)))


@query
def ner_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_entities(spark, sf_dir)
    rates = entities.ner_qa(
        evidence_rows(spark, sf_dir),
        entities.mentions(found),
        entities.entities_by_video(found),
        SETTINGS,
    )
    names = ["coverage", "garbage_rate", "handle_mistype_rate"]
    return rates.withColumns({name: rounded(name) for name in names})


# Cluster metrics over the given labels


@query
def cluster_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.cluster_size(members(spark, sf_dir))


@query
def cluster_insufficient(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clustering.insufficient_share(members(spark, sf_dir), evidence_rows(spark, sf_dir))
    return rows.withColumn("pct_insufficient_topic", rounded("pct_insufficient_topic"))


@query
def cluster_coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.coherence(members(spark, sf_dir)).withColumn("coherence", rounded("coherence"))


@query
def cosine_to_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clustering.cosine_to_centroid(members(spark, sf_dir))
    return rows.withColumn("cosine", rounded("cosine"))


@query
def membership_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_strength(spark, sf_dir).select(
        "video_id", "cluster_id", rounded("strength").alias("strength")
    )


@query
def platform_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clustering.flag_members(with_strength(spark, sf_dir), materialize(metrics(spark, sf_dir)))
    return rows.select("video_id", "cluster_id", "is_noise")


@query
def cluster_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["coherence", "pct_insufficient_topic"]
    return metrics(spark, sf_dir).withColumns({name: rounded(name) for name in names})


@query
def cluster_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["coherence_mean", "coherence_median"]
    return clustering.cluster_qa(metrics(spark, sf_dir)).withColumns(
        {name: rounded(name) for name in names}
    )


@query
def strength_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["strength_median", "strength_iqr"]
    return quantiles.strength_quantiles(with_strength(spark, sf_dir)).withColumns(
        {name: rounded(name) for name in names}
    )


# TF-IDF and keywords


@query
def vocab_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.vocabulary(evidence_rows(spark, sf_dir), SETTINGS)


@query
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, names = tfidf.tfidf_vectors(materialize(evidence_rows(spark, sf_dir)), SETTINGS)
    pairs = explode_items(vectors, ["video_id"], F.arrays_zip("indices", "values"))
    # Terms hold no spaces; as one literal the list of names is split once, when the plan is made.
    term = F.element_at(F.split(F.lit(" ".join(names)), " "), F.col("item.indices") + 1)
    return pairs.select("video_id", term.alias("term"), rounded("item.values").alias("weight"))


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = profiles.cluster_texts(members(spark, sf_dir), evidence_rows(spark, sf_dir))
    rows = tfidf.cluster_keywords(texts, SETTINGS, CHECK_STOP_WORDS)
    return rows.select("cluster_id", "view", F.col("rank").cast("bigint"), "term", rounded("score").alias("score"))


@query
def keywords_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords(spark, sf_dir).filter("view = 'desc'").drop("view")


@query
def keywords_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords(spark, sf_dir).filter("view = 'hashtags'").drop("view")


@query
def keyword_congruence(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = profiles.cluster_texts(members(spark, sf_dir), evidence_rows(spark, sf_dir))
    lists = tfidf.keyword_lists(tfidf.cluster_keywords(texts, SETTINGS, CHECK_STOP_WORDS))
    return lists.select("cluster_id", rounded("keyword_congruence").alias("keyword_congruence"))


@query
def median_topic_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.median_topic_length(
        profiles.cluster_texts(members(spark, sf_dir), evidence_rows(spark, sf_dir))
    )


# Profiles


@query
def cluster_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profiles.cluster_texts(members(spark, sf_dir), evidence_rows(spark, sf_dir))
    return rows.withColumn("hashtags_list_norm", shown("hashtags_list_norm"))


@query
def anchor_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.anchored_members(members(spark, sf_dir), found_mentions(spark, sf_dir))


@query
def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profiles.anchors(members(spark, sf_dir), found_mentions(spark, sf_dir))
    return rows.withColumns({"coverage": rounded("coverage"), "rank": F.col("rank").cast("bigint")})


@query
def anchor_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialize(found_mentions(spark, sf_dir))
    rows = members(spark, sf_dir)
    quality = profiles.anchor_quality(rows, found, profiles.anchors(rows, found))
    names = ["anchor_coverage", "anchor_garbage_rate"]
    return quality.withColumns({name: rounded(name) for name in names})


@query
def sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profiles.sample_ids(members(spark, sf_dir))
    return rows.select("cluster_id", shown("sample_video_ids").alias("sample_video_ids"))


_PROFILE_VALUES = [
    "coherence",
    "pct_insufficient_topic_evidence",
    "anchor_coverage",
    "anchor_garbage_rate",
    "keyword_congruence",
    "median_topic_length",
]


@query
def profiles_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile_rows(spark, sf_dir)
    return rows.select("cluster_id", "size", *[rounded(name).alias(name) for name in _PROFILE_VALUES])


QUERIES["profiles"] = QUERIES.pop("profiles_scalar")


# Gates


def _stages(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = members(spark, sf_dir)
    evidence = evidence_rows(spark, sf_dir)
    return {
        "evidence": evidence,
        "embeddings": rows,
        "entities_by_video": entities.entities_by_video(entities.candidates(evidence, SETTINGS)),
        "clusters": rows,
    }


@query
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.stage_counts(_stages(spark, sf_dir))


@query
def universe_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.universe_hash(_stages(spark, sf_dir))


@query
def universe_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.universe_differences(_stages(spark, sf_dir))


@query
def universe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.differing_ids(_stages(spark, sf_dir))


@query
def gate_sample_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = members(spark, sf_dir)
    samples = materialize(profiles.sample_ids(rows))
    return integrity.gate_sample_validity(samples, evidence_rows(spark, sf_dir), rows, SETTINGS)


@query
def integrity_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = members(spark, sf_dir)
    evidence = materialize(evidence_rows(spark, sf_dir))
    found = materialize(entities.candidates(evidence, SETTINGS))
    by_video = entities.entities_by_video(found)
    found_rows = entities.mentions(found)
    profile = materialize(
        profiles.build_profiles(
            evidence,
            rows,
            clustering.cluster_metrics(rows, evidence),
            found_rows,
            SETTINGS,
            CHECK_STOP_WORDS,
        )
    )
    qa = entities.ner_qa(evidence, found_rows, by_video, SETTINGS)
    gates = integrity.integrity_gates(evidence, rows, by_video, rows, profile, qa, SETTINGS)
    return gates.withColumns(
        {
            "sample_video_rate": rounded("sample_video_rate"),
            "ner_coverage": rounded("ner_coverage"),
            "gate_failures": shown("gate_failures"),
        }
    )


# Review index and cards


@query
def card_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cards.card_flags(profile_rows(spark, sf_dir), SETTINGS)
    return rows.select("cluster_id", "flags", "recommended_action")


@query
def cluster_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cards.cluster_index(with_strength(spark, sf_dir), profile_rows(spark, sf_dir), SETTINGS)
    plain = ["cluster_id", "size", "flags", "recommended_action"]
    return rows.select(
        *[name if name in plain else rounded(name).alias(name) for name in rows.columns]
    ).orderBy("recommended_action", "cluster_id")


@query
def cluster_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lexicon.lexicon_scores(evidence_rows(spark, sf_dir), SETTINGS)
    rows = lexicon.cluster_sentiment(members(spark, sf_dir), scores)
    return rows.withColumn("mean_polarity", rounded("mean_polarity"))


@query
def lexicon_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lexicon.lexicon_scores(evidence_rows(spark, sf_dir), SETTINGS)
    rows = lexicon.lexicon_overlay(members(spark, sf_dir), scores)
    return rows.withColumn("rank", F.col("rank").cast("bigint"))


@query
def exemplars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cards.exemplars(members(spark, sf_dir), evidence_rows(spark, sf_dir))
    return rows.withColumn("rank", F.col("rank").cast("bigint"))


@query
def operator_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    evidence = materialize(evidence_rows(spark, sf_dir))
    mentions_table = materialize(entities.mentions(entities.candidates(evidence, SETTINGS)))
    rows = with_strength(spark, sf_dir)
    profile = materialize(
        profiles.build_profiles(
            evidence,
            rows,
            clustering.cluster_metrics(rows, evidence),
            mentions_table,
            SETTINGS,
            CHECK_STOP_WORDS,
        )
    )
    scores = lexicon.lexicon_scores(evidence, SETTINGS)
    return cards.cards(rows, evidence, profile, scores, SETTINGS)


QUERIES["cards"] = QUERIES.pop("operator_cards")


# Embeddings and clusters


def topic_rows(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """The evidence columns that the stages on vectors read, written once."""
    return materialize(evidence_rows(spark, sf_dir).select("run_id", "video_id", "topic_text", *more))


@query
def embed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embed_stage(topic_rows(spark, sf_dir), SETTINGS)
    return rows.select("video_id", F.size("embedding").cast("bigint").alias("dims"))


@query
def embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_stage(topic_rows(spark, sf_dir), SETTINGS)


@query
def kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(members(spark, sf_dir).drop("cluster_id"))
    model = clustering.fit_kmeans(rows, SETTINGS)
    return clustering.assign(rows, model).select("video_id", "cluster_id", "strength")


@query
def cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    evidence = topic_rows(spark, sf_dir, "insufficient_topic_evidence")
    embeddings = materialize(embed_stage(evidence, SETTINGS))
    clusters, _ = clustering.cluster_embeddings(embeddings, evidence, SETTINGS)
    return clusters


# Facts that hold whatever the random start was


def _squared(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x)


def _judged(placed: DataFrame, centers: np.ndarray) -> DataFrame:
    """``strength, own, least, best``: squared distances to the own and to the nearest center, and the largest
    cosine, from the differences and products themselves."""
    lengths = np.linalg.norm(centers, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("embedding").flatten(), dtype=float).reshape(batch.num_rows, -1)
            own, least, best = np.empty(len(rows)), np.empty(len(rows)), np.empty(len(rows))
            cluster = batch.column("cluster_id").to_numpy()
            for at in range(0, len(rows), 256):
                part = rows[at : at + 256]
                apart = ((part[:, None] - centers) ** 2).sum(axis=2)
                product = np.linalg.norm(part, axis=1)[:, None] * lengths
                cosines = np.divide(part @ centers.T, product, out=np.zeros_like(product), where=product > 0)
                place = slice(at, at + len(part))
                own[place] = apart[np.arange(len(part)), cluster[place]]
                least[place], best[place] = apart.min(axis=1), cosines.max(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("strength"), pa.array(own), pa.array(least), pa.array(best)],
                names=["strength", "own", "least", "best"],
            )

    columns = placed.select("cluster_id", "strength", "embedding")
    return columns.mapInArrow(run, "strength double, own double, least double, best double")


@query
def kmeans_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, those in their nearest center, those with the best cosine as strength, and whether the fit costs
    no more than the means of the given labels."""
    labelled = materialize(members(spark, sf_dir))
    model = clustering.fit_kmeans(labelled.drop("cluster_id"), SETTINGS)
    placed = clustering.assign(labelled.drop("cluster_id"), model)
    found = _judged(placed, model.centers).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("own") <= F.col("least") + 1e-9).alias("nearest"),
        F.count_if(F.abs(F.col("strength") - F.col("best")) <= 1e-6).alias("strong"),
        F.sum("own").alias("cost"),
    )
    # Written first: the planner knows how few they are, and does not deal the rows out by a few labels.
    means = labelled.join(materialize(clustering.centroids(labelled)), "cluster_id")
    plain = means.agg(F.sum(_squared(F.col("embedding").cast("array<double>"), F.col("centroid"))).alias("plain"))
    return found.crossJoin(plain).select("n", "nearest", "strong", (F.col("cost") <= F.col("plain")).alias("cheap"))


def _products(rows: DataFrame) -> DataFrame:
    """``i, j, p``: the sum over all rows of the products of components ``i`` and ``j``. Tasks add up their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            vectors = batch.column("embedding").drop_null()
            if len(vectors):
                matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
                found = matrix.T @ matrix
                total = found if total is None else total + found
        if total is not None:
            i, j = np.indices(total.shape, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "p"]
            )

    partial = rows.select("embedding").mapInArrow(run, "i int, j int, p double")
    return partial.groupBy("i", "j").agg(F.sum("p").alias("p"))


@query
def embed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, those no longer than the unit vectors they come from, and whether the dimensions are uncorrelated
    and ordered by the length they keep."""
    rows = materialize(embed_stage(topic_rows(spark, sf_dir), SETTINGS))
    length = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x * x)
    inside = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(length <= 1 + 1e-9).alias("inside"))
    grams = materialize(_products(rows))  # dimensions squared
    diagonal = grams.where("i = j")
    ordered = diagonal.select(
        F.array_sort(F.collect_list(F.struct("i", "p"))).alias("own")
    ).select(F.transform("own", lambda x: F.round(x["p"], 6)).alias("kept"))
    largest = F.max(F.when(F.col("i") == F.col("j"), F.col("p")))
    beside = F.max(F.when(F.col("i") != F.col("j"), F.abs("p")))
    judged = grams.agg((beside <= 1e-6 * largest).alias("uncorrelated")).crossJoin(
        ordered.select((F.col("kept") == F.reverse(F.array_sort("kept"))).alias("ordered"))
    )
    return inside.crossJoin(judged)


@query
def cluster_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, those with a cosine as strength, and whether each cluster has the flag that its metrics say."""
    evidence = topic_rows(spark, sf_dir, "insufficient_topic_evidence")
    embeddings = materialize(embed_stage(evidence, SETTINGS))
    clusters, found = clustering.cluster_embeddings(embeddings, evidence, SETTINGS)
    bucket = clustering.is_platform_bucket(F.col("pct_insufficient_topic"), F.col("coherence"))
    return clusters.join(found, "cluster_id", "left").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.abs("strength") <= 1 + 1e-9).alias("bounded"),
        F.count_if(F.col("is_noise") == bucket).alias("flagged_right"),
    )


# Sinks, written to the shared stage folder and read back, and hooks with small deterministic models


def _folder(spark: SparkSession) -> str:
    return f"{stage_root(spark)}/{uuid.uuid4().hex}"


# Frequent values chosen by a summary of bounded size, then counted


@query
def vocab_cap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.vocabulary(evidence_rows(spark, sf_dir), replace(SETTINGS, summary_values=200_000))


@query
def token_noise_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = noise.token_noise_report(evidence_rows(spark, sf_dir), replace(SETTINGS, summary_values=20_000))
    return rows.withColumn("rank", F.col("rank").cast("bigint"))


# Joins of stages that lie together by id


def _lying_together(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The given clusters and the evidence, both in the same buckets."""
    rows = members(spark, sf_dir).drop("embedding")
    return write_colocated(rows, _folder(spark)), write_colocated(evidence_rows(spark, sf_dir), _folder(spark))


@query
def colocated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profiles.cluster_texts(*_lying_together(spark, sf_dir))
    return rows.withColumn("hashtags_list_norm", shown("hashtags_list_norm"))


@query
def colocated_insufficient(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clustering.insufficient_share(*_lying_together(spark, sf_dir))
    return rows.withColumn("pct_insufficient_topic", rounded("pct_insufficient_topic"))


@query
def colocated_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters, evidence = _lying_together(spark, sf_dir)
    scores = write_colocated(lexicon.lexicon_scores(evidence, SETTINGS), _folder(spark), dealt=True)
    rows = lexicon.cluster_sentiment(clusters, scores)
    return rows.withColumn("mean_polarity", rounded("mean_polarity"))


@query
def colocated_exemplars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cards.exemplars(*_lying_together(spark, sf_dir))
    return rows.withColumn("rank", F.col("rank").cast("bigint"))


@query
def sink_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of the written cards."""
    path = _folder(spark)
    sinks.write_cards(operator_cards(spark, sf_dir), path)
    lines = spark.read.text(path).select(F.col("cluster_id").cast("bigint"), "value")
    heading = F.format_string("# Cluster %d", "cluster_id")
    return lines.groupBy("cluster_id").agg(
        F.count_if(F.col("value") == heading).alias("headings"),
        F.max(F.regexp_extract("value", r"^Size: (\d+)$", 1)).cast("bigint").alias("size"),
    )


@query
def sink_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ["hashtags_list_raw", "hashtags_list_norm", "lex_tokens", "noise_hits"]
    rows = sinks.write_table(evidence_rows(spark, sf_dir), _folder(spark))
    return rows.withColumns({name: shown(name) for name in lists})


@query
def sink_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lexicon.lexicon_scores(evidence_rows(spark, sf_dir), SETTINGS)
    return lexicon.score_rows(sinks.write_table(scores, _folder(spark)), SETTINGS)


@query
def sink_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.write_table(found_mentions(spark, sf_dir), _folder(spark))


@query
def sink_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sinks.write_table(entities.entities_by_video(found_entities(spark, sf_dir)), _folder(spark))
    entries = explode_items(rows, ["video_id"], F.map_entries("entities_by_type"))
    return entries.select(
        "video_id", F.col("item.key").alias("entity_type"), shown("item.value").alias("entities")
    )


@query
def sink_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embed_stage(topic_rows(spark, sf_dir), SETTINGS)
    stored = sinks.write_table(rows, _folder(spark))
    return stored.select("video_id", F.size("embedding").cast("bigint").alias("dims"))


@query
def sink_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clustering.flag_members(with_strength(spark, sf_dir), materialize(metrics(spark, sf_dir)))
    return sinks.write_table(rows, _folder(spark)).select("video_id", "cluster_id", "is_noise")


@query
def sink_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, folder = profile_rows(spark, sf_dir), _folder(spark)
    sinks.write_profiles(rows, folder)
    stored = spark.read.schema(rows.schema).json(folder)
    return stored.select("cluster_id", "size", *[rounded(name).alias(name) for name in _PROFILE_VALUES])


@query
def sink_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cards.cluster_index(with_strength(spark, sf_dir), profile_rows(spark, sf_dir), SETTINGS)
    folder = _folder(spark)
    sinks.write_index(rows, folder)
    stored = spark.read.schema(rows.schema).csv(folder, header=True)
    plain = ["cluster_id", "size", "recommended_action"]
    values = [name if name in plain else rounded(name).alias(name) for name in rows.columns if name != "flags"]
    return stored.select(F.coalesce("flags", F.lit("")).alias("flags"), *values)


@query
def sink_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    sinks.write_report(
        reports.noise_report(noise.token_noise_report(evidence_rows(spark, sf_dir), SETTINGS), SETTINGS), folder
    )
    return spark.read.text(folder).where("value LIKE '- %'").select(F.col("value").alias("line"))


@query
def sink_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = integrity.stage_counts(_stages(spark, sf_dir))
    nothing = spark.range(1).select(F.lit("rows without id").alias("kind"), F.lit(0).cast("bigint").alias("n"))
    gates = spark.range(1).select(F.lit(integrity.VALID).alias("run_status"))
    folder = _folder(spark)
    sinks.write_manifest(sinks.manifest(counts, nothing, gates, SETTINGS, folder), folder)
    stored = spark.read.schema("row_counts map<string,bigint>").json(folder)
    return stored.select(F.explode("row_counts").alias("stage", "n"))


@query
def hook_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make_detect():
        return lambda texts: [("en", 0.9) if " the " in text else ("xx", 0.25) for text in texts]

    found = language_columns(F.col("desc_raw"), SETTINGS, hooks.language_detector(make_detect))
    return ingested(spark, sf_dir).withColumns(found).select("video_id", "language_pred", "language_conf", "language_keep")


@query
def hook_encoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make_encoder():
        return lambda texts: [[float(len(text)), float(text.count("e"))] for text in texts]

    rows = hooks.encode(evidence_rows(spark, sf_dir), make_encoder)
    return rows.select("video_id", F.col("embedding")[0].alias("chars"), F.col("embedding")[1].alias("es"))


@query
def hook_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make_model():
        def tag(text: str):
            word = text.split(" ")[0]
            return [(word, "PERSON", None if len(word) % 2 else 0.0), (word, "LANGUAGE", 0.5)]

        return lambda texts: [tag(text) for text in texts]

    rows = hooks.with_model_entities(evidence_rows(spark, sf_dir), make_model)
    return rows.select("video_id", F.explode("model_entities").alias("e")).select(
        "video_id", "e.surface", "e.type", "e.confidence"
    )
