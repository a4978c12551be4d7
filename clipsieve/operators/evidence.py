"""Text evidence: three views of every post plus trust flags, in one narrow projection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsieve.functions import text
from clipsieve.functions.arrays import is_any_of
from clipsieve.functions.dates import utc_date
from clipsieve.functions.rules import RULES
from clipsieve.settings import Settings
from clipsieve.sources.posts import STRUCTURED_COLUMNS

# A detector maps the description column to struct<lang: string, conf: double>.
Detector = Callable[[Column], Column]


def constant_detector(desc: Column) -> Column:
    """Stand-in used when no detector is given: everything is English with confidence 0.51."""
    return F.struct(F.lit("en").alias("lang"), F.lit(0.51).alias("conf"))


def language_columns(desc: Column, settings: Settings, detector: Detector = constant_detector) -> dict[str, Column]:
    """Predicted language, confidence and whether the row stays."""
    guess = detector(desc)
    lang = F.coalesce(guess["lang"], F.lit("unknown"))
    conf = F.coalesce(guess["conf"], F.lit(0.0)).cast("double")
    keep = F.lit(True)
    if settings.english_only:
        keep = (lang == "en") & (conf >= settings.language_threshold)
    return {"language_pred": lang, "language_conf": conf, "language_keep": keep}


def insufficient(tokens: Column, settings: Settings) -> Column:
    return F.size(tokens) < settings.insufficient_topic_threshold


def prepare_evidence(
    posts: DataFrame, settings: Settings, detector: Detector = constant_detector
) -> DataFrame:
    """Evidence rows of ingested posts; only rows that pass the language filter are derived.

    No shuffle: every value depends on its own row.
    """
    rules = RULES[settings.rules]
    noise = settings.noise
    extra = [name for name in STRUCTURED_COLUMNS if name in posts.columns]
    kept = posts.withColumns(
        language_columns(F.col("desc_raw"), settings, detector)
    ).filter("language_keep")
    cleaned = kept.withColumns(
        {
            "hashtags_list_norm": F.transform("hashtags_list_raw", text.normalize_tag),
            "_plain": text.without_links(F.col("desc_raw"), rules),
        }
    ).withColumn("_tag_words", text.tag_words(F.col("hashtags_list_norm")))
    topic = F.concat(text.topic_tokens(F.col("_plain"), rules), "_tag_words")
    joined = cleaned.withColumns(
        {
            "_topic_kept": text.drop_normal_noise(topic, noise),
            "_all_tokens": F.concat(text.lexicon_tokens(F.col("_plain"), rules), "_tag_words"),
        }
    )
    return joined.select(
        F.lit(settings.run_id).alias("run_id"),
        "video_id",
        "author_id",
        "created_at",
        utc_date(F.col("created_at")).alias("created_date"),
        "desc_raw",
        "challenges_raw",
        "hashtags_list_raw",
        "hashtags_list_norm",
        "language_pred",
        "language_conf",
        "language_keep",
        F.array_join("_topic_kept", " ").alias("topic_text"),
        text.entity_text(F.col("desc_raw"), F.col("hashtags_list_raw"), rules).alias("ner_text"),
        text.drop_normal_noise(F.col("_all_tokens"), noise).alias("lex_tokens"),
        F.filter("_all_tokens", lambda token: is_any_of(token, noise.platform)).alias("noise_hits"),
        F.lit(settings.text_view_version).alias("text_view_version"),
        insufficient(F.col("_topic_kept"), settings).alias("insufficient_topic_evidence"),
        *extra,
    )


def unfiltered_tokens(evidence: DataFrame, settings: Settings) -> DataFrame:
    """``video_id, tokens``: the lexicon view before noise words are removed."""
    rules = RULES[settings.rules]
    plain = evidence.select(
        "video_id", "hashtags_list_norm", text.without_links(F.col("desc_raw"), rules).alias("_plain")
    )
    tokens = F.concat(
        text.lexicon_tokens(F.col("_plain"), rules), text.tag_words(F.col("hashtags_list_norm"))
    )
    return plain.select("video_id", tokens.alias("tokens"))
