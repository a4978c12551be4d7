"""Typed entity mentions from handles, hashtags, capitalised phrases or a model, and named fields.

A post's candidates are one array on its own row. Mentions, per-post entity lists and reject counts
are all read from that array, so extraction never shuffles and reads the evidence once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsieve.functions.arrays import bind, empty_array, explode_items, string_list
from clipsieve.functions.rules import HANDLE_TAG, PHRASE, RULES, TextRules
from clipsieve.functions.text import is_noise, normalize_token, strip
from clipsieve.functions.unicode import nfkc, nfkc_all
from clipsieve.functions.vectors import ratio
from clipsieve.settings import NoiseLists, Settings

# Entity markers and suffixes that mark a topic instead.
ENTITY_MARKERS = ("official", "inc", "corp", "brand", "tv", "fm", "records")
TOPIC_SUFFIXES = ("tok", "tips", "life", "challenge", "tutorial", "grwm")
# Reject reasons, in the order in which they are tested.
REJECT_REASONS = ("punct", "digit_only", "handle_mistype", "noise", "too_long")
MAX_ENTITY_LENGTH = 80

_SURFACE = "struct<surface:string,form:string,type:string,source:string,confidence:double>"
_CANDIDATE = (
    "struct<surface:string,canon:string,type:string,source:string,confidence:double,reason:string>"
)


def tag_type(normal_tag: Column) -> Column:
    """A topic suffix decides first, then any entity marker inside the tag."""
    lowered = F.lower(normal_tag)
    entity = ~lowered.rlike(f"({'|'.join(TOPIC_SUFFIXES)})$") & lowered.rlike("|".join(ENTITY_MARKERS))
    return F.when(entity, F.lit("HASHTAG_ENTITY")).otherwise(F.lit("HASHTAG_TOPIC"))


def collapse(text: Column, rules: TextRules) -> Column:
    """The part of canonicalising that follows compatibility folding."""
    return F.regexp_replace(strip(text), rules.space_run, " ")


def canonical(text: Column, rules: TextRules = RULES["documented"]) -> Column:
    return collapse(nfkc(text), rules)


def reject_reason(
    entity: Column, entity_type: Column, noise: NoiseLists, rules: TextRules = RULES["documented"]
) -> Column:
    """First reason that applies, or null for an accepted entity."""
    tests = {
        "punct": (entity == "") | entity.rlike(rules.punct_only),
        "digit_only": entity.rlike(rules.digits_only),
        "handle_mistype": entity.contains("@") & (entity_type != "HANDLE"),
        "noise": is_noise(normalize_token(entity), noise),
        "too_long": F.length(entity) > MAX_ENTITY_LENGTH,
    }
    return F.coalesce(*[F.when(tests[reason], F.lit(reason)) for reason in REJECT_REASONS])


def _surface(surface: Column, form: Column, kind: Column, source: str, confidence: Column) -> Column:
    return F.struct(
        surface.alias("surface"),
        form.alias("form"),
        kind.alias("type"),
        F.lit(source).alias("source"),
        confidence.cast("double").alias("confidence"),
    )


def _handles() -> Column:
    found = F.regexp_extract_all("ner_text", F.lit(HANDLE_TAG), F.lit(1))
    at = F.transform(found, lambda name: F.concat(F.lit("@"), name))
    return F.transform(
        at, lambda name: _surface(name, name, F.lit("HANDLE"), "HANDLE_REGEX", F.lit(0.99))
    )


def _hashtags() -> Column:
    pairs = F.zip_with(
        "hashtags_list_raw",
        "hashtags_list_norm",
        lambda raw, norm: F.struct(
            raw.alias("raw"), norm.alias("norm"), tag_type(norm).alias("type")
        ),
    )
    paired = F.filter(pairs, lambda pair: pair["raw"].isNotNull() & pair["norm"].isNotNull())
    return F.transform(
        paired,
        lambda pair: _surface(
            pair["raw"],
            pair["norm"],
            pair["type"],
            "HASHTAG_PARSE",
            F.when(pair["type"] == "HASHTAG_ENTITY", 0.75).otherwise(0.55),
        ),
    )


def _phrases() -> Column:
    found = F.regexp_extract_all("ner_text", F.lit(PHRASE), F.lit(0))
    return F.transform(
        found, lambda phrase: _surface(phrase, phrase, F.lit("PERSON"), "DESC_MODEL", F.lit(0.5))
    )


def _model_output() -> Column:
    return F.transform(
        "model_entities",
        lambda item: _surface(
            item["surface"], item["surface"], item["type"], "DESC_MODEL", item["confidence"]
        ),
    )


def _field(name: str) -> Column:
    value = F.col(name).cast("string")
    found = F.array(_surface(value, value, F.lit("WORK"), "QA_STRUCTURED", F.lit(0.6)))
    return F.when(value != "", found).otherwise(empty_array(_SURFACE))


def candidates(evidence: DataFrame, settings: Settings) -> DataFrame:
    """``run_id, video_id, candidates``: everything found in each post with its reject reason.

    A ``model_entities`` column (see ``hooks``) takes the place of the capitalised-phrase rule; the
    columns ``music_title`` and ``poi_name`` are used when present.
    """
    rules = RULES[settings.rules]
    parts = [_handles(), _hashtags()]
    parts.append(_model_output() if "model_entities" in evidence.columns else _phrases())
    parts += [_field(name) for name in ("music_title", "poi_name") if name in evidence.columns]
    found = evidence.select("run_id", "video_id", F.concat(*parts).cast(f"array<{_SURFACE}>").alias("_found"))
    folded = found.withColumn(
        "_folded", nfkc_all(F.transform("_found", lambda item: item["form"]))
    )

    def judge(item: Column, canon: Column) -> Column:
        return F.struct(
            item["surface"].alias("surface"),
            F.lower(canon).alias("canon"),
            item["type"].alias("type"),
            item["source"].alias("source"),
            item["confidence"].alias("confidence"),
            reject_reason(canon, item["type"], settings.noise, rules).alias("reason"),
        )

    judged = F.zip_with(
        "_found",
        "_folded",
        lambda item, form: bind(collapse(form, rules), lambda canon: judge(item, canon)),
    )
    return folded.select("run_id", "video_id", judged.cast(f"array<{_CANDIDATE}>").alias("candidates"))


def _accepted() -> Column:
    return F.filter("candidates", lambda item: item["reason"].isNull())


def mentions(found: DataFrame) -> DataFrame:
    """One row per accepted candidate."""
    return explode_items(found, ["run_id", "video_id"], _accepted()).select(
        "run_id",
        "video_id",
        F.col("item.surface").alias("entity_surface"),
        F.col("item.canon").alias("entity_canon"),
        F.col("item.type").alias("entity_type"),
        F.col("item.source").alias("source"),
        F.col("item.confidence").alias("confidence"),
        F.col("item.surface").alias("evidence_snippet"),
    )


def _reject_counts() -> Column:
    reasons = string_list(REJECT_REASONS)

    def count(found: Column) -> Column:
        return F.transform(
            reasons,
            lambda reason: F.size(F.filter(found, lambda item: item["reason"] == reason)).cast("bigint"),
        )

    counts = bind(F.col("candidates"), count)
    return F.map_filter(F.map_from_arrays(reasons, counts), lambda _, n: n > 0)


def entities_by_video(found: DataFrame) -> DataFrame:
    """Entities by type and reject counts of every post that has an accepted entity.

    Lists keep the order of the text: handles, hashtags, phrases, fields.
    """
    def by_type(accepted: Column) -> Column:
        kinds = F.array_distinct(F.transform(accepted, lambda item: item["type"]))
        return F.transform(
            kinds,
            lambda kind: F.struct(
                kind,
                F.transform(
                    F.filter(accepted, lambda item: item["type"] == kind), lambda item: item["canon"]
                ),
            ),
        )

    row = bind(
        _accepted(),
        lambda accepted: F.when(
            F.size(accepted) > 0,
            F.struct(
                F.map_from_entries(by_type(accepted)).alias("entities_by_type"),
                _reject_counts().alias("reject_stats"),
            ),
        ),
    )
    # As a one-element array the row is built once; a filter would be moved down and judge it twice.
    return explode_items(found, ["run_id", "video_id"], F.array(row)).select(
        "run_id", "video_id", "item.*"
    )


def reject_counts(found: DataFrame) -> DataFrame:
    """``video_id, reason, n`` for every post with rejected candidates, whether or not others remain."""
    counts = F.transform(
        F.map_entries(_reject_counts()),
        lambda entry: F.struct(entry["key"].alias("reason"), entry["value"].alias("n")),
    )
    return explode_items(found, ["video_id"], counts).select("video_id", "item.*")


def top_reject_reasons(by_video: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent reject reasons over the posts that have an entity."""
    return (
        explode_items(by_video, [], F.map_entries("reject_stats"))
        .groupBy(F.col("item.key").alias("reason"))
        .agg(F.sum("item.value").alias("n"))
        .orderBy(F.desc("n"), F.asc("reason"))
        .limit(limit)
    )


def ner_qa(
    evidence: DataFrame, found_mentions: DataFrame, by_video: DataFrame, settings: Settings
) -> DataFrame:
    """One row: coverage, garbage rate and handle mis-typing rate; 0 where there is nothing to rate."""
    rules = RULES[settings.rules]
    named = F.col("entity_type").isin("PERSON", "ORG_BRAND")
    parts = [
        evidence.agg(F.count(F.lit(1)).alias("universe")),
        by_video.agg(F.count(F.lit(1)).alias("with_entities")),
        found_mentions.agg(
            F.count(F.lit(1)).alias("mentions"),
            F.count_if(F.col("entity_surface").rlike(rules.punct_only)).alias("garbage"),
            F.count_if(named).alias("named"),
            F.count_if(named & F.col("entity_surface").contains("@")).alias("mistyped"),
        ),
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    total = merged.agg(*[F.sum(name).alias(name) for name in merged.columns])
    return total.select(
        "universe",
        ratio(F.col("with_entities"), F.col("universe")).alias("coverage"),
        ratio(F.col("garbage"), F.col("mentions")).alias("garbage_rate"),
        ratio(F.col("mistyped"), F.col("named")).alias("handle_mistype_rate"),
    )
