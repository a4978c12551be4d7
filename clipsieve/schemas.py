"""Column types of every stage, in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

STRING, DOUBLE, LONG, INT, BOOL = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.IntegerType(),
    T.BooleanType(),
)
STRINGS = T.ArrayType(STRING)
DOUBLES = T.ArrayType(DOUBLE)


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CONTRIBUTIONS = T.ArrayType(struct(token=STRING, weight=DOUBLE))
KEYWORDS = T.ArrayType(struct(term=STRING, score=DOUBLE))
ANCHORS = T.MapType(
    STRING, T.ArrayType(struct(entity=STRING, coverage=DOUBLE, support=LONG, type=STRING))
)

INGESTED = struct(
    video_id=STRING,
    author_id=STRING,
    created_at=DOUBLE,
    desc_raw=STRING,
    challenges_raw=STRING,
    hashtags_list_raw=STRINGS,
)

EVIDENCE = struct(
    run_id=STRING,
    video_id=STRING,
    author_id=STRING,
    created_at=DOUBLE,
    created_date=STRING,
    desc_raw=STRING,
    challenges_raw=STRING,
    hashtags_list_raw=STRINGS,
    hashtags_list_norm=STRINGS,
    language_pred=STRING,
    language_conf=DOUBLE,
    language_keep=BOOL,
    topic_text=STRING,
    ner_text=STRING,
    lex_tokens=STRINGS,
    noise_hits=STRINGS,
    text_view_version=STRING,
    insufficient_topic_evidence=BOOL,
)

MENTIONS = struct(
    run_id=STRING,
    video_id=STRING,
    entity_surface=STRING,
    entity_canon=STRING,
    entity_type=STRING,
    source=STRING,
    confidence=DOUBLE,
    evidence_snippet=STRING,
)

ENTITIES_BY_VIDEO = struct(
    run_id=STRING,
    video_id=STRING,
    entities_by_type=T.MapType(STRING, STRINGS),
    reject_stats=T.MapType(STRING, LONG),
)

MODEL_ENTITIES = T.ArrayType(struct(surface=STRING, type=STRING, confidence=DOUBLE))

EMBEDDINGS = struct(run_id=STRING, video_id=STRING, embedding=DOUBLES)

CLUSTERS = struct(run_id=STRING, video_id=STRING, cluster_id=INT, strength=DOUBLE, is_noise=BOOL)

CLUSTER_METRICS = struct(
    cluster_id=INT, coherence=DOUBLE, pct_insufficient_topic=DOUBLE, platform_bucket=BOOL
)

PROFILES = struct(
    run_id=STRING,
    cluster_id=INT,
    size=LONG,
    coherence=DOUBLE,
    pct_insufficient_topic_evidence=DOUBLE,
    keywords_desc=KEYWORDS,
    keywords_hashtags=KEYWORDS,
    anchors_by_type=ANCHORS,
    sample_video_ids=STRINGS,
    anchor_coverage=DOUBLE,
    anchor_garbage_rate=DOUBLE,
    keyword_congruence=DOUBLE,
    median_topic_length=DOUBLE,
)

CLUSTER_INDEX = struct(
    cluster_id=INT,
    size=LONG,
    coherence_score=DOUBLE,
    strength_median=DOUBLE,
    strength_iqr=DOUBLE,
    pct_insufficient_topic_evidence=DOUBLE,
    keyword_congruence_score=DOUBLE,
    anchor_coverage=DOUBLE,
    anchor_garbage_rate=DOUBLE,
    flags=STRING,
    recommended_action=STRING,
)


def lexicon_scores(families: Sequence[str]) -> T.StructType:
    """Score map and top tokens per family, in the order of the families."""
    columns: dict[str, T.DataType] = {"run_id": STRING, "video_id": STRING}
    for family in families:
        columns[f"{family}_scores_raw"] = T.MapType(STRING, DOUBLE)
        columns[f"{family}_top_tokens"] = T.MapType(STRING, CONTRIBUTIONS)
    columns["sentiment_polarity"] = DOUBLE
    columns["lexicon_evidence"] = T.MapType(STRING, T.MapType(STRING, CONTRIBUTIONS))
    return struct(**columns)
