"""From a table of posts to reviewable cluster cards."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve.operators import cards as cards_ops
from clipsieve.operators import clustering, entities, integrity, lexicon, reports
from clipsieve.operators.embedding import embed
from clipsieve.operators.evidence import Detector, constant_detector, prepare_evidence
from clipsieve.operators.hooks import Encoder, EntityModel, with_model_entities
from clipsieve.operators.noise import token_noise_report
from clipsieve.operators.profiles import build_profiles, missing_evidence
from clipsieve.operators.reconcile import differing_ids
from clipsieve.session import clear_stages, materialize, prepare_session
from clipsieve.settings import Settings
from clipsieve.sources import sinks
from clipsieve.sources.colocated import write_colocated
from clipsieve.sources.posts import ingest, ingest_checks, keep_one, normalize_columns, require_unique


@dataclass
class ReviewRun:
    status: str
    evidence: DataFrame
    scores: DataFrame
    mentions: DataFrame
    entities_by_video: DataFrame
    embeddings: DataFrame
    clusters: DataFrame
    metrics: DataFrame
    profiles: DataFrame
    gates: DataFrame


def run(
    spark: SparkSession,
    posts: DataFrame,
    output_dir: str,
    settings: Settings,
    detector: Detector = constant_detector,
    make_encoder: Callable[[], Encoder] | None = None,
    make_entity_model: Callable[[], EntityModel] | None = None,
    stop_words: Sequence[str] | None = None,
) -> ReviewRun:
    """Write every stage below ``output_dir`` and return the stages and the run status.

    Each stage is written once and read back, which cuts its lineage: a lost executor costs a re-read,
    and the next stage reads only the columns that it uses. Stages of ids are dealt out by id when the evidence
    is written, and stay so. Cards are written only for a valid run.
    Repeated ids stop the run with their number, before anything is written, or one row of each is kept
    (``settings.repeated_ids``). The files of steps inside a stage are removed at the end.
    """
    prepare_session(spark)
    try:
        return _run(spark, posts, output_dir, settings, detector, make_encoder, make_entity_model, stop_words)
    finally:
        clear_stages(spark)


def _run(
    spark: SparkSession,
    posts: DataFrame,
    output_dir: str,
    settings: Settings,
    detector: Detector,
    make_encoder: Callable[[], Encoder] | None,
    make_entity_model: Callable[[], EntityModel] | None,
    stop_words: Sequence[str] | None,
) -> ReviewRun:
    base = output_dir.rstrip("/")

    def table(rows: DataFrame, name: str) -> DataFrame:
        return sinks.write_table(rows, f"{base}/{name}")

    def by_id(rows: DataFrame, name: str, dealt: bool = True) -> DataFrame:
        """Stages with a row or more for each id lie together by id: no join between them moves them again."""
        return write_colocated(rows, f"{base}/{name}", buckets=settings.stage_buckets, dealt=dealt)

    ingested = ingest(posts)
    if settings.repeated_ids == "stop":
        require_unique(normalize_columns(posts).select("video_id").where("video_id is not null"))
    else:
        others = [F.xxhash64(*ingested.columns)]
        ingested = keep_one(ingested, [F.asc_nulls_last("created_at"), *others])
    evidence = by_id(prepare_evidence(ingested, settings, detector), "prepared_evidence", dealt=False)
    scores = by_id(lexicon.lexicon_scores(evidence, settings), "lexicon_scores")
    tagged = with_model_entities(evidence, make_entity_model) if make_entity_model else evidence
    found = by_id(entities.candidates(tagged, settings), "entity_candidates")
    mentions = by_id(entities.mentions(found), "entities_mentions")
    by_video = by_id(entities.entities_by_video(found), "entities_by_video")
    embeddings = by_id(embed(evidence, settings, make_encoder), "embeddings")
    members, metrics = clustering.cluster_embeddings(embeddings, evidence, settings)
    clusters = by_id(members, "clusters", dealt=False)
    metrics = table(metrics, "cluster_metrics")
    profiles = table(
        build_profiles(evidence, clusters, metrics, mentions, settings, stop_words), "cluster_profiles"
    )
    sinks.write_profiles(profiles, f"{base}/cluster_profiles_json")

    qa = entities.ner_qa(evidence, mentions, by_video, settings)
    gates = table(
        integrity.integrity_gates(
            evidence, embeddings, by_video, clusters, profiles, qa, settings
        ),
        "integrity_gates",
    )
    checks = materialize(ingest_checks(posts))
    dropped = materialize(
        checks.select(F.lit("rows without id").alias("kind"), F.col("rows_without_id").alias("n")).unionByName(
            missing_evidence(clusters, evidence).select(
                F.lit("members without evidence").alias("kind"), F.col("missing").alias("n")
            )
        )
    )
    counts = integrity.stage_counts(
        {
            "prepared": evidence,
            "embeddings": embeddings,
            "entities_by_video": by_video,
            "clusters": clusters,
        }
    ).unionByName(checks.select(F.lit("raw").alias("stage"), F.col("raw_rows").alias("n")))
    sinks.write_manifest(sinks.manifest(counts, dropped, gates, settings, output_dir), f"{base}/run_manifest")

    top_tokens = token_noise_report(evidence, settings).persist()
    sinks.write_report(reports.noise_report(top_tokens, settings), f"{base}/token_noise_report")
    top_tokens.unpersist()
    sinks.write_report(reports.ner_report(qa, by_video, found, settings), f"{base}/ner_qa_report")
    sinks.write_report(reports.cluster_report(metrics, settings), f"{base}/cluster_qa_report")
    status, same_ids = gates.select("run_status", "hashes_match").first()
    differences = None
    if not same_ids:
        stages = {"evidence": evidence, "embeddings": embeddings, "entities_by_video": by_video, "clusters": clusters}
        differences = integrity.universe_differences(stages)
        table(differing_ids(stages), "universe_differences")
    report = reports.integrity_report(gates, metrics, dropped, settings, differences)
    sinks.write_report(report, f"{base}/integrity_report")
    if status == integrity.VALID:
        index = table(cards_ops.cluster_index(clusters, profiles, settings), "cluster_index")
        sinks.write_index(index, f"{base}/operator_cluster_index")
        sinks.write_cards(
            cards_ops.cards(clusters, evidence, profiles, scores, settings), f"{base}/operator_cards"
        )
    return ReviewRun(
        status, evidence, scores, mentions, by_video, embeddings, clusters, metrics, profiles, gates
    )
