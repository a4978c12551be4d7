"""Gates that decide whether a run may be reviewed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsieve.functions.hashing import id_fingerprint
from clipsieve.functions.vectors import ratio
from clipsieve.settings import Settings

VALID = "VALID_FOR_OPERATOR_REVIEW"
INVALID = "INVALID_FOR_OPERATOR_REVIEW"
MIN_SAMPLE_RATE = 0.9
MIN_COVERAGE = 0.9
SAMPLED_PROFILES = 5

# Texts of failed gates.
GATE_FAILURES = {
    "hashes_match": "Gate1: universe hash mismatch",
    "samples_valid": "Gate2: sample video ids invalid",
    "coverage_ok": "Gate3: NER join coverage low",
    "anchors_ok": "Gate4: anchor quality low",
}


def _union(frames: list[DataFrame]) -> DataFrame:
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """``stage, n``: one row per stage."""
    return _union(
        [
            rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
            for name, rows in stages.items()
        ]
    )


def universe_hash(stages: Mapping[str, DataFrame]) -> DataFrame:
    """``stage, universe_hash``: equal exactly when the id multisets are (up to hash collisions)."""
    return _union(
        [
            rows.agg(id_fingerprint(F.col("video_id")).alias("universe_hash")).select(
                F.lit(name).alias("stage"), "universe_hash"
            )
            for name, rows in stages.items()
        ]
    )


def universe_differences(stages: Mapping[str, DataFrame]) -> DataFrame:
    """``stage, missing, repeated``: ids of the union that a stage lacks, and ids it holds repeatedly.

    One shuffle of the ids of all stages, with partial counts; exact, where the fingerprint only says
    that something differs.
    """
    names = list(stages)
    tagged = _union(
        [rows.select("video_id", F.lit(name).alias("stage")) for name, rows in stages.items()]
    )
    per_id = tagged.groupBy("video_id").agg(
        *[F.count_if(F.col("stage") == name).alias(f"n_{i}") for i, name in enumerate(names)]
    )
    totals = per_id.agg(
        *[F.count_if(F.col(f"n_{i}") == 0).alias(f"missing_{i}") for i in range(len(names))],
        *[F.count_if(F.col(f"n_{i}") > 1).alias(f"repeated_{i}") for i in range(len(names))],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("stage"),
                F.col(f"missing_{i}").alias("missing"),
                F.col(f"repeated_{i}").alias("repeated"),
            )
            for i, name in enumerate(names)
        ]
    )
    return totals.select(F.inline(rows))


def sampled_profiles(profiles: DataFrame, seed: int, limit: int = SAMPLED_PROFILES) -> DataFrame:
    """A few profiles in an order fixed by the seed."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("cluster_id").cast("string")))
    return profiles.orderBy(order).limit(limit)


def gate_sample_validity(
    profiles: DataFrame, evidence: DataFrame, clusters: DataFrame, settings: Settings
) -> DataFrame:
    """One row ``matches, total, sample_video_rate`` over the samples of a few profiles.

    The samples are at most 20 per sampled profile, so the planner broadcasts them into the two large
    tables.
    """
    samples = sampled_profiles(profiles, settings.random_seed).select(
        "cluster_id", F.explode("sample_video_ids").alias("video_id")
    )
    placed = (
        clusters.select("cluster_id", "video_id")
        .join(samples, ["cluster_id", "video_id"], "left_semi")
        .distinct()
    )
    known = (
        evidence.select("video_id")
        .join(samples.select("video_id"), "video_id", "left_semi")
        .distinct()
    )
    judged = samples.join(placed.withColumn("_placed", F.lit(1)), ["cluster_id", "video_id"], "left").join(
        known.withColumn("_known", F.lit(1)), "video_id", "left"
    )
    counts = judged.agg(
        F.count_if(F.col("_placed").isNotNull() & F.col("_known").isNotNull()).alias("matches"),
        F.count(F.lit(1)).alias("total"),
    )
    return counts.select(
        "matches", "total", ratio(F.col("matches"), F.col("total")).alias("sample_video_rate")
    )


def low_anchor_quality(coverage: Column, garbage: Column, settings: Settings) -> Column:
    return (coverage < settings.min_anchor_coverage) | (garbage > settings.max_anchor_garbage)


def integrity_gates(
    evidence: DataFrame,
    embeddings: DataFrame,
    by_video: DataFrame,
    clusters: DataFrame,
    profiles: DataFrame,
    ner_metrics: DataFrame,
    settings: Settings,
) -> DataFrame:
    """One row: the measured values, a boolean per gate, the failure texts and the run status."""
    stages = {
        "evidence": evidence,
        "embeddings": embeddings,
        "entities_by_video": by_video,
        "clusters": clusters,
    }
    bad_anchor = low_anchor_quality(
        F.col("anchor_coverage"), F.col("anchor_garbage_rate"), settings
    )
    parts = [
        universe_hash(stages).agg(
            F.max(F.when(F.col("stage") == "evidence", F.col("universe_hash"))).alias("universe_hash"),
            (F.count_distinct("universe_hash") == 1).alias("hashes_match"),
        ),
        gate_sample_validity(profiles, evidence, clusters, settings).select("sample_video_rate"),
        ner_metrics.select(F.col("coverage").alias("ner_coverage")),
        profiles.agg(F.count_if(bad_anchor).alias("weak_profiles")),
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    # Each column is set in exactly one of the one-row parts.
    values = merged.agg(*[F.max(name).alias(name) for name in merged.columns])
    gates = values.withColumns(
        {
            "samples_valid": F.col("sample_video_rate") >= MIN_SAMPLE_RATE,
            "coverage_ok": F.col("ner_coverage") >= MIN_COVERAGE,
            "anchors_ok": F.col("weak_profiles") == 0,
        }
    )
    failures = F.array_compact(
        F.array(*[F.when(~F.col(gate), F.lit(text)) for gate, text in GATE_FAILURES.items()])
    )
    judged = gates.withColumn("gate_failures", failures)
    return judged.withColumn(
        "run_status", F.when(F.size("gate_failures") == 0, F.lit(VALID)).otherwise(F.lit(INVALID))
    )
