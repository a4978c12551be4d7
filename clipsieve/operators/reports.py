"""Markdown reports as small ordered tables of lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsieve.functions.numbers import fixed
from clipsieve.operators import entities
from clipsieve.operators.clustering import cluster_qa
from clipsieve.settings import Settings

def _text(spark: SparkSession, section: int, lines: Sequence[str]) -> DataFrame:
    rows = [(section, i, line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "section int, ord int, line string")


def _rows(rows: DataFrame, section: int, order: Column, line: Column) -> DataFrame:
    return rows.select(
        F.lit(section).alias("section"), order.cast("int").alias("ord"), line.alias("line")
    )


def _split(one_row: DataFrame, section: int, lines: Column) -> DataFrame:
    return one_row.select(F.posexplode(lines).alias("ord", "line")).select(
        F.lit(section).alias("section"), "ord", "line"
    )


def _together(parts: list[DataFrame]) -> DataFrame:
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def noise_report(top_tokens: DataFrame, settings: Settings) -> DataFrame:
    spark = top_tokens.sparkSession
    titles = {
        "removed": "Top removed noise tokens",
        "platform": "Top platform tags encountered",
        "kept": "Top kept tokens",
    }
    parts = [_text(spark, 0, ["# Token noise report", f"Run: {settings.run_id}"])]
    for i, (section, title) in enumerate(titles.items()):
        parts.append(_text(spark, 2 * i + 1, ["", f"## {title}"]))
        parts.append(
            _rows(
                top_tokens.filter(F.col("section") == section),
                2 * i + 2,
                F.col("rank"),
                F.format_string("- %s: %d", "token", "n"),
            )
        )
    return _together(parts)


def ner_report(qa: DataFrame, by_video: DataFrame, found: DataFrame, settings: Settings) -> DataFrame:
    """Rates, the reject reasons of posts that have an entity, and those of all candidates in ``found``."""
    lines = F.array(
        F.format_string("Universe rows: %d", "universe"),
        F.format_string("Coverage: %s", fixed("coverage", 3)),
        F.format_string("Garbage rate: %s", fixed("garbage_rate", 3)),
        F.format_string("Handle mis-typing rate: %s", fixed("handle_mistype_rate", 3)),
        F.lit(""),
        F.lit("## Top rejected reasons"),
    )
    reasons = entities.top_reject_reasons(by_video)
    totals = entities.reject_counts(found).groupBy("reason").agg(F.sum("n").alias("n"))
    return _together(
        [
            _text(qa.sparkSession, 0, ["# NER QA report", f"Run: {settings.run_id}"]),
            _split(qa, 1, lines),
            _rows(reasons, 2, -F.col("n"), F.format_string("- %s: %d", "reason", "n")),
            _text(qa.sparkSession, 3, ["", "## Rejected candidates of all posts"]),
            _rows(totals, 4, -F.col("n"), F.format_string("- %s: %d", "reason", "n")),
        ]
    )


def cluster_report(metrics: DataFrame, settings: Settings) -> DataFrame:
    summary = F.array(
        F.format_string("Clusters: %d", "clusters"),
        F.format_string("Coherence mean: %s", fixed("coherence_mean", 3)),
        F.format_string("Coherence median: %s", fixed("coherence_median", 3)),
        F.lit(""),
        F.lit("## Flagged clusters"),
    )
    flagged = F.format_string(
        "- Cluster %d flagged as platform bucket (coherence %s, insufficient %s)",
        "cluster_id",
        fixed("coherence", 3),
        fixed("pct_insufficient_topic", 2),
    )
    return _together(
        [
            _text(metrics.sparkSession, 0, ["# Cluster QA report", f"Run: {settings.run_id}"]),
            _split(cluster_qa(metrics), 1, summary),
            _rows(metrics.filter("platform_bucket"), 2, F.col("cluster_id"), flagged),
        ]
    )


def integrity_report(
    gates: DataFrame,
    metrics: DataFrame,
    dropped: DataFrame,
    settings: Settings,
    differences: DataFrame | None = None,
) -> DataFrame:
    """The gates, what was found beside them, and the failures. ``dropped`` has ``kind, n``;
    ``differences`` (``stage, missing, repeated``) is given when the stages do not hold the same ids."""
    passed = F.size("gate_failures") == 0
    head = F.array(
        F.concat(F.lit("Run status: "), F.col("run_status")),
        F.concat(F.lit("Universe hash: "), F.col("universe_hash")),
        F.concat(F.lit("Hashes consistent: "), F.initcap(F.col("hashes_match").cast("string"))),
        F.format_string("Sample video id pass rate: %s", fixed("sample_video_rate", 2)),
        F.format_string("NER coverage: %s", fixed("ner_coverage", 2)),
        F.lit(""),
        F.lit("## Findings"),
        F.format_string("- clusters with weak anchors: %d", "weak_profiles"),
    )
    tail = F.concat(
        F.array(
            F.lit(""),
            F.when(passed, F.lit("## All gates passed")).otherwise(F.lit("## Gate failures")),
        ),
        F.transform("gate_failures", lambda failure: F.concat(F.lit("- "), failure)),
    )
    flagged = metrics.agg(F.count_if("platform_bucket").alias("n"))
    parts = [
        _text(gates.sparkSession, 0, ["# Integrity report", f"Run: {settings.run_id}"]),
        _split(gates, 1, head),
        _rows(flagged, 2, F.lit(0), F.format_string("- clusters flagged as platform bucket: %d", "n")),
        _rows(dropped, 3, F.length("kind"), F.format_string("- %s: %d", "kind", "n")),
        _split(gates, 5, tail),
    ]
    if differences is not None:
        line = F.format_string("- stage %s: %d ids missing, %d ids repeated", "stage", "missing", "repeated")
        parts.append(_rows(differences, 4, F.lit(0), line))
    return _together(parts)
