"""Writers, kept apart from the transformations."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsieve.settings import Settings


def write_table(rows: DataFrame, path: str) -> DataFrame:
    """Write a stage as Parquet and return it as read back: later stages prune columns from the file
    and do not recompute it."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_profiles(profiles: DataFrame, path: str) -> None:
    """JSON lines, one cluster each."""
    profiles.write.mode("overwrite").json(path)


def write_index(index: DataFrame, path: str) -> None:
    """One CSV file, ordered by action; the table has one row per cluster."""
    ordered = index.repartition(1).sortWithinPartitions("recommended_action", "cluster_id")
    ordered.write.mode("overwrite").csv(path, header=True)


def write_cards(card_rows: DataFrame, path: str) -> None:
    """One folder per cluster with its Markdown text."""
    card_rows.select("cluster_id", F.col("card_md").alias("value")).write.mode(
        "overwrite"
    ).partitionBy("cluster_id").text(path)


def write_report(report: DataFrame, path: str) -> None:
    """One text file; a report has a few dozen lines."""
    lines = report.repartition(1).sortWithinPartitions("section", "ord").select("line")
    lines.write.mode("overwrite").text(path)


def manifest(
    counts: DataFrame, dropped: DataFrame, gates: DataFrame, settings: Settings, output_dir: str
) -> DataFrame:
    """One row: run id, output folder, row counts by stage, rows left out by kind, settings as JSON and the
    run status."""

    def as_map(rows: DataFrame, key: str, name: str) -> DataFrame:
        return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias(name))

    merged = as_map(counts, "stage", "row_counts")
    for part in (as_map(dropped, "kind", "dropped"), gates.select("run_status")):
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.agg(
        F.first("row_counts", ignorenulls=True).alias("row_counts"),
        F.first("dropped", ignorenulls=True).alias("dropped"),
        F.max("run_status").alias("run_status"),
    ).select(
        F.lit(settings.run_id).alias("run_id"),
        F.lit(output_dir).alias("output_dir"),
        "row_counts",
        "dropped",
        F.lit(json.dumps(_plain(settings.as_dict()), sort_keys=True)).alias("config"),
        "run_status",
    )


def _plain(value):
    if isinstance(value, Mapping):
        return {key: _plain(item) for key, item in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(item) for item in value]
    return value


def write_manifest(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("overwrite").json(path)
