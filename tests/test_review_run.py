"""Gates, cards, sinks and whole runs."""

import csv
import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clipsieve import Settings, schemas
from clipsieve.operators import cards, integrity, profiles
from clipsieve.plans.review_run import run
from clipsieve.session import shared_folder, stage_root

TOPICS = [
    ("Soccer", "soccer match goal football stadium", "soccer goal"),
    ("Baker", "bread oven recipe kitchen flour", "bread recipe"),
    ("Guitar", "guitar song concert album chord", "guitar song"),
]


def make_posts(spark, per_topic=12):
    rows = []
    for i in range(per_topic * len(TOPICS)):
        name, words, tags = TOPICS[i % len(TOPICS)]
        text = f"{name} shows {words} love @{name.lower()} https://v.example/{i}"
        listed = ", ".join(f"#{tag}" for tag in tags.split())
        rows.append((f"v{i:03d}", "me", 1.7e9 + i, text, listed))
    return spark.createDataFrame(
        rows, "id string, user_id string, create_time double, description string, hashtags string"
    ).repartition(4)


SETTINGS = Settings(run_id="run-1", clustering_k=3, kmeans_starts=2, embedding_dims=4)


@pytest.fixture(scope="module")
def valid_run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("valid")
    return run(spark, make_posts(spark), str(folder), SETTINGS), folder


def lines(folder, name):
    return [line for file in sorted((folder / name).glob("part-*")) for line in file.read_text().splitlines()]


def test_valid_run_publishes_cards(valid_run, spark):
    result, folder = valid_run
    assert result.status == integrity.VALID
    with next((folder / "operator_cluster_index").glob("*.csv")).open() as file:
        index = list(csv.DictReader(file))
    assert [row["size"] for row in index] == ["12", "12", "12"]
    assert {row["recommended_action"] for row in index} == {"good"}
    cards_found = sorted((folder / "operator_cards").glob("cluster_id=*/part-*"))
    assert len(cards_found) == 3
    card = next(c.read_text() for c in cards_found if "soccer" in c.read_text())
    for part in (
        "Run: run-1",
        "Size: 12",
        "### Description keywords",
        "- soccer (",
        "- **HANDLE**",
        "  - @soccer (coverage 1.00, support 12)",
        "- mean polarity: 1.000",
        "  - sports: soccer (",
        "- Video v000",
        "  - hashtags: soccer goal",
    ):
        assert part in card, part


def test_stage_tables_have_the_declared_types(valid_run):
    result, _ = valid_run

    def shape(kind):
        return [(field.name, field.dataType.simpleString()) for field in kind]

    expected = {
        "evidence": schemas.EVIDENCE,
        "mentions": schemas.MENTIONS,
        "entities_by_video": schemas.ENTITIES_BY_VIDEO,
        "embeddings": schemas.EMBEDDINGS,
        "clusters": schemas.CLUSTERS,
        "metrics": schemas.CLUSTER_METRICS,
        "profiles": schemas.PROFILES,
        "scores": schemas.lexicon_scores(list(SETTINGS.lexicons)),
    }
    for name, kind in expected.items():
        assert shape(getattr(result, name).schema) == shape(kind), name


def test_reports_and_manifest(valid_run):
    _, folder = valid_run
    manifest = json.loads(lines(folder, "run_manifest")[0])
    assert manifest["run_status"] == integrity.VALID
    assert manifest["row_counts"] == {
        "raw": 36,
        "prepared": 36,
        "embeddings": 36,
        "entities_by_video": 36,
        "clusters": 36,
    }
    assert manifest["dropped"] == {"rows without id": 0, "members without evidence": 0}
    assert json.loads(manifest["config"])["clustering_k"] == 3
    report = lines(folder, "integrity_report")
    assert report[:3] == ["# Integrity report", "Run: run-1", f"Run status: {integrity.VALID}"]
    assert report[-1] == "## All gates passed"
    assert "Universe rows: 36" in lines(folder, "ner_qa_report")
    assert "Clusters: 3" in lines(folder, "cluster_qa_report")
    noise = lines(folder, "token_noise_report")
    assert noise[0] == "# Token noise report" and "## Top kept tokens" in noise and "- love: 36" in noise
    stored = [json.loads(line) for line in lines(folder, "cluster_profiles_json")]
    assert len(stored) == 3 and all(p["anchor_coverage"] == 1.0 for p in stored)


def test_invalid_run_withholds_cards(spark, tmp_path):
    posts = make_posts(spark, 4).unionByName(
        spark.createDataFrame(
            [(f"x{i}", "me", 1.0, "no entity here at all", None) for i in range(5)],
            "id string, user_id string, create_time double, description string, hashtags string",
        )
    )
    result = run(spark, posts, str(tmp_path), SETTINGS)
    assert result.status == integrity.INVALID
    failures = result.gates.first()["gate_failures"]
    assert failures[0] == "Gate1: universe hash mismatch" and "Gate3: NER join coverage low" in failures
    assert not Path(tmp_path / "operator_cards").exists()
    report = lines(tmp_path, "integrity_report")
    assert "- Gate1: universe hash mismatch" in report
    assert "- stage entities_by_video: 5 ids missing, 0 ids repeated" in report
    listed = spark.read.parquet(str(tmp_path / "universe_differences")).collect()
    assert sorted(tuple(row) for row in listed) == [(f"x{i}", "entities_by_video", 0, 1) for i in range(5)]


def test_rows_left_out_are_reported(spark, tmp_path):
    """Null ids, repeated ids of which one row stays, rejected candidates; no stage folder is left."""
    posts = make_posts(spark, 2)
    nameless = posts.limit(2).withColumn(posts.columns[0], F.lit(None).cast("string"))
    result = run(
        spark, posts.unionByName(posts).unionByName(nameless), str(tmp_path), replace(SETTINGS, repeated_ids="keep_one")
    )
    manifest = json.loads(lines(tmp_path, "run_manifest")[0])
    assert manifest["row_counts"]["raw"] == 2 * posts.count() + 2
    assert result.evidence.count() == posts.count() and manifest["dropped"]["rows without id"] == 2
    assert "- rows without id: 2" in lines(tmp_path, "integrity_report")
    assert "## Rejected candidates of all posts" in lines(tmp_path, "ner_qa_report")
    folder = Path(stage_root(spark).removeprefix("file:"))
    assert not folder.exists()


def test_settings_are_checked():
    for wrong in ({"max_terms": 0}, {"max_terms": 10**7}, {"repeated_ids": "maybe"}):
        with pytest.raises(ValueError):
            replace(SETTINGS, **wrong)


def test_repeated_ids_stop_a_run(spark, tmp_path):
    posts = make_posts(spark, 2)
    with pytest.raises(ValueError, match="6 values of video_id"):
        run(spark, posts.unionByName(posts), str(tmp_path), SETTINGS)


def test_gates_fail_when_one_id_is_removed(valid_run):
    result, _ = valid_run
    qa = result.gates.select(F.col("ner_coverage").alias("coverage"))
    fewer = result.embeddings.filter("video_id <> 'v007'")
    gates = integrity.integrity_gates(
        result.evidence, fewer, result.entities_by_video, result.clusters, result.profiles, qa, SETTINGS
    ).first()
    assert (gates["hashes_match"], gates["run_status"]) == (False, integrity.INVALID)
    stages = {"evidence": result.evidence, "embeddings": fewer.unionByName(fewer.filter("video_id = 'v001'"))}
    differences = {r["stage"]: (r["missing"], r["repeated"]) for r in integrity.universe_differences(stages).collect()}
    assert differences == {"evidence": (0, 0), "embeddings": (1, 1)}
    same = integrity.universe_hash({"a": result.evidence, "b": result.clusters.repartition(7)}).collect()
    assert same[0]["universe_hash"] == same[1]["universe_hash"]


def test_sample_gate_counts_wrong_samples(valid_run):
    result, _ = valid_run
    wrong = result.profiles.withColumn(
        "sample_video_ids", F.concat(F.slice("sample_video_ids", 1, 3), F.array(F.lit("nobody")))
    )
    row = integrity.gate_sample_validity(wrong, result.evidence, result.clusters, SETTINGS).first()
    assert tuple(row) == (9, 12, 0.75)


def test_actions(values):
    found = values(
        cards.recommended_action,
        ["", "low_congruence", "low_congruence;low_anchor_coverage", "mixed_topic", "platform_bucket"],
    )
    assert found == ["good", "review", "quarantine_low_evidence", "review", "quarantine_low_evidence"]


def test_index_defaults_without_profile(valid_run):
    result, _ = valid_run
    index = cards.cluster_index(result.clusters, result.profiles.limit(0), SETTINGS)
    row = index.first()
    assert (row["flags"], row["coherence_score"], row["keyword_congruence_score"]) == (
        "low_anchor_coverage",
        0.0,
        0.0,
    )


def test_anchors_withheld_on_low_quality(valid_run):
    result, _ = valid_run
    weak = result.profiles.withColumn("anchor_coverage", F.lit(0.1))
    card = cards.cards(result.clusters, result.evidence, weak, result.scores, SETTINGS).first()["card_md"]
    assert "Anchors withheld due to quality thresholds." in card and "- **HANDLE**" not in card


def test_anchor_limits(spark):
    members = spark.createDataFrame([(str(i), 1) for i in range(30)], "video_id string, cluster_id int")
    mentions = spark.createDataFrame(
        [(str(i), "PERSON", f"p{j:02d}") for i in range(30) for j in range(i, 30)],
        "video_id string, entity_type string, entity_canon string",
    )
    rows = {r["rank"]: r for r in profiles.anchors(members, mentions).collect()}
    assert len(rows) == 10
    assert (rows[1]["entity"], rows[1]["support"], rows[1]["coverage"]) == ("p29", 30, 1.0)
    quality = profiles.anchor_quality(members, mentions, profiles.anchors(members, mentions)).first()
    assert (quality["anchor_coverage"], quality["anchor_garbage_rate"]) == (1.0, 0.0)


def test_missing_evidence_is_counted(valid_run):
    result, _ = valid_run
    fewer = result.evidence.filter("video_id > 'v002'")
    assert profiles.missing_evidence(result.clusters, fewer).first()[0] == 3
    assert profiles.cluster_texts(result.clusters, fewer).count() == 33


def test_missing_stage_folder_is_named():
    class Unset:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Unset)
