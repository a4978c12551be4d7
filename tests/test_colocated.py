"""Stages that lie together by id: plans without exchanges, rows as before, files for any reader."""

import re

import pytest
from pyspark.sql import functions as F

from clipsieve.operators import cards, clustering, integrity, lexicon, profiles
from clipsieve.sources.colocated import write_colocated

BUCKETS = 5


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("colocated")
    evidence = spark.range(400).select(
        F.format_string("v%03d", "id").alias("video_id"),
        F.concat(F.lit("some words of "), "id").alias("topic_text"),
        F.array(F.col("id").cast("string")).alias("hashtags_list_norm"),
        F.concat(F.lit("desc "), "id").alias("desc_raw"),
        (F.col("id") % 3 == 0).alias("insufficient_topic_evidence"),
    )
    # A third of all members are in one cluster.
    clusters = spark.range(50, 450).select(
        F.lit("r").alias("run_id"), F.format_string("v%03d", "id").alias("video_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).cast("int").alias("cluster_id"),
        (F.col("id") / 450).alias("strength"),
    )
    scores = spark.range(400).select(
        F.format_string("v%03d", "id").alias("video_id"), (F.col("id") % 5).cast("double").alias("sentiment_polarity")
    )
    plain = {"evidence": evidence, "clusters": clusters, "scores": scores}
    together = {name: write_colocated(rows, f"{base}/{name}", buckets=BUCKETS) for name, rows in plain.items()}
    return base, plain, together


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


JOINS = {
    "texts": lambda s: profiles.cluster_texts(s["clusters"], s["evidence"]),
    "insufficient": lambda s: clustering.insufficient_share(s["clusters"], s["evidence"]),
    "sentiment": lambda s: lexicon.cluster_sentiment(s["clusters"], s["scores"]),
    "exemplars": lambda s: cards.exemplars(s["clusters"], s["evidence"]),
    "missing": lambda s: profiles.missing_evidence(s["clusters"], s["evidence"]),
    "differences": lambda s: integrity.universe_differences({k: s[k] for k in ("evidence", "clusters", "scores")}),
}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(JOINS))
def test_rows_are_the_same(stages, name):
    _, plain, together = stages
    expected, found = ([str(r) for r in JOINS[name](s).collect()] for s in (plain, together))
    assert sorted(found) == sorted(expected) and found


@pytest.mark.parametrize("name", ["texts", "insufficient", "sentiment", "missing"])
def test_ids_are_not_dealt_out_again(stages, no_broadcast, name):
    _, plain, together = stages
    assert re.search(r"Exchange hashpartitioning\(video_id", plan(JOINS[name](plain)))
    assert not re.search(r"Exchange hashpartitioning\(video_id", plan(JOINS[name](together)))


def test_exemplars_move_and_the_evidence_does_not(stages, no_broadcast):
    _, _, together = stages
    text = plan(JOINS["exemplars"](together))
    scans = re.findall(r"FileScan parquet[^\n]*desc_raw[^\n]*", text)
    assert len(scans) == 1 and f"{BUCKETS} out of {BUCKETS}" in scans[0]
    # Up from the scan of the evidence there is no exchange before the join.
    above = text[: text.index(scans[0])].splitlines()
    assert "Exchange" not in "".join(above[-4:])


def test_one_file_a_bucket_also_for_stages_made_from_others(spark, stages):
    base, _, together = stages
    derived = write_colocated(together["evidence"].select("video_id"), f"{base}/derived", buckets=BUCKETS, dealt=True)
    assert len(list((base / "evidence").glob("*.parquet"))) == BUCKETS
    assert len(list((base / "derived").glob("*.parquet"))) == BUCKETS
    joined = derived.join(together["clusters"], "video_id")
    assert joined.count() == 350


def test_files_are_plain_and_replaced(spark, stages, tmp_path):
    path = str(tmp_path / "rows")
    for n in (30, 20):
        rows = spark.range(n).select(F.when(F.col("id") > 2, F.col("id").cast("string")).alias("video_id"))
        assert write_colocated(rows, path, buckets=3).where("video_id is null").count() == 3
    assert spark.read.parquet(path).count() == 20
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("colocated_")]
    empty = write_colocated(spark.range(0).select(F.col("id").cast("string").alias("video_id")), path, buckets=3)
    assert empty.count() == 0
