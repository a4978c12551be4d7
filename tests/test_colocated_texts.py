"""Texts of members are dealt out over all tasks, however few bytes they have."""

from pyspark.sql import functions as F

from clipsieve import Settings
from clipsieve.operators import profiles, tfidf
from clipsieve.session import deal_out


def few_bytes(spark):
    rows = [(i % 3, str(i), f"word{i % 7} red car {i}", ["tag one"]) for i in range(400)]
    return spark.createDataFrame(
        rows, "cluster_id int, video_id string, topic_text string, hashtags_list_norm array<string>"
    )


def test_small_texts_are_not_gathered_in_one_task(spark):
    rows = few_bytes(spark)
    cores = spark.sparkContext.defaultParallelism
    dealt = deal_out(rows, "video_id")
    assert dealt.groupBy(F.spark_partition_id()).count().count() >= cores
    assert sorted(dealt.collect()) == sorted(rows.collect())


def test_written_member_texts_lie_in_many_files(spark, monkeypatch):
    written, plain = [], profiles.materialize
    monkeypatch.setattr(profiles, "materialize", lambda df: written.append(plain(df)) or written[-1])
    rows = few_bytes(spark)
    evidence = rows.drop("cluster_id").withColumn("insufficient_topic_evidence", F.lit(False))
    mentions = spark.createDataFrame([], "video_id string, entity_type string, entity_canon string")
    metrics = rows.groupBy("cluster_id").agg(F.lit(1.0).alias("coherence"), F.lit(0.0).alias("pct_insufficient_topic"))
    found = profiles.build_profiles(evidence, rows.select("cluster_id", "video_id"), metrics, mentions, Settings(), [])
    assert sorted((r["cluster_id"], r["size"]) for r in found.collect()) == [(0, 134), (1, 133), (2, 133)]
    assert len(written[0].inputFiles()) >= spark.sparkContext.defaultParallelism


def test_keywords_do_not_depend_on_how_texts_lie(spark):
    rows = few_bytes(spark)
    one = tfidf.cluster_keywords(rows.coalesce(1), Settings(), [])
    many = tfidf.cluster_keywords(rows.repartition(9), Settings(), [])
    assert sorted(one.collect()) == sorted(many.collect())
