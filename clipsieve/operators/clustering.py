"""K-means over the embeddings, membership strength and trust metrics of every cluster."""

from __future__ import annotations

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsieve.functions.vectors import best_cosine, cosine
from clipsieve.operators import kmeans
from clipsieve.operators.kmeans import KMeansFit, nearest_and_strength
from clipsieve.session import materialize
from clipsieve.settings import Settings

MAX_INSUFFICIENT = 0.5
MIN_COHERENCE = 0.2


def fit_kmeans(embeddings: DataFrame, settings: Settings) -> KMeansFit:
    """The cheapest of ``kmeans_starts`` seeded fits with ``min(k, rows)`` centers, at least one; all starts share
    each pass over the vectors."""
    seeds = [settings.random_seed + start for start in range(settings.kmeans_starts)]
    return kmeans.fit(embeddings, settings.clustering_k, seeds)


def membership_strength(embeddings: DataFrame, centers: list) -> DataFrame:
    """Adds ``strength``: the largest cosine to any center, not only the assigned one."""
    strength = best_cosine([list(map(float, center)) for center in centers])
    return embeddings.withColumn("strength", strength(F.col("embedding")))


def assign(embeddings: DataFrame, model: KMeansFit) -> DataFrame:
    """``run_id, video_id, cluster_id, strength, embedding``; narrow, one look at each vector."""
    placed = embeddings.withColumn("_placed", nearest_and_strength(F.col("embedding"), model.centers))
    return placed.select("run_id", "video_id", "_placed.cluster_id", "_placed.strength", "embedding")


def centroids(members: DataFrame) -> DataFrame:
    """``cluster_id, centroid``: mean vector of each cluster's members."""
    return members.groupBy("cluster_id").agg(
        vector_to_array(Summarizer.mean(array_to_vector("embedding"))).alias("centroid")
    )


def cosine_to_centroid(members: DataFrame) -> DataFrame:
    """``video_id, cluster_id, cosine`` of every member to its own cluster's mean.

    The means are written first, so that the planner knows their size in bytes when it chooses the join.
    """
    means = materialize(centroids(members))
    return members.join(means, "cluster_id").select(
        "video_id", "cluster_id", cosine(F.col("embedding"), F.col("centroid")).alias("cosine")
    )


def coherence(members: DataFrame) -> DataFrame:
    """``cluster_id, size, coherence``: mean cosine of the members to their own mean.

    The mean of x·c/(|x||c|) over x is the mean of the unit vectors times the unit centroid, so one
    aggregation with two vector sums per cluster gives it; members are not visited a second time.
    """
    vectors = members.select("cluster_id", array_to_vector("embedding").alias("_vector"))
    unit = Normalizer(p=2.0, inputCol="_vector", outputCol="_unit").transform(vectors)
    means = unit.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"),
        vector_to_array(Summarizer.mean(F.col("_vector"))).alias("_mean"),
        vector_to_array(Summarizer.mean(F.col("_unit"))).alias("_mean_unit"),
    )
    zeros = F.transform("_mean", lambda _: F.lit(0.0))
    length = F.sqrt(F.aggregate("_mean", F.lit(0.0), lambda total, x: total + x * x))
    direction = F.when(length > 0, F.transform("_mean", lambda x: x / length)).otherwise(zeros)
    products = F.zip_with("_mean_unit", direction, lambda a, b: a * b)
    total = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    return means.select("cluster_id", "size", total.alias("coherence"))


def insufficient_share(clusters: DataFrame, evidence: DataFrame) -> DataFrame:
    """``cluster_id, size, pct_insufficient_topic``; members without evidence count as sufficient."""
    flags = evidence.select("video_id", "insufficient_topic_evidence")
    flag = F.coalesce("insufficient_topic_evidence", F.lit(False)).cast("int")
    return (
        clusters.select("video_id", "cluster_id")
        .join(flags, "video_id", "left")
        .groupBy("cluster_id")
        .agg(F.count(F.lit(1)).alias("size"), F.avg(flag).alias("pct_insufficient_topic"))
    )


def is_platform_bucket(pct_insufficient: Column, coherence_score: Column) -> Column:
    return (pct_insufficient > MAX_INSUFFICIENT) | (coherence_score < MIN_COHERENCE)


def cluster_metrics(members: DataFrame, evidence: DataFrame) -> DataFrame:
    """``cluster_id, coherence, pct_insufficient_topic, platform_bucket``: one row per cluster."""
    bucket = is_platform_bucket(F.col("pct_insufficient_topic"), F.col("coherence"))
    return (
        coherence(members)
        .drop("size")
        .join(insufficient_share(members, evidence).drop("size"), "cluster_id")
        .withColumn("platform_bucket", bucket)
    )


def flag_members(members: DataFrame, metrics: DataFrame) -> DataFrame:
    """Members with ``is_noise``; ``metrics`` should be materialized, it has one row per cluster."""
    flags = metrics.select("cluster_id", F.col("platform_bucket").alias("is_noise"))
    return members.join(flags, "cluster_id").select(
        "run_id", "video_id", "cluster_id", "strength", "is_noise"
    )


def cluster_embeddings(
    embeddings: DataFrame, evidence: DataFrame, settings: Settings
) -> tuple[DataFrame, DataFrame]:
    """Clusters and their metrics. Both are written once: the members are read for the coherence, for the
    share without topic and for the flags, and the flags need the metrics."""
    members = materialize(assign(embeddings, fit_kmeans(embeddings, settings)))
    metrics = materialize(cluster_metrics(members, evidence))
    return flag_members(members, metrics), metrics


def cluster_qa(metrics: DataFrame) -> DataFrame:
    """One row: number of clusters, mean and median coherence, number of flagged clusters."""
    return metrics.agg(
        F.count_distinct("cluster_id").alias("clusters"),
        F.avg("coherence").alias("coherence_mean"),
        F.median("coherence").alias("coherence_median"),
        F.count_if("platform_bucket").alias("flagged"),
    )
