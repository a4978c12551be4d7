"""TF-IDF, SVD, k-means and cluster measures against plain numpy and hand-made values."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipsieve import Settings
from clipsieve.operators import clustering, embedding, kmeans, quantiles, ranking, tfidf
from clipsieve.operators.hooks import encode

TEXTS = {
    "1": "red apple pie apple",
    "2": "green apple tart",
    "3": "fast red car race",
    "4": "slow green car",
    "5": "",
    "6": "a b",
    "7": "race car race track red",
}


def evidence(spark, texts=TEXTS):
    rows = [("r", video_id, text) for video_id, text in texts.items()]
    return spark.createDataFrame(rows, "run_id string, video_id string, topic_text string").repartition(3)


def expected_weights(texts, stop_words=(), max_terms=5000):
    counts = {
        key: Counter(w for w in text.lower().split() if len(w) > 1 and w not in stop_words)
        for key, text in texts.items()
    }
    totals = sum(counts.values(), Counter())
    vocabulary = sorted(totals, key=lambda term: (-totals[term], term))[:max_terms]
    frequency = Counter(term for count in counts.values() for term in count)
    weights = {}
    for key, count in counts.items():
        row = {
            term: n * (math.log((1 + len(texts)) / (1 + frequency[term])) + 1)
            for term, n in count.items()
            if term in vocabulary
        }
        length = math.sqrt(sum(w * w for w in row.values()))
        weights[key] = {term: w / length for term, w in row.items()}
    return weights


@pytest.mark.parametrize("max_terms", [5000, 4])
def test_tfidf_vectors(spark, max_terms):
    vectors, names = tfidf.tfidf_vectors(evidence(spark), Settings(max_terms=max_terms))
    expected = expected_weights(TEXTS, max_terms=max_terms)
    assert names == sorted(names) and len(names) == min(max_terms, 10)
    for row in vectors.collect():
        found = {names[i]: v for i, v in zip(row["indices"], row["values"])}
        assert found == pytest.approx(expected[row["video_id"]])


def test_cluster_keywords(spark):
    groups = {1: ["1", "2", "5"], 2: ["3", "4", "6", "7"]}
    rows = [
        (cluster, key, TEXTS[key], [f"tag {key}", "shared one"]) for cluster, keys in groups.items() for key in keys
    ]
    texts = spark.createDataFrame(
        rows, "cluster_id int, video_id string, topic_text string, hashtags_list_norm array<string>"
    )
    found = tfidf.cluster_keywords(texts, Settings(), ["red", "one"]).collect()
    for cluster, keys in groups.items():
        for view, source in (
            ("desc", {key: TEXTS[key] for key in keys}),
            ("hashtags", {key: f"tag {key} shared one" for key in keys}),
        ):
            weights = expected_weights(source, ["red", "one"])
            means = Counter()
            for row in weights.values():
                means.update({term: w / len(keys) for term, w in row.items()})
            best = sorted(means, key=lambda term: (-round(means[term], 10), term))[:15]
            listed = sorted((r["rank"], r["term"], r["score"]) for r in found if (r["cluster_id"], r["view"]) == (cluster, view))
            assert [term for _, term, _ in listed] == best
            assert [score for _, _, score in listed] == pytest.approx([means[term] for term in best])
    lists = {row["cluster_id"]: row for row in tfidf.keyword_lists(tfidf.cluster_keywords(texts, Settings(), [])).collect()}
    assert lists[1]["keyword_congruence"] == 0.0
    assert [item["term"] for item in lists[1]["keywords_hashtags"]] == ["one", "shared", "tag"]


def test_no_vocabulary_gives_no_keywords_and_zero_vectors(spark):
    rows = evidence(spark, {"1": "", "2": "a"})
    assert [row["embedding"] for row in embedding.embed(rows, Settings()).collect()] == [[0.0], [0.0]]
    texts = rows.select(F.lit(1).alias("cluster_id"), "video_id", "topic_text", F.array(F.lit("")).alias("hashtags_list_norm"))
    assert tfidf.cluster_keywords(texts, Settings(), []).count() == 0


def test_svd_matches_exact_decomposition(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    texts = {
        str(i): " ".join(rng.choice(words[: 10 + i % 30], size=12)) for i in range(200)
    }
    rows = evidence(spark, texts)
    settings = Settings(embedding_dims=6)
    vectors, names = tfidf.tfidf_vectors(rows, settings)
    dense = np.zeros((len(texts), len(names)))
    for row in vectors.collect():
        dense[int(row["video_id"]), row["indices"]] = row["values"]
    singular = np.linalg.svd(dense, compute_uv=False)[:6]
    found = embedding.embed(rows, settings)
    matrix = np.zeros((len(texts), 6))
    for row in found.collect():
        matrix[int(row["video_id"])] = row["embedding"]
    assert np.linalg.norm(matrix, axis=0) == pytest.approx(singular, rel=2e-2)
    # Distances between posts are those of the best approximation of this rank.
    left, values, _ = np.linalg.svd(dense, full_matrices=False)
    exact = left[:, :3] * values[:3]
    assert matrix[:, :2] @ matrix[:, :2].T == pytest.approx(exact[:, :2] @ exact[:, :2].T, abs=0.05)


def test_small_chunks_change_nothing(spark, monkeypatch):
    rows = evidence(spark)
    first = {r["video_id"]: r["embedding"] for r in embedding.embed(rows, Settings(embedding_dims=3)).collect()}
    monkeypatch.setattr(embedding, "_CHUNK_ENTRIES", 2)
    second = {r["video_id"]: r["embedding"] for r in embedding.embed(rows, Settings(embedding_dims=3)).collect()}
    assert first.keys() == second.keys() == TEXTS.keys()
    for key, vector in first.items():
        assert second[key] == pytest.approx(vector, abs=1e-9)
    assert first["5"] == [0.0, 0.0, 0.0]


def test_encoder_runs_once_per_partition(spark):
    def make_encoder():
        return lambda texts: np.array([[len(text), 1.0] for text in texts])

    rows = encode(evidence(spark), make_encoder).collect()
    assert {row["video_id"]: row["embedding"][0] for row in rows} == {k: len(v) for k, v in TEXTS.items()}


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(120):
        center = [(5, 0, 0), (0, 5, 0), (0, 0, 5)][i % 3]
        rows.append(("r", str(i), [float(x) for x in rng.normal(center, 0.3)]))
    return spark.createDataFrame(rows, "run_id string, video_id string, embedding array<double>")


def test_kmeans_finds_separate_groups(points):
    settings = Settings(clustering_k=3, kmeans_starts=3)
    model = clustering.fit_kmeans(points, settings)
    rows = clustering.assign(points, model).collect()
    groups = {}
    for row in rows:
        groups.setdefault(int(row["video_id"]) % 3, set()).add(row["cluster_id"])
        assert -1.0 <= row["strength"] <= 1.0 + 1e-12
    assert sorted(len(g) for g in groups.values()) == [1, 1, 1]
    assert len(rows) == 120
    single = clustering.fit_kmeans(points, Settings(clustering_k=5, kmeans_starts=1))
    several = clustering.fit_kmeans(points, Settings(clustering_k=5, kmeans_starts=4))
    assert several.cost <= single.cost + 1e-9


def test_k_is_at_most_the_number_of_rows(points):
    few = points.filter("video_id in ('0', '1')")
    model = clustering.fit_kmeans(few, Settings(clustering_k=25, kmeans_starts=1))
    assert len(model.centers) == 2


def lloyd(rows, centers):
    """Plain passes until nothing moves; returns the cost."""
    while True:
        own = ((rows[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([rows[own == c].mean(axis=0) if (own == c).any() else x for c, x in enumerate(centers)])
        if np.abs(new - centers).max() < 1e-9:
            return ((rows - centers[own]) ** 2).sum()
        centers = new


@pytest.mark.parametrize("sample_rows", [150, 16384])
def test_shared_passes_cost_no_more_than_separate_fits(spark, sample_rows):
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(900, 6)) + 4 * rng.integers(0, 2, (900, 6))
    data = [(f"v{i}", [float(x) for x in row]) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(data, "video_id string, embedding array<double>").repartition(5)
    found = kmeans.fit(frame, 8, list(range(6)), sample_rows)
    plain = [lloyd(rows, rows[np.random.default_rng(s).choice(900, 8, replace=False)]) for s in range(10)]
    own = ((rows[:, None] - found.centers) ** 2).sum(axis=2).min(axis=1).sum()
    assert own == pytest.approx(found.cost, rel=1e-3)
    assert own <= 1.01 * min(plain)
    again = kmeans.fit(frame.repartition(2), 8, list(range(6)), sample_rows)
    assert again.cost == pytest.approx(found.cost, rel=0.01)


def test_one_job_in_a_pass_whatever_the_starts(spark, points, monkeypatch):
    passes, plain = [], kmeans._pass
    monkeypatch.setattr(kmeans, "_pass", lambda vectors, centers: passes.append(len(centers)) or plain(vectors, centers))
    found = kmeans.fit(points, 3, [1, 2, 3, 4, 5], sample_rows=30)
    assert passes[0] == 5 and passes == sorted(passes, reverse=True)  # starts that stand still leave
    assert found.passes <= len(passes) <= 20


def test_equal_and_missing_rows(spark):
    same = spark.createDataFrame([(str(i), [1.0, 2.0]) for i in range(9)], "video_id string, embedding array<double>")
    found = kmeans.fit(same, 4, [1, 2])
    assert found.cost == 0 and found.centers.tolist() == [[1.0, 2.0]] * 4
    assert kmeans.fit(same.where("false"), 4, [1]).centers.shape == (1, 0)


def test_coherence_and_flags(spark):
    rows = [
        ("r", "1", 0, [1.0, 0.0]),
        ("r", "2", 0, [0.0, 1.0]),
        ("r", "3", 1, [1.0, 0.0]),
        ("r", "4", 1, [-1.0, 0.0]),
        ("r", "5", 2, [0.0, 0.0]),
        ("r", "6", 2, [2.0, 0.0]),
    ]
    members = spark.createDataFrame(rows, "run_id string, video_id string, cluster_id int, embedding array<double>")
    found = {r["cluster_id"]: r["coherence"] for r in clustering.coherence(members).collect()}
    assert found == pytest.approx({0: math.sqrt(0.5), 1: 0.0, 2: 0.5})
    flags = spark.createDataFrame(
        [("1", True), ("2", True), ("3", False), ("6", True)], "video_id string, insufficient_topic_evidence boolean"
    )
    metrics = {r["cluster_id"]: r for r in clustering.cluster_metrics(members, flags).collect()}
    assert {k: m["pct_insufficient_topic"] for k, m in metrics.items()} == {0: 1.0, 1: 0.0, 2: 0.5}
    assert {k: m["platform_bucket"] for k, m in metrics.items()} == {0: True, 1: True, 2: False}
    by_pair = {r["video_id"]: r["cosine"] for r in clustering.cosine_to_centroid(members).collect()}
    assert by_pair["5"] == 0.0 and by_pair["1"] == pytest.approx(math.sqrt(0.5))
    strengths = clustering.membership_strength(members, [[1, 0], [0, -1]]).collect()
    assert {r["video_id"]: r["strength"] for r in strengths} == pytest.approx(
        {"1": 1.0, "2": 0.0, "3": 1.0, "4": 0.0, "5": 0.0, "6": 1.0}
    )


def test_quantiles_of_skewed_groups(spark):
    rng = np.random.default_rng(11)
    groups = {
        0: rng.normal(size=30_000),
        1: np.repeat([0.25, 0.5], [20_000, 20_001]),
        2: np.array([0.7]),
        3: rng.integers(0, 3, size=12) / 7,
        4: np.concatenate([np.full(15_000, 0.9), rng.uniform(0.9, 0.9001, size=15_000)]),
    }
    rows = [(key, float(v)) for key, data in groups.items() for v in data]
    frame = spark.createDataFrame(rows, "cluster_id int, strength double").repartition(6)
    probabilities = (0.0, 0.25, 0.5, 0.75, 1.0)
    found = quantiles.exact_quantiles(frame, "cluster_id", "strength", probabilities).collect()
    for key, data in groups.items():
        mine = {r["probability"]: r["quantile"] for r in found if r["cluster_id"] == key}
        assert mine == pytest.approx({q: np.quantile(data, q) for q in probabilities}, abs=1e-12)


@pytest.mark.parametrize("limit", ["5", "1000"])
def test_large_top_n_equals_plain_ranking(spark, request, limit):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(key, limit)
    request.addfinalizer(lambda: spark.conf.unset(key))
    rows = [(i % 2 if i % 3 else 0, f"t{i:04d}", (i * 7919) % 97) for i in range(1500)]
    frame = spark.createDataFrame(rows, "g int, term string, total int")
    order = [F.desc("total"), F.asc("term")]
    found = sorted((r["g"], r["rank"], r["term"]) for r in ranking.top_n(frame, ["g"], order, 40).collect())
    expected = []
    for group in (0, 1):
        inside = sorted((-total, term) for g, term, total in rows if g == group)[:40]
        expected += [(group, i + 1, term) for i, (_, term) in enumerate(inside)]
    assert found == expected


@pytest.mark.parametrize("accuracy", [10_000, 5])
def test_exact_quantiles_of_skewed_groups(spark, monkeypatch, accuracy):
    """One path for every size; a coarse sketch costs time, not exactness."""
    monkeypatch.setattr(quantiles, "_ACCURACY", accuracy)
    big = spark.range(1_000_000 if accuracy > 5 else 50_000).select(
        F.lit("big").alias("g"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("v")
    )
    ties = spark.range(5000).select(F.lit("ties").alias("g"), F.when(F.col("id") < 4900, 1.0).otherwise(F.col("id")).alias("v"))
    small = spark.createDataFrame([("one", 4.0), ("two", 1.0), ("two", 2.0), ("none", None)], "g string, v double")
    rows = big.unionByName(ties).unionByName(small)
    probabilities = (0.0, 0.25, 0.5, 0.75, 1.0)
    found = {
        (r["g"], r["probability"]): r["quantile"] for r in quantiles.exact_quantiles(rows, "g", "v", probabilities).collect()
    }
    expected = {}
    for name, own in rows.where("v is not null").toPandas().groupby("g"):
        for q in probabilities:
            expected[name, q] = float(np.quantile(own["v"], q))
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-9 for k in expected)


def test_keywords_by_either_join(spark):
    """The plan follows the size of the vocabulary in bytes; the result does not."""
    texts = evidence(spark).select(F.lit(1).alias("cluster_id"), "video_id", "topic_text", F.array().cast("array<string>").alias("hashtags_list_norm"))
    found, plans = [], []
    for limit in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", limit)
        try:
            words = tfidf.cluster_keywords(texts, Settings(), [])
            plans.append(words._jdf.queryExecution().executedPlan().toString())
            found.append(sorted(map(tuple, words.collect())))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert found[0] == found[1]
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
