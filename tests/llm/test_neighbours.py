import numpy as np
import pytest
from pyspark.sql import functions as F

from clipsieve.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, rank int, block string, asked string"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 24))
    return (centres[rng.integers(0, 6, 3000)] + rng.normal(size=(3000, 24))).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "b", "a") for r in rows], SCHEMA)


def exact(ids, x, query, k):
    units = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    score = units @ units[ids.tolist().index(query)]
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != query][:k]
    return [int(ids[i]) for i in order], score[order]


def test_recall_and_scores(spark, vectors):
    rows = frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])
    found = neighbours.nearest(rows, F.col("vec_id") % 50 == 0, least_codes=128, block_rows=1000, query_rows=25)
    by_query = {}
    for r in found.collect():
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids, hits = np.arange(len(vectors)), 0
    assert sorted(by_query) == list(range(0, 3000, 50))
    for query, own in by_query.items():
        own.sort()
        best, score = exact(ids, vectors, query, 5)
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        hits += len({v for _, v, _ in own} & set(best))
    assert hits / (5 * len(by_query)) >= 0.9


def test_index_finds_every_code_in_its_radius(vectors):
    codes = neighbours.learn(vectors[:500].astype(float)).of(neighbours._unit(vectors.astype(float)))
    index = neighbours.Index(codes)
    apart = np.bitwise_count(codes ^ codes[7]).sum(axis=1)
    for least in (1, 40, 700, 5000):
        found = index.within(codes[7], least)
        assert len(found) >= min(least, len(codes))
        assert set(found) == set(np.flatnonzero(apart <= apart[found].max()))


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = frame(
        spark,
        [
            (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [4.0, 0.0]), (3, [0.0, 1.0]), (3, [0.0, 2.0]), (None, [1.0, 1.0]),
            (4, None), (5, [0.0, 0.0]), (6, [inf, 1.0]), (7, [nan, 1.0]), (8, [None, 1.0]), (50, [1.0, 2.0, 3.0]),
            (100, [3e38, 3e38]), (0, [1.0, 0.0]),
        ],
    )
    found = neighbours.nearest(rows, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    # Equal scores: the smaller id first; rows that repeat an id are candidates each.
    assert got == {0: [1, 2, 100, 3, 3], 100: [0, 0, 1, 2, 3]}
    assert neighbours.nearest(rows.limit(0), F.lit(True)).collect() == []
