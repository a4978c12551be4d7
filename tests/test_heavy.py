"""Frequent values by a bounded summary: nothing missed, nothing proven that does not hold."""

import random
from collections import Counter

import pytest

from clipsieve.operators import heavy


def frame(spark, values, parts=6):
    return spark.createDataFrame([(v,) for v in values], "value string").repartition(parts)


def first(values, n):
    """All values that are at least as frequent as the n-th."""
    counts = Counter(v for v in values if v is not None)
    least = sorted(counts.values(), reverse=True)[: n][-1]
    return {v for v, k in counts.items() if k >= least}


def skewed(rng, n=60_000):
    return [f"h{min(int(rng.paretovariate(0.9)), 3000)}" if rng.random() < 0.7 else f"u{rng.random()}" for _ in range(n)]


@pytest.mark.parametrize("seed, n, tracked", [(1, 5, 2000), (2, 20, 4000), (3, 40, 20000)])
def test_candidates_hold_the_first(spark, seed, n, tracked):
    values = skewed(random.Random(seed)) + [None] * 500
    chosen = heavy.candidates(frame(spark, values), n, tracked)
    assert chosen is not None
    found = {r[0] for r in chosen.collect()}
    assert first(values, n) <= found and len(found) <= tracked


def test_a_value_that_each_task_sees_little_of(spark):
    """Frequent in sum, below many others in every single task."""
    values = [f"p{p}v{i}" for p in range(6) for i in range(300) for _ in range(9)] + ["everywhere"] * 60
    random.Random(1).shuffle(values)
    for tracked in (100, 1000, 100_000):
        chosen = heavy.candidates(frame(spark, values), 1, tracked)
        assert chosen is None or "everywhere" in {r[0] for r in chosen.collect()}
    assert chosen is not None


def test_even_values_prove_nothing_in_a_small_summary(spark):
    values = [f"v{i % 5000}" for i in range(40_000)]
    assert heavy.candidates(frame(spark, values), 10, 100) is None


def test_ties_at_the_last_place_are_all_there(spark):
    values = ["a"] * 50 + [f"t{i}" for i in range(30) for _ in range(20)]
    chosen = heavy.candidates(frame(spark, values), 3, 10_000)
    assert {r[0] for r in chosen.collect()} == set(values)


def test_few_and_no_values(spark):
    chosen = heavy.candidates(frame(spark, ["a", "b", "a", None]), 10, 100)
    assert {r[0] for r in chosen.collect()} == {"a", "b"}
    assert heavy.candidates(frame(spark, [None, None]), 10, 100).collect() == []
    assert heavy.candidates(spark.createDataFrame([], "value string"), 10, 100).collect() == []
