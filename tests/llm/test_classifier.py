"""The classifier: features and updates against plain versions, held-out accuracy, odd input."""

import math
import os

import numpy as np
import pytest
import xxhash

from clipsieve.llm import classifier
from clipsieve.llm.queries import held_out

FOLDER = "/root/testdata/sf0.01"


def test_features_against_a_plain_version():
    text = "Die Tür, die TÜR! die die 12 12 12 x3\n".encode()
    tokens = [b"Die", "Tür".encode(), b",", b"die", "TÜR".encode(), b"!", b"die", None, b"12", None, None, b"x", b"3"]
    hashes = [xxhash.xxh64_intdigest(b" " if t is None else t, 13) for t in tokens]
    steps, wrap = [int(k) for k in classifier._STEPS], (1 << 64) - 1
    counts = {}
    for i in range(len(hashes)):
        total = 0
        for h in hashes[i : i + 2]:
            total = (total * steps[0] + h * steps[1]) & wrap
            slot = ((total ^ total >> 29) * steps[2] & wrap) >> 46
            counts[slot] = counts.get(slot, 0) + 1
    slots, values = classifier.features(text)
    n = sum(counts.values())
    assert dict(zip(slots.tolist()[:-1], values.tolist()[:-1])) == pytest.approx({k: math.sqrt(v / n) for k, v in counts.items()})
    assert (slots[-1], values[-1]) == (classifier.SLOTS, 1)
    assert classifier.features(b" \n")[0].tolist() == [classifier.SLOTS]


def test_updates_against_a_plain_version():
    rng = np.random.default_rng(1)
    leader = classifier.Leader(np.zeros(6), np.zeros(6), 0.7, 1.0, 0.05, 0.1)
    z, n = [0.0] * 6, [0.0] * 6

    def weight(i):
        if abs(z[i]) <= 0.05:
            return 0.0
        return -(z[i] - math.copysign(0.05, z[i])) / ((1 + math.sqrt(n[i])) / 0.7 + 0.1)

    for _ in range(50):
        slots = np.sort(rng.choice(6, 3, replace=False))
        values, label = rng.random(3), int(rng.integers(2))
        w = [weight(i) for i in slots]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, values))))
        for i, v, old in zip(slots, values, w):
            g = (p - label) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.7 * old
            n[i] += g * g
        leader.learn(slots, values, label)
        assert leader.z.tolist() == pytest.approx(z) and leader.n.tolist() == pytest.approx(n)
    assert leader.weights().tolist() == pytest.approx([weight(i) for i in range(6)])


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"{FOLDER} is not there")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = classifier.fit(docs.where(~held_out()), labels)
    scored = classifier.score(docs.where(held_out()), model).join(labels, "doc_id").collect()
    good = [r["predicted"] for r in scored if r["quality"] == 1]
    bad = [r["predicted"] for r in scored if r["quality"] == 0]
    assert len(good) > 50 and np.mean(good) > 0.98 and np.mean(bad) < 0.3


def labelled(spark, docs):
    rows = [(i, i % 2, "x") for i in range(0, 40)] + [(3, None, "x"), (None, 1, "x"), (1, 1, "x"), (999, 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, quality int, text string")


def test_odd_rows(spark, rows, docs, repeated):
    labels = labelled(spark, docs)
    model = classifier.fit(docs, labels, passes=2)
    again = classifier.fit(repeated, labels, passes=2, rows=10)
    for frame, n in ((docs, len(rows)), (repeated, repeated.count())):
        for m in (model, again):
            scored = classifier.score(frame, m).collect()
            assert len(scored) == n and all(0 <= r["score"] <= 1 for r in scored)
            assert all(r["predicted"] == (r["score"] >= 0.3) for r in scored)
    by_text = {r["doc_id"]: r["score"] for r in classifier.score(docs, model).collect()}
    assert by_text[100] == by_text[101] == by_text[102]


def test_copies_count_once(spark, docs):
    labels = labelled(spark, docs)
    once = classifier.fit(docs, labels, passes=2).weights
    twice = classifier.fit(docs.union(docs).repartition(5), labels, passes=2).weights
    assert np.array_equal(once, twice)


def test_no_examples(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = classifier.fit(docs, none, passes=1)
    assert not model.weights.any()
    assert {r["score"] for r in classifier.score(docs, model).collect()} == {0.5}
    assert classifier.score(empty, model).collect() == []
