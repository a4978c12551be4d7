"""The passes over vectors: what a task holds, what moves, and the rows of the facts against plain numpy."""

import contextlib
import io

import numpy as np
import pyarrow as pa

from checks import spark_queries
from clipsieve import Settings
from clipsieve.operators import clustering, embedding, kmeans


def plan(rows):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        rows.explain()
    return out.getvalue()


def sparse(rng, rows, terms, most):
    lists = [np.sort(rng.choice(terms, rng.integers(0, most + 1), replace=False)) for _ in range(rows)]
    values = [rng.normal(size=len(x)) for x in lists]
    columns = [pa.array([x.tolist() for x in lists], pa.list_(pa.int32())), pa.array([x.tolist() for x in values], pa.list_(pa.float64()))]
    dense = np.zeros((rows, terms))
    for row, (x, y) in enumerate(zip(lists, values)):
        dense[row, x] = y
    return pa.RecordBatch.from_arrays(columns, names=["indices", "values"]), dense


def test_slices_are_bounded_and_whole():
    for most in (3, 400):
        batch, dense = sparse(np.random.default_rng(7), 300, 500, most)
        seen = np.zeros_like(dense)
        for matrix, columns, first in embedding._chunks(batch, 500):
            assert len(matrix) <= embedding._CHUNK_ROWS
            assert np.count_nonzero(matrix) <= max(embedding._CHUNK_ENTRIES, 500)
            assert len(columns) <= max(1, np.count_nonzero(matrix)) and matrix.shape[1] == len(columns)
            seen[first : first + len(matrix), columns] = matrix
        assert (seen == dense).all()


def test_pass_over_sparse_rows_is_the_gram_product(spark):
    batch, dense = sparse(np.random.default_rng(8), 200, 150, 20)
    basis = np.random.default_rng(9).normal(size=(150, 4))
    rows = list(zip(batch.column("indices").to_pylist(), batch.column("values").to_pylist()))
    for parts in (3, embedding._SALTS + 6):  # summed at once, and in slices first
        frame = spark.createDataFrame(rows, "indices array<int>, values array<double>").repartition(parts)
        assert np.allclose(embedding._gram_product(frame, basis), dense.T @ (dense @ basis))


def test_products_of_components_are_summed_in_the_tasks(spark):
    matrix = np.random.default_rng(4).normal(size=(500, 6))
    rows = spark.createDataFrame([([float(x) for x in row],) for row in matrix], "embedding array<double>").repartition(4)
    found = spark_queries._products(rows)
    assert "Generate" not in plan(found)  # no row for each pair of components of each vector
    gram = np.zeros((6, 6))
    for row in found.collect():
        gram[row["i"], row["j"]] = row["p"]
    assert np.allclose(gram, matrix.T @ matrix)


def test_stages_on_vectors_write_only_what_they_read(spark, tmp_path):
    documents = spark.createDataFrame(
        [(i, f"red car {i}", "en", "web") for i in range(5)], "doc_id bigint, text string, lang string, source string"
    )
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark_queries.topic_rows(spark, str(tmp_path), "insufficient_topic_evidence")
    assert rows.count() == 5
    assert rows.columns == ["run_id", "video_id", "topic_text", "insufficient_topic_evidence"]


def test_vectors_are_dealt_out_in_blocks(spark):
    matrix = np.random.default_rng(5).normal(size=(3000, 5))
    data = [(str(i), [float(x) for x in row]) for i, row in enumerate(matrix)]
    frame = spark.createDataFrame(data, "video_id string, embedding array<double>").coalesce(1)
    blocks = kmeans._blocks(frame)
    assert blocks.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    held = [np.frombuffer(r["rows"]).reshape(-1, 5) for r in blocks.collect()]
    assert max(map(len, held)) <= kmeans._BLOCK_ROWS
    assert sorted(map(tuple, np.concatenate(held))) == sorted(map(tuple, matrix))


def test_pass_is_the_same_from_few_and_many_tasks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    matrix, centers = rng.normal(size=(2000, 5)), rng.normal(size=(3, 7, 5))
    data = [(str(i), [float(x) for x in row]) for i, row in enumerate(matrix)]
    blocks = kmeans._blocks(spark.createDataFrame(data, "video_id string, embedding array<double>"))
    few = kmeans._pass(blocks, centers)
    monkeypatch.setattr(kmeans, "_LINES", 1)
    assert np.allclose(kmeans._pass(blocks, centers), few)
    for start, line in zip(centers, few):
        apart = ((matrix[:, None] - start) ** 2).sum(axis=2)
        own = apart.argmin(axis=1)
        assert np.allclose(line[:35].reshape(7, 5), [matrix[own == c].sum(axis=0) for c in range(7)])
        assert (line[35:-1] == np.bincount(own, minlength=7)).all()
        assert np.isclose(line[-1], apart.min(axis=1).sum())


def test_placed_rows_are_judged_as_numpy_does(spark):
    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(600, 4))
    matrix[0] = 0
    data = [("r", str(i), [float(x) for x in row]) for i, row in enumerate(matrix)]
    frame = spark.createDataFrame(data, "run_id string, video_id string, embedding array<double>")
    model = clustering.fit_kmeans(frame, Settings(clustering_k=5, kmeans_starts=2))
    judged = spark_queries._judged(clustering.assign(frame, model), model.centers)
    assert "aggregate(" not in plan(judged).lower()  # no lambda for each component
    apart = ((matrix[:, None] - model.centers) ** 2).sum(axis=2).min(axis=1)
    rows = judged.collect()
    assert np.allclose(sorted(r["least"] for r in rows), sorted(apart))
    assert all(abs(r["own"] - r["least"]) < 1e-9 and abs(r["best"] - r["strength"]) < 1e-9 for r in rows)
