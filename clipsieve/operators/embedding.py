"""Dense vectors of the topic texts: a user's encoder, or TF-IDF reduced by a randomized SVD."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsieve import schemas
from clipsieve.operators.hooks import Encoder, encode
from clipsieve.operators.tfidf import tfidf_vectors
from clipsieve.session import materialize
from clipsieve.settings import Settings

OVERSAMPLING = 10
POWER_PASSES = 5
# Non-zero entries and rows handled at once within a task; bound the temporary arrays, and keep the dense cells of a
# slice close to its entries, whether texts are long or short.
_CHUNK_ENTRIES = 4096
_CHUNK_ROWS = 32
# Terms whose partial sums travel as one row.
_BLOCK_TERMS = 64
# Slices in which the tasks' sums of a block are added up first, if there are more tasks.
_SALTS = 64


def _chunks(batch: pa.RecordBatch, terms: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Slices ``(matrix, columns, first row)`` of a batch of sparse rows: a dense matrix of some rows and of the
    columns that occur in them."""
    indices = batch.column(batch.schema.get_field_index("indices"))
    columns = indices.flatten().to_numpy(zero_copy_only=False)
    values = batch.column(batch.schema.get_field_index("values")).flatten().to_numpy(zero_copy_only=False)
    lengths = indices.value_lengths().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    place = np.zeros(terms, dtype=np.int64)
    first, start = 0, 0
    while first < len(ends):
        last = int(np.searchsorted(ends, start + _CHUNK_ENTRIES, side="right"))
        last = min(max(first + 1, last), first + _CHUNK_ROWS)
        stop = int(ends[last - 1])
        held = columns[start:stop]
        seen = np.zeros(terms, dtype=bool)
        seen[held] = True
        used = np.flatnonzero(seen)
        place[used] = np.arange(len(used))
        matrix = np.zeros((last - first, len(used)))
        matrix[np.repeat(np.arange(last - first), lengths[first:last]), place[held]] = values[start:stop]
        yield matrix, used, first
        first, start = last, stop


def _lists(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _gram_product(vectors: DataFrame, basis: np.ndarray) -> np.ndarray:
    """``AᵀA · basis`` in one distributed pass.

    Each task adds up its rows' contributions per term; the partial sums are added per term across the
    cluster. Only terms x width numbers reach the driver, whatever the number of rows.
    """
    terms, width = basis.shape

    blocks = -(-terms // _BLOCK_TERMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((blocks * _BLOCK_TERMS, width))
        for batch in batches:
            for matrix, columns, _ in _chunks(batch, terms):
                total[columns] += matrix.T @ (matrix @ basis[columns])
        flat = total.reshape(blocks, _BLOCK_TERMS * width)
        touched = np.flatnonzero(flat.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(touched.astype(np.int32)), _lists(flat[touched])], names=["block", "part"]
        )

    partial = vectors.select("indices", "values").mapInArrow(run, "block int, part array<double>")
    # Two levels if there are many tasks, so that no reducer gets a block from every one.
    levels = [["block", "_salt"], ["block"]] if vectors.rdd.getNumPartitions() > _SALTS else [["block"]]
    summed = partial.withColumn("_salt", F.spark_partition_id() % _SALTS)
    for keys in levels:
        summed = summed.groupBy(*keys).agg(
            vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("part")
        )
    product = np.zeros((blocks, _BLOCK_TERMS * width))
    for row in summed.collect():
        product[row["block"]] = row["part"]
    return product.reshape(-1, width)[:terms]


def truncated_basis(vectors: DataFrame, terms: int, dims: int, seed: int) -> np.ndarray:
    """Right singular vectors (terms x dims) of the rows in ``vectors``, by a seeded randomized SVD.

    ``POWER_PASSES + 1`` passes over the rows, which should therefore be materialized.
    """
    width = min(terms, dims + OVERSAMPLING)
    start = np.random.default_rng(seed).standard_normal((terms, width))
    basis = np.linalg.qr(start)[0]
    for _ in range(POWER_PASSES):
        basis = np.linalg.qr(_gram_product(vectors, basis))[0]
    small = basis.T @ _gram_product(vectors, basis)
    _, rotation = np.linalg.eigh((small + small.T) / 2)
    right = (basis @ rotation)[:, ::-1][:, :dims]
    largest = np.abs(right).argmax(axis=0)
    return right * np.where(right[largest, np.arange(right.shape[1])] < 0, -1.0, 1.0)


def project(vectors: DataFrame, basis: np.ndarray) -> DataFrame:
    """Embedding of every row: its sparse vector times the basis. Narrow; ids travel with the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dense = np.zeros((batch.num_rows, basis.shape[1]))
            for matrix, columns, first in _chunks(batch, len(basis)):
                dense[first : first + len(matrix)] = matrix @ basis[columns]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("run_id")),
                    batch.column(batch.schema.get_field_index("video_id")),
                    _lists(dense),
                ],
                names=["run_id", "video_id", "embedding"],
            )

    return vectors.mapInArrow(run, schemas.EMBEDDINGS)


def tfidf_svd(evidence: DataFrame, settings: Settings) -> DataFrame:
    """``run_id, video_id, embedding`` with ``max(1, min(embedding_dims, terms - 1))`` dimensions.

    Posts without a known term get the zero vector.
    """
    sparse, names = tfidf_vectors(evidence, settings)
    dims = max(1, min(settings.embedding_dims, len(names) - 1))
    if not names:
        zero = F.array(F.lit(0.0)).alias("embedding")
        return sparse.select("run_id", "video_id", zero)
    vectors = materialize(sparse)
    return project(vectors, truncated_basis(vectors, len(names), dims, settings.random_seed))


def embed(
    evidence: DataFrame, settings: Settings, make_encoder: Callable[[], Encoder] | None = None
) -> DataFrame:
    """Embeddings by the user's encoder if there is one, else by TF-IDF and SVD."""
    return encode(evidence, make_encoder) if make_encoder else tfidf_svd(evidence, settings)
