"""K-means whose starts share every pass over the vectors.

The starts are chosen and brought close on a bounded sample, side by side in tasks. Then each pass reads all
vectors once for all starts that still move: one matrix product per batch with the centers of all of them, and
sums per center that are added up in the map tasks. What comes to the driver in a pass is starts x centers x
dimensions numbers from ``_LINES`` tasks at most, whatever the number of rows; beyond that they are added up before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsieve.functions.vectors import unit_rows

#: About so many rows, chosen by hash, are looked at to choose the starts.
SAMPLE_ROWS = 16_384
#: Passes over a sample or over all rows at most, and how far centers may move in the last one.
MAX_PASSES, TOLERANCE = 300, 1e-4
_ROWS_AT_ONCE = 512
#: Lines of so many tasks, for each start, come to the driver as they are.
_LINES = 64
#: Vectors that are kept as one value for the passes.
_BLOCK_ROWS = 512


@dataclass
class KMeansFit:
    centers: np.ndarray
    #: Sum of the squared distances to the nearest centers before the last move.
    cost: float
    passes: int


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _spread_out(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` rows, each chosen with a chance by its squared distance to those before it."""
    chosen = [int(rng.integers(len(rows)))]
    nearest = ((rows - rows[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        total = nearest.sum()
        at = int(rng.choice(len(rows), p=nearest / total)) if total > 0 else int(rng.integers(len(rows)))
        chosen.append(at)
        nearest = np.minimum(nearest, ((rows - rows[at]) ** 2).sum(axis=1))
    return rows[chosen].copy()


def _sums(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Of several sets of centers (start, center, dimension): for each start the sums and numbers of the rows
    nearest to each center, then the cost, in one line."""
    starts, k, dims = centers.shape
    out = np.zeros((starts, k * (dims + 1) + 1))
    flat = np.ascontiguousarray(centers.reshape(-1, dims).T)
    half = (flat**2).sum(axis=0) / 2
    first = np.arange(starts) * k
    sums, counts = np.zeros((starts * k, dims)), np.zeros(starts * k)
    for at in range(0, len(rows), _ROWS_AT_ONCE):
        part = rows[at : at + _ROWS_AT_ONCE]
        closeness = part @ flat
        closeness -= half
        own = closeness.reshape(len(part), starts, k).argmax(axis=2) + first
        member = np.zeros(closeness.shape)
        np.put_along_axis(member, own, 1, axis=1)
        sums += member.T @ part
        counts += member.sum(axis=0)
        out[:, -1] += (part**2).sum() - 2 * np.take_along_axis(closeness, own, axis=1).sum(axis=0)
    out[:, : k * dims] = sums.reshape(starts, -1)
    out[:, k * dims : -1] = counts.reshape(starts, k)
    return out


def _moved(centers: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, float, float]:
    """The means of what is nearest to each center (one without rows stays), the furthest move, the cost."""
    k, dims = centers.shape
    counts = line[k * dims : -1]
    means = line[: k * dims].reshape(k, dims)
    new = np.where(counts[:, None] > 0, means / np.maximum(counts, 1)[:, None], centers)
    return new, float(np.sqrt(((new - centers) ** 2).sum(axis=1)).max(initial=0)), max(float(line[-1]), 0.0)


def _starts(sample: np.ndarray, k: int, seeds: list[int], vectors: DataFrame) -> list[np.ndarray]:
    """Centers that do not move any more on the sample, one set for each seed; each is found in a task."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(sample)

    def refine(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                rows = shared.value
                centers = _spread_out(rows, k, np.random.default_rng(seeds[i]))
                for _ in range(MAX_PASSES):
                    centers, far, _ = _moved(centers, _sums(rows, centers[None])[0])
                    if far <= TOLERANCE:
                        break
                yield pa.RecordBatch.from_pydict({"id": [i], "centers": [centers.tobytes()]})

    tasks = spark.range(0, len(seeds), 1, len(seeds))
    found = {r["id"]: r["centers"] for r in tasks.mapInArrow(refine, "id long, centers binary").collect()}
    shared.unpersist()
    return [np.frombuffer(found[i]).reshape(k, -1) for i in range(len(seeds))]


def _blocks(vectors: DataFrame) -> DataFrame:
    """``rows``: the vectors, some ``_BLOCK_ROWS`` of a task together as the bytes of their doubles, so that a pass
    hands them on as they are. Dealt out evenly over the cores, as a small table may lie in a few files."""

    def run(batches):
        for batch in batches:
            matrix = _matrix(batch.column("embedding"))
            for at in range(0, len(matrix), _BLOCK_ROWS):
                yield pa.RecordBatch.from_pydict({"rows": [matrix[at : at + _BLOCK_ROWS].tobytes()]})

    blocks = vectors.select("embedding").mapInArrow(run, "rows binary")
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return blocks.repartition(cores) if vectors.rdd.getNumPartitions() < cores else blocks


def _pass(blocks: DataFrame, centers: np.ndarray) -> np.ndarray:
    """One reading of all vectors: the lines of ``_sums`` for each start."""
    kind = pa.schema([("start", pa.int32()), ("line", pa.list_(pa.float64()))])

    def run(batches):
        total = None
        for batch in batches:
            for block in batch.column("rows"):
                found = _sums(np.frombuffer(block.as_buffer()).reshape(-1, centers.shape[2]), centers)
                total = found if total is None else total + found
        if total is not None:
            lines = [pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(lines, schema=kind)

    partial = blocks.mapInArrow(run, "start int, line array<double>")
    if blocks.rdd.getNumPartitions() > _LINES:  # else a second stage takes longer than what it saves
        partial = partial.groupBy("start").agg(vector_to_array(Summarizer.sum(array_to_vector("line"))).alias("line"))
    lines = partial.toArrow()
    total = np.zeros((len(centers), centers[0].size + len(centers[0]) + 1))
    np.add.at(total, lines["start"].to_numpy(), _matrix(lines["line"].combine_chunks()))
    return total


def fit(embeddings: DataFrame, k: int, seeds: list[int], sample_rows: int = SAMPLE_ROWS) -> KMeansFit:
    """The cheapest of the fits that begin with each seed, with ``min(k, rows)`` centers, at least one.

    Takes ``video_id, embedding``, all vectors of one length. The vectors are kept in memory and on disk for the
    passes, in blocks. A start whose centers move by ``TOLERANCE`` at most leaves the following passes. Equal costs go to
    the earlier seed. Without rows the one center has no dimensions.
    """
    vectors = embeddings.select("video_id", "embedding").persist(StorageLevel.MEMORY_AND_DISK)
    blocks = None
    try:
        n = vectors.count()
        if not n:
            return KMeansFit(np.zeros((1, 0)), 0.0, 0)
        chosen = F.lit(True) if n <= sample_rows else F.xxhash64("video_id") < int((sample_rows / n - 0.5) * 2**64)
        ordered = vectors.where(chosen).orderBy(F.xxhash64("video_id"), "video_id").select("embedding")
        sample = np.array([r["embedding"] for r in ordered.collect()], float)
        k = min(k, n)
        starts = _starts(sample, k, seeds, vectors)
        fits = [KMeansFit(centers, np.inf, 0) for centers in starts]
        moving = list(range(len(fits)))
        blocks = _blocks(vectors).persist(StorageLevel.MEMORY_AND_DISK)
        blocks.count()
        vectors.unpersist()
        while moving and fits[moving[0]].passes < MAX_PASSES:
            lines = _pass(blocks, np.stack([fits[s].centers for s in moving]))
            still = []
            for s, line in zip(moving, lines):
                new, far, cost = _moved(fits[s].centers, line)
                fits[s] = KMeansFit(new, cost, fits[s].passes + 1)
                if far > TOLERANCE:
                    still.append(s)
            moving = still
        return min(fits, key=lambda f: f.cost)
    finally:
        vectors.unpersist()
        if blocks is not None:
            blocks.unpersist()


def nearest_and_strength(embedding: Column, centers: np.ndarray) -> Column:
    """``cluster_id`` of the nearest center (of several the first) and ``strength``, the largest cosine to any."""
    directions, half = unit_rows(centers).T, (centers**2).sum(axis=1) / 2

    @F.pandas_udf("cluster_id int, strength double")
    def placed(vectors: pd.Series) -> pd.DataFrame:
        if vectors.empty:
            return pd.DataFrame({"cluster_id": pd.Series([], dtype="int32"), "strength": pd.Series([], dtype=float)})
        rows = np.stack(vectors.to_list()).astype(float)
        return pd.DataFrame(
            {
                "cluster_id": (rows @ centers.T - half).argmax(axis=1).astype("int32"),
                "strength": (unit_rows(rows) @ directions).max(axis=1),
            }
        )

    return placed(embedding)
