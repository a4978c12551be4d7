"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors are centred, rotated by matrices learned on a sample (iterative quantisation) and cut to one bit per
axis. A code is split into substrings, each with an index from value to rows. If two codes of m substrings
differ in less than m * (s + 1) bits, some substring differs in at most s: probing all values within s of the
query's substrings therefore finds every code in that radius. The radius grows until it holds enough codes;
these are ranked again by the cosine of the vectors themselves.

Vectors and queries meet block by block, so a task holds one block of each, whatever the table's size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BITS, SUBSTRING = 128, 16
#: Rows of the sample that the rotations are learned on, and rounds of learning.
SAMPLE_ROWS, ROUNDS = 4096, 30
#: Rows of a block, queries of a block; codes that the radius must hold, in each block.
BLOCK_ROWS, QUERY_ROWS, LEAST_CODES = 8192, 16_384, 1024


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Codes:
    """Codes of unit vectors: the side of ``mean`` on each of the ``axes``."""

    mean: np.ndarray
    axes: np.ndarray

    def of(self, units: np.ndarray) -> np.ndarray:
        """One row of 16-bit substrings per vector."""
        bits = (units - self.mean) @ self.axes > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint16)


def learn(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 7) -> Codes:
    units = _unit(sample)
    mean = units.mean(axis=0)
    centred, size = units - mean, units.shape[1]
    _, directions = np.linalg.eigh(centred.T @ centred)
    turned, random, axes = centred @ directions, np.random.default_rng(seed), []
    for _ in range(-(-bits // size)):
        rotation, _ = np.linalg.qr(random.normal(size=(size, size)))
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(turned @ rotation > 0, 1.0, -1.0).T @ turned)
            rotation = (left @ right).T
        axes.append(directions @ rotation)
    return Codes(mean, np.concatenate(axes, axis=1)[:, :bits])


class Index:
    """Codes of one block: for each substring its values and the rows of each value."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.ascontiguousarray(codes)
        self.words = self.codes.view(np.uint64)
        self.tables = []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, counts = np.unique(column, return_counts=True)
            self.tables.append((values, counts, order))

    def within(self, code: np.ndarray, least: int) -> np.ndarray:
        """The rows of all codes in the smallest probed radius that holds ``least`` codes, or of all."""
        n, m = len(self.codes), len(self.tables)
        distance = np.full(n, 1 << 20, np.int64)  # of the rows found so far
        apart = [np.bitwise_count(values ^ part) for (values, _, _), part in zip(self.tables, code)]
        word = code.view(np.uint64)
        for s in range(SUBSTRING + 1):
            found = [order[np.repeat(d == s, counts)] for d, (_, counts, order) in zip(apart, self.tables)]
            new = np.concatenate(found)
            new = new[distance[new] == 1 << 20]
            distance[new] = np.bitwise_count(self.words[new] ^ word).sum(axis=1)
            inside = np.flatnonzero(distance < m * (s + 1))
            if len(inside) >= least:
                # Every code in this radius is found, so those in the smallest sufficient one are too.
                radius = np.partition(distance[inside], least - 1)[least - 1]
                return inside[distance[inside] <= radius]
        return np.arange(n)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows that take part: an id, and a vector of finite components that are
    not all zero and of the most frequent length (the greater of equals)."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    top = sizes.limit(1).collect()
    return rows.where(F.size("embedding") == (top[0]["size"] if top else 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    bits: int = BITS,
    least_codes: int = LEAST_CODES,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vec_id, embedding`` with ``is_query`` its ``k``
    nearest found, by cosine in double precision, ties to the smaller id; all candidates if they are fewer.

    Rows whose vector is null, zero, of another length than most, or has null or non-finite components take
    no part, nor do null ids. A candidate has another id than the query. Rows that repeat an id are
    candidates each; of queries that repeat one the least vector is asked. An empty table gives no row.
    """
    rows = usable(vectors)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toArrow()
    empty = "query_id long, rank int, vec_id long, score double"
    if not sample.num_rows:
        return vectors.sparkSession.createDataFrame([], empty)
    codes = learn(_matrix(sample["embedding"]).astype(np.float64), bits)
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    blocks = max(1, -(-rows.count() // block_rows))
    query_blocks = max(1, -(-queries.count() // query_rows))
    place = F.xxhash64("vec_id")
    left = rows.select(
        "vec_id", "embedding", F.pmod(place, F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("asked"),
    )
    right = queries.select(
        "vec_id", "embedding", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(place, F.lit(query_blocks)).alias("asked"),
    )

    def search(block: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and asked.num_rows:
            ids, units = block["vec_id"].to_numpy(), _unit(_matrix(block["embedding"]).astype(np.float64))
            index = Index(codes.of(units))
            probes = _unit(_matrix(asked["embedding"]).astype(np.float64))
            for query, unit, code in zip(asked["vec_id"].to_pylist(), probes, codes.of(probes)):
                near = index.within(code, least_codes)
                near = near[ids[near] != query]
                score = units[near] @ unit
                best = np.lexsort((ids[near], -score))[:k]
                out += zip([query] * len(best), ids[near[best]].tolist(), score[best].tolist())
        columns = list(zip(*out)) if out else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    found = (
        left.groupBy("block", "asked")
        .cogroup(right.groupBy("block", "asked"))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
