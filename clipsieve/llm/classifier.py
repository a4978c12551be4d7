"""Text quality by hashed word n-grams and logistic regression, trained with follow-the-regularised-leader.

A text is a sparse vector: the slots of its hashed n-grams, weighted by the roots of their counts at unit length.
Training passes over a sample of labelled rows that is dealt over shards. In a pass every shard starts from the
same state (two sums for each slot) and updates it example by example; the next state is the mean of what the
shards come to. A score is the logistic of the dot product of a text's slots with the weights.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsieve.llm.texts import map_batches, texts_of
from clipsieve.session import stage_root

#: Slots of hashed n-grams, a power of two, and words of the longest n-gram.
SLOTS, LONGEST = 1 << 18, 2
#: About so many different labelled texts are learnt from, those of least hash (all, where there are fewer); the
#: shards they are dealt over, and passes.
SAMPLE_ROWS, SHARDS, PASSES = 16_000, 8, 6
#: Learning rate and its smoothing, penalties on absolute values and squares.
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.005, 0.01
#: Scores from here on are predicted as 1.
THRESHOLD = 0.3
#: Words remembered by a worker; the table starts anew when it is full.
REMEMBERED_WORDS = 400_000
_LONGEST_REMEMBERED = 48
_SEED = 13
_STEPS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
# Words are runs of letters, of digits or of other signs; bytes from 128 on count as letters.
_PARTS = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff]+")

#: Stands for a piece of text that is the one before once more.
_AGAIN = [xxhash.xxh64_intdigest(b" ", _SEED)]

_known: dict[bytes, list[int]] = {}


def _hashes_of(piece: bytes) -> list[int]:
    """Hashes of the words of a piece of text without white space."""
    found = _known.get(piece)
    if found is None:
        found = [xxhash.xxh64_intdigest(p, _SEED) for p in _PARTS.findall(piece)]
        if len(piece) <= _LONGEST_REMEMBERED:
            if len(_known) >= REMEMBERED_WORDS:
                _known.clear()
            _known[piece] = found
    return found


def features(text: bytes, slots: int = SLOTS, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """The different slots of a text and their values; the last slot (number ``slots``) is always there, at 1."""
    words: list[int] = []
    before = None
    for piece in text.split():
        words += _AGAIN if piece == before else _hashes_of(piece)
        before = piece
    h = np.array(words, np.uint64)
    shift = np.uint64(65 - slots.bit_length())
    grams, total = [], np.zeros(len(h), np.uint64)
    for n in range(min(longest, len(h))):
        total = total[: len(h) - n] * _STEPS[0] + h[n:] * _STEPS[1]
        mixed = total ^ (total >> np.uint64(29))
        grams.append((mixed * _STEPS[2]) >> shift)
    every = np.sort(np.concatenate([np.zeros(0, np.uint64), *grams]))
    if not len(every):
        return np.array([slots], np.int32), np.ones(1)
    starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(every)]]))
    values = np.sqrt(counts / len(every))
    return np.append(every[starts], slots).astype(np.int32), np.append(values, 1.0)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Leader:
    """The state of follow-the-regularised-leader: by slot, adjusted gradient sums and sums of squares."""

    z: np.ndarray
    n: np.ndarray
    alpha: float = ALPHA
    beta: float = BETA
    l1: float = L1
    l2: float = L2

    def weights(self, slots=slice(None)) -> np.ndarray:
        z = self.z[slots]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(self.n[slots])) / self.alpha + self.l2)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        g = (float(logistic(w @ values)) - label) * values
        squares = self.n[slots]
        more = squares + g * g
        self.z[slots] += g - (np.sqrt(more) - np.sqrt(squares)) / self.alpha * w
        self.n[slots] = more


_STATE = pa.schema([("block", pa.int32()), ("z", pa.binary()), ("n", pa.binary())])
_STATE_DDL = "block int, z binary, n binary"
_BLOCK = 1 << 12  # slots whose state travels in a row


def _sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``h, text, label``: about ``rows`` different labelled texts; copies with one label count once. Hashes alone
    are joined to count them, then the texts below a limit."""
    known = labels.where(F.col(label).isNotNull()).select("doc_id", (F.col(label) == 1).cast("int").alias("label"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("h"), "text")
    there = texts.select("doc_id", "h").join(known, "doc_id").agg(F.approx_count_distinct("h")).first()[0]
    if there > rows:
        texts = texts.where(F.col("h") < int((rows / there - 0.5) * 2**64))
    return texts.join(known, "doc_id").select("h", "text", "label").dropDuplicates(["h", "label"])


def _write_sample(sample: DataFrame, slots: int, longest: int, shards: int) -> list[DataFrame]:
    """The examples of each shard as a frame of one partition, in the order of their hashes, read from the
    shared folder."""

    def run(batch):
        found = [features(t, slots, longest) for t in texts_of(batch)]
        yield {
            "h": batch.column("h"), "shard": batch.column("shard"), "label": batch.column("label"),
            "slots": [s for s, _ in found], "values": [v.astype(np.float32) for _, v in found],
        }

    schema = "h long, shard int, label int, slots array<int>, values array<float>"
    dealt = sample.withColumn("shard", F.pmod(F.col("h"), F.lit(shards)).cast("int"))
    examples = map_batches(dealt, ["h", "shard", "label", "text"], run, schema)
    spark = sample.sparkSession
    path = f"{stage_root(spark)}/{uuid.uuid4().hex}"
    examples.repartition(shards, "shard").write.partitionBy("shard").option("compression", "zstd").parquet(path)
    stored = spark.read.schema(examples.schema).parquet(path)
    columns = ["label", "slots", "values"]
    return [stored.where(F.col("shard") == k).coalesce(1).sortWithinPartitions("h", "label").select(columns) for k in range(shards)]


def _pass(shards: list[DataFrame], leader: Leader) -> Leader:
    """The mean of the states that the shards come to from ``leader``; a shard without examples does not count."""
    spark = shards[0].sparkSession
    start = spark.sparkContext.broadcast(leader)

    def learn(batches):
        own = None
        for batch in batches:
            labels = batch.column("label").to_pylist()
            slots, values = batch.column("slots"), batch.column("values")
            if labels and own is None:
                given = start.value
                own = Leader(given.z.copy(), given.n.copy(), given.alpha, given.beta, given.l1, given.l2)
            for i, label in enumerate(labels):
                own.learn(slots[i].values.to_numpy(), values[i].values.to_numpy().astype(np.float64), label)
        if own is not None:
            for block, at in enumerate(range(0, len(own.z), _BLOCK)):
                row = ([block], [own.z[at : at + _BLOCK].tobytes()], [own.n[at : at + _BLOCK].tobytes()])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _STATE)], schema=_STATE)

    def mean(table: pa.Table) -> pa.Table:
        row = [[table.column("block")[0].as_py()]]
        row += [[np.mean([np.frombuffer(x, np.float64) for x in table.column(c).to_pylist()], axis=0).tobytes()] for c in "zn"]
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(row, _STATE)], schema=_STATE)

    states = reduce(DataFrame.unionAll, shards).mapInArrow(learn, _STATE_DDL)
    z, n = leader.z.copy(), leader.n.copy()
    for r in states.groupBy("block").applyInArrow(mean, _STATE_DDL).collect():
        at = r["block"] * _BLOCK
        z[at : at + _BLOCK], n[at : at + _BLOCK] = np.frombuffer(r["z"]), np.frombuffer(r["n"])
    start.unpersist()
    return Leader(z, n, leader.alpha, leader.beta, leader.l1, leader.l2)


@dataclass
class Model:
    weights: np.ndarray  # by slot, then that of the constant
    longest: int = LONGEST

    def score(self, text: bytes) -> float:
        slots, values = features(text, len(self.weights) - 1, self.longest)
        return float(logistic(self.weights[slots] @ values))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    rows: int = SAMPLE_ROWS,
    slots: int = SLOTS,
    longest: int = LONGEST,
    shards: int = SHARDS,
    passes: int = PASSES,
) -> Model:
    """A model that tells texts whose ``label`` is 1 from others, learnt from ``doc_id, text`` of ``docs`` and
    ``doc_id, label`` of ``labels``.

    About ``rows`` different texts are used. Null labels and ids do not count, null texts are empty ones, copies
    with one label are one example. Without any example all weights are zero and every score is one half.
    """
    examples = _write_sample(_sample(docs, labels, label, rows), slots, longest, shards)
    leader = Leader(np.zeros(slots + 1), np.zeros(slots + 1))
    for _ in range(passes):
        leader = _pass(examples, leader)
    return Model(leader.weights(), longest)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for each row of ``doc_id, text``: the probability of label 1, and 1 from the
    threshold on. Whole texts are read; null and empty ones get the score of the constant alone. Repeated rows
    and null ids are kept, an empty table gives no row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        given = shared.value
        scores = [given.score(t) for t in texts_of(batch)]
        yield {"doc_id": batch.column("doc_id"), "score": scores, "predicted": [int(s >= threshold) for s in scores]}

    return map_batches(docs, ["doc_id", "text"], run, "doc_id long, score double, predicted int")
