"""Mixture-controlled packing by deficit round-robin over source queues.

A document is its token ids and an end id. Sources are queues; in every round of ``window`` tokens a queue
is credited with its share of the mixture and serves the whole tokens of its credit, the fraction being
carried to its next round. Shares are kept as whole numbers, so what a queue has served before any round is
a closed formula: a partition finds where its pieces go from the totals alone, and credits carry across
windows and partitions without any shuffle. The rounds, laid end to end, are cut into sequences.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipsieve.llm.stages import write_stage
from clipsieve.llm.texts import map_batches, texts_of
from clipsieve.llm.token_ids import as_u32, encoder

WINDOW = 4096
#: At most so many queues: the largest sources have their own, all others share the last.
QUEUES = 64

_TOKENS = "part long, queue int, before long, doc_id long, n long, ids binary, width int"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "queue int"
)


class Schedule:
    """What each queue has served before a round: ``sizes`` tokens in all, at shares ``weights``.

    When a queue is empty, the others go on in their own proportions (a new phase).
    """

    def __init__(self, sizes: list[int], weights: list[int], window: int):
        self.sizes, self.window = sizes, window
        self.phases: list[tuple[int, list[int], list[int], int]] = []
        first, served = 0, [0] * len(sizes)
        while any(s < n for s, n in zip(served, sizes)):
            shares = [w if s < n else 0 for w, s, n in zip(weights, served, sizes)]
            if not any(shares):  # only queues without a share are left
                shares = [n - s for s, n in zip(served, sizes)]
            total = sum(shares)
            self.phases.append((first, served, shares, total))
            rounds = min(-(-(n - s) * total // (window * w)) for s, n, w in zip(served, sizes, shares) if w)
            served = self._at(self.phases[-1], first + rounds)
            first += rounds
        self.rounds = first

    def _at(self, phase, round_number: int) -> list[int]:
        first, base, shares, total = phase
        credit = (round_number - first) * self.window
        return [min(n, b + credit * w // total) for n, b, w in zip(self.sizes, base, shares)]

    @lru_cache(maxsize=4096)  # noqa: B019 - one schedule lives as long as its task
    def served(self, round_number: int) -> list[int]:
        phase = next(p for p in reversed(self.phases) if p[0] <= round_number)
        return self._at(phase, round_number)

    @lru_cache(maxsize=4096)  # noqa: B019
    def places(self, round_number: int) -> list[int]:
        """Where the tokens of each queue begin, in the stream of all rounds."""
        before, after = self.served(round_number), self.served(round_number + 1)
        place, out = sum(before), []
        for a, b in zip(before, after):
            out.append(place)
            place += b - a
        return out

    def round_of(self, queue: int, token: int) -> int:
        """The round that serves a token of a queue."""
        low, high = 0, self.rounds - 1
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.served(middle)[queue] <= token else (low, middle - 1)
        return low

    def pieces(self, queue: int, first: int, n: int):
        """(start within the n tokens, length, place in the stream) of tokens first, first + 1, ... of a queue."""
        token, end, r = first, first + n, self.round_of(queue, first)
        while token < end:
            begin, stop = self.served(r)[queue], min(self.served(r + 1)[queue], end)
            while token < stop:
                place = self.places(r)[queue] + token - begin
                length = min(stop - token, self.window - place % self.window)
                yield token - first, length, place
                token += length
            r += 1


def _largest(docs: DataFrame, queues: int) -> list:
    rows = docs.groupBy("source").count().orderBy(F.desc("count"), F.asc_nulls_first("source")).limit(queues - 1)
    return [r["source"] for r in rows.collect()]


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 2,
    window: int = WINDOW,
    weights: dict[str | None, float] | None = None,
    queues: int = QUEUES,
) -> DataFrame:
    """Pack ``doc_id, text, source`` into sequences of ``window`` tokens; one row per piece.

    ``weights`` sets the mixture by source; sources that it leaves out are served last. Without it each
    source has its share of all tokens, and all queues end together. At most ``queues`` queues: the sources
    with most documents have their own, the rest share one; more ``weights`` than that are refused. ``source`` null is a source like any other.
    Null text is an empty document of one token, ``end_id``. Repeated rows and null ids are packed like any
    others. Only the last sequence can be short. An empty table gives no piece.
    """
    if weights is not None and len(weights) >= queues:
        raise ValueError(f"{len(weights)} weights and all other sources need more than {queues} queues")
    named = list(weights) if weights is not None else _largest(docs, queues)
    number = {source: i for i, source in enumerate(named)}
    last = len(named)

    def encode(batch, state={}):  # noqa: B006 - running totals of this task
        part = TaskContext.get().partitionId()
        if state.get("task") != TaskContext.get().taskAttemptId():
            state.update(task=TaskContext.get().taskAttemptId(), totals=[0] * (last + 1))
        totals, words = state["totals"], encoder(vocabulary)
        end = end_id.to_bytes(words.width, "little")
        sources = batch.column("source").to_pylist()
        ids = [words.of_text(t) + end for t in texts_of(batch)]
        lengths = [len(x) // words.width for x in ids]
        numbers = [number.get(s, last) for s in sources]
        before = []
        for q, n in zip(numbers, lengths):
            before.append(totals[q])
            totals[q] += n
        k = len(ids)
        yield {
            "part": [part] * k, "queue": numbers, "before": before, "doc_id": batch.column("doc_id"),
            "n": lengths, "ids": ids, "width": [words.width] * k,
        }

    tokens = write_stage(map_batches(docs, ["doc_id", "text", "source"], encode, _TOKENS))
    parts = tokens.groupBy("queue", "part").agg(F.sum("n").alias("n_part"))
    sizes = {r["queue"]: r["n"] for r in parts.groupBy("queue").agg(F.sum("n_part").alias("n")).collect()}
    sizes = [sizes.get(q, 0) for q in range(last + 1)]
    if weights is None:
        shares = sizes
    else:
        shares = [round(weights[s] * 10**9) for s in named] + [0]
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("queue", "part", F.coalesce(F.sum("n_part").over(earlier), F.lit(0)).alias("base"))

    def place(batch, kept={}):  # noqa: B006 - one schedule for this worker's batches
        key = (tuple(sizes), tuple(shares), window)
        if key not in kept:
            kept.clear()
            kept[key] = Schedule(sizes, shares, window)
        schedule, out = kept[key], []
        for queue, before, doc_id, n, ids, width in zip(*(batch.column(c).to_pylist() for c in _PLACED)):
            values = as_u32(ids, width)
            for start, length, at in schedule.pieces(queue, before, n):
                crc = zlib.crc32(values[start : start + length])
                out.append((doc_id, start, length, crc, n, at // window, at % window, queue))
        names = [x.split()[0] for x in _PIECES.split(", ")]
        yield dict(zip(names, map(list, zip(*out)))) if out else {x: [] for x in names}

    _PLACED = ["queue", "first", "doc_id", "n", "ids", "width"]
    placed = tokens.join(bases, ["queue", "part"]).withColumn("first", F.col("base") + F.col("before"))
    return map_batches(placed, _PLACED, place, _PIECES)
