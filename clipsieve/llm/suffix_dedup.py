"""Removal of repeated byte strings by longest previous factors.

The longest previous factor of a position is the longest string that starts there and also earlier. In
suffix order it is the longer of the common prefixes with the nearest position before and after that is
smaller. A byte is removed if it lies in the first ``length`` bytes of a position whose factor is that long.

Documents are spread over tasks: ``windows`` narrows the positions to those where repeated passages begin
and end and settles the rest by hashes; a task orders the suffixes it has and removes what its own factors
show; the earliest of each are then compared across tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clipsieve.llm.texts import to_arrow
from clipsieve.llm.windows import Rule, _parsed, kept_mask, mix, removed_spans, with_spans

LENGTH, GRAM = 100, 50

_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def suffix_order(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes at ``starts`` by their first ``depth`` bytes, common prefix of each with the one
    before it, at most ``depth``). ``data`` is padded with ``depth`` + 8 bytes."""
    n_words = -(-depth // 8)
    octets = np.lib.stride_tricks.sliding_window_view(data, n_words * 8)[starts].copy()
    octets[:, depth:] = 0
    words = octets.view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    common = np.zeros(len(starts), np.int64)
    if len(starts) > 1:
        differ = octets[order][1:] != octets[order][:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    return order, common


def previous_factors(rank: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest previous factors of suffixes given in suffix order: ``rank`` says which is earlier, ``common``
    is the common prefix with the suffix before."""
    factors = [0] * len(rank)
    stack: list[tuple[int, int, int]] = []  # (rank, place, common prefix with the one below)
    for place, (r, shared) in enumerate(zip(rank.tolist(), common.tolist())):
        while stack and r < stack[-1][0]:
            _, top, below = stack.pop()
            factors[top] = max(below, shared)
            shared = min(below, shared)
        stack.append((r, place, shared))
    for _, top, below in stack:
        factors[top] = below
    return np.array(factors, np.int64)


def earlier_in_task(length: int):
    def earlier(texts, owner, start, rank):
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts) + bytes(length + 8), np.uint8)
        places = (np.cumsum(sizes) - sizes)[owner] + start
        order, common = suffix_order(data, places, length)
        out = np.zeros(len(start), bool)
        out[order] = previous_factors(rank[order], common) >= length
        return out

    return earlier


def byte_values(text: bytes) -> np.ndarray:
    return _BYTES[np.frombuffer(text, np.uint8)]


def rule(length: int = LENGTH, gram: int | None = None) -> Rule:
    return Rule(byte_values, length, gram or max(1, length * GRAM // LENGTH), True, earlier_in_task(length))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_bytes, n_removed, n_spans, kept`` (binary) and ``kept_text``
    (the kept bytes as text; of a character that was cut the rest goes too).

    Earlier means a smaller ``doc_id`` (null first) or the same document and an earlier start. Rows that
    share an id are ordered by a hash of their text (they differ by 80 bits of it); rows that also share the text count as one document
    and each return its result. Null text is empty. An empty table gives no row.
    """
    found = with_spans(docs, removed_spans(docs, rule(length)))
    out = found.select("row", "row.text", "spans")
    schema = f"row {found.schema['row'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string"
    arrow = to_arrow(_parsed(schema))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            rows = []
            for text, spans in zip(texts, batch.column("spans").to_pylist()):
                text = text or b""
                stays, runs = kept_mask(len(text), spans)
                kept = np.frombuffer(text, np.uint8)[stays].tobytes() if runs else text
                whole = kept.decode("utf-8", "ignore")
                rows.append((len(text), len(text) - len(kept), runs, kept, whole))
            columns = list(zip(*rows)) if rows else [[] for _ in range(5)]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("row").cast(arrow.field("row").type), *arrays], schema=arrow)

    return out.mapInArrow(run, schema)

