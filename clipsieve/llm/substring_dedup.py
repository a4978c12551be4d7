"""Removal of repeated token windows.

Rabin-Karp hashes of every window of ``length`` words are counted in Spark; a window that occurs twice or
more is removed wherever it occurs, and overlapping windows merge into maximal intervals. Neighbouring
windows that repeat together are counted together (see ``windows``); the others one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from clipsieve.llm.texts import to_arrow
from clipsieve.llm.windows import Rule, _parsed, kept_mask, removed_spans, with_spans

LENGTH, GRAM = 35, 14


def word_values(text: bytes) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rule(length: int = LENGTH, gram: int | None = None) -> Rule:
    return Rule(word_values, length, gram or max(1, length * GRAM // LENGTH), False)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_words, n_removed, kept`` (the kept words joined by one space).

    Windows are of one document. Rows that share id and text count as one document and each return its
    result; rows that share the id alone are different documents. Null text has no word. An empty table gives
    no row.
    """
    found = with_spans(docs, removed_spans(docs, rule(length)))
    out = found.select("row", "row.text", "spans")
    schema = f"row {found.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept string"
    arrow = to_arrow(_parsed(schema))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            rows = []
            for text, spans in zip(texts, batch.column("spans").to_pylist()):
                words = (text or b"").split()
                stays, runs = kept_mask(len(words), spans)
                kept = [w for w, s in zip(words, stays.tolist()) if s] if runs else words
                rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
            columns = list(zip(*rows)) if rows else [[], [], []]
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("row").cast(arrow.field("row").type), *arrays], schema=arrow)

    return out.mapInArrow(run, schema)
