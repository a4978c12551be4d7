"""Small helpers that the operators share: columns of Arrow batches and text units."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: The bytes that separate words: space and 0x09 to 0x0D. ``bytes.split()`` separates at the same ones.
SEPARATORS = b" \t\n\x0b\x0c\r"


def map_batches(
    docs: DataFrame, columns: list[str], work: Callable[[pa.RecordBatch], Iterator[dict]], schema: str
) -> DataFrame:
    """Apply ``work`` to each Arrow batch of ``columns``; it yields dictionaries of column lists."""
    from pyspark.sql.types import _parse_datatype_string  # the schema text as Spark reads it

    arrow = to_arrow(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            for out in work(batch):
                arrays = [_array(out[f.name], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select(*columns).mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def to_arrow(struct) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(struct)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null is empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]
