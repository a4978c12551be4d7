"""Token files of compressed bit planes.

Format: a Parquet dataset with one row per chunk, in shards of ascending document order. A chunk holds a
fixed number of ids (the last of a shard fewer). Its ids are transposed into bit planes (``bits`` of them,
lowest first, each padded to whole bytes) or byte planes; every plane is compressed alone with zstandard and
the compressed planes follow one another in ``payload``. The chunk index is the columns beside it:
``shard, chunk, first`` (ids of the shard before it), ``n_ids``, ``plane_bytes`` (compressed length of each
plane), ``doc_ids, doc_lengths, doc_firsts`` (documents that have ids in the chunk, their ids in all, and the
ids of the shard before them). So a chunk can be read alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipsieve.llm.stages import write_stage
from clipsieve.llm.texts import texts_of, to_arrow
from clipsieve.llm.token_ids import as_u32, encoder

CHUNK_IDS = 1 << 16
LEVEL = 3

_CHUNKS = (
    "shard long, chunk long, first long, n_ids long, plane_bytes array<int>, payload binary, "
    "doc_ids array<long>, doc_lengths array<long>, doc_firsts array<long>"
)
_PARTS = "shard long, first long, chunk long, doc_id long, n_tokens long, ids_crc32 long, ids binary"
_DOCS = "shard long, first long, doc_id long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, bits: int, plane: str = "bit") -> list[bytes]:
    """The planes of unsigned ids below 2**bits, lowest first; ``bits`` is a multiple of 8."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : bits // 8]
    if plane == "byte":
        return [octets[:, i].tobytes() for i in range(bits // 8)]
    return [
        np.packbits((octets[:, b // 8] >> (b % 8)) & 1, bitorder="little").tobytes() for b in range(bits)
    ]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids again; one, two, three or four planes are byte planes, more are bit planes."""
    octets = np.zeros((n, 4), np.uint8)
    if len(planes) <= 4:
        for i, data in enumerate(planes):
            octets[:, i] = np.frombuffer(data, np.uint8, n)
    else:
        for b, data in enumerate(planes):
            bit = np.unpackbits(np.frombuffer(data, np.uint8), count=n, bitorder="little")
            octets[:, b // 8] |= bit << (b % 8)
    return octets.reshape(-1).view("<u4")


def write_tokens(
    docs: DataFrame, vocabulary: str, end_id: int = 1, chunk_ids: int = CHUNK_IDS, plane: str = "bit"
) -> DataFrame:
    """Encode ``doc_id, text``, append ``end_id`` to each document and write the files; returns them as read.

    Order: ``doc_id`` ascending, nulls first, rows with the same id by the hash of their text. Null text is an
    empty document. Repeated rows are kept. An empty table gives a dataset without rows.
    """
    rows = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
    order = [F.asc_nulls_first("doc_id"), F.asc("tie")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = to_arrow(_parsed(_CHUNKS))

    def run(batches):
        import pyarrow as pa

        words = encoder(vocabulary)
        end, shard = end_id.to_bytes(words.width, "little"), TaskContext.get().partitionId()
        size, bits = chunk_ids * words.width, 8 * words.width
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        held, starts, done, chunk = bytearray(), [], 0, 0

        def pack(data: bytes, docs_here):
            n = len(data) // words.width
            planes = [squeeze(p) for p in to_planes(as_u32(data, words.width), bits, plane)]
            row = {
                "shard": [shard], "chunk": [chunk], "first": [done], "n_ids": [n],
                "plane_bytes": [[len(p) for p in planes]], "payload": [b"".join(planes)],
                "doc_ids": [[d for d, _, _ in docs_here]], "doc_lengths": [[k for _, k, _ in docs_here]],
                "doc_firsts": [[f for _, _, f in docs_here]],
            }
            return pa.RecordBatch.from_pydict(row, schema=schema), n

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                data = words.of_text(text) + end
                starts.append((doc_id, len(data) // words.width, done + len(held) // words.width))
                held += data
                while len(held) >= size:
                    here = [s for s in starts if s[2] < done + chunk_ids]
                    starts = [s for s in starts if s[1] + s[2] > done + chunk_ids]
                    out, n = pack(bytes(held[:size]), here)
                    yield out
                    del held[:size]
                    done, chunk = done + n, chunk + 1
        if held:
            yield pack(bytes(held), starts)[0]

    return write_stage(rows.mapInArrow(run, _CHUNKS))


def _parsed(schema: str):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(schema)


def read_chunk(row: dict) -> np.ndarray:
    """The ids of one chunk row."""
    planes, at, expand = [], 0, zstandard.ZstdDecompressor().decompress
    for length in row["plane_bytes"]:
        planes.append(expand(row["payload"][at : at + length]))
        at += length
    return from_planes(planes, row["n_ids"])


def read_documents(chunks: DataFrame) -> DataFrame:
    """One row per document of written files: ``doc_id, start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32`` (of its ids as little-endian unsigned 32-bit integers).

    Chunks are read where they lie. Only of a document in several chunks do the ids move, to be joined.
    """
    parts_schema, docs_schema = to_arrow(_parsed(_PARTS)), to_arrow(_parsed(_DOCS))

    def rows_of(out, schema):
        import pyarrow as pa

        columns = map(list, zip(*out)) if out else [[] for _ in schema.names]
        return pa.RecordBatch.from_pydict(dict(zip(schema.names, columns)), schema=schema)

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, out = read_chunk(row), []
                for doc_id, length, first in zip(row["doc_ids"], row["doc_lengths"], row["doc_firsts"]):
                    begin, end = first - row["first"], first - row["first"] + length
                    part = ids[max(begin, 0) : end]
                    whole = len(part) == length
                    out.append((
                        row["shard"], first, row["chunk"], doc_id, length,
                        zlib.crc32(part) if whole else None, None if whole else part.tobytes(),
                    ))
                yield rows_of(out, parts_schema)

    def join(batches):
        crc, left = 0, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                known = row["ids_crc32"]
                if known is None:
                    crc, left = zlib.crc32(row["ids"], crc if left else 0), left or row["n_tokens"]
                    left -= len(row["ids"]) // 4
                    if left:
                        continue
                    known = crc
                out.append((row["shard"], row["first"], row["doc_id"], row["n_tokens"], known))
            yield rows_of(out, docs_schema)

    parts = chunks.mapInArrow(read, _PARTS).repartition("shard", "first")
    docs = parts.sortWithinPartitions("shard", "first", "chunk").mapInArrow(join, _DOCS)
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row for each shard: the shards of a run are the tasks that wrote it.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return docs.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
