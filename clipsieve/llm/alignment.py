"""Alignment of two tokenizers' tokens over the same bytes, and how many documents hold each pair linked.

Both tokenizers encode a space and the text. The bytes where tokens of both end cut the tokens into groups; two
tokens are linked where their byte ranges overlap. Counts of pairs: the different pairs of all documents get a
minimal perfect hash, every task adds up a dense vector of counts by hash index, and the vectors are summed as a
tree, block by block. A second pass aligns the documents again and looks the counts up; the key held at an index
is compared each time.

Texts are encoded once and the ids written. Neither tokenizer joins anything across certain places, so a text is
the units between them; a worker encodes a unit once and remembers it. From the ids many documents are aligned at
a time, as one long text: the ends of all tokens, sorted, are its links.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsieve.llm.perfect_hash import PerfectHash, build_segment, spread
from clipsieve.llm.stages import write_stage

#: About how many pairs a segment of the hash has, how many a table that is sent to all workers may have
#: (16 bytes and 3 bits each), and how many counts travel in a row.
SEGMENT_PAIRS, TABLE_PAIRS, BLOCK = 1 << 14, 1 << 22, 1 << 13
#: Vectors that are added in one step of the tree.
FAN_IN = 32
#: Units remembered by a worker (in each of two halves, of which the older goes), and different pairs held by one
#: before it passes them on.
REMEMBERED_UNITS, HELD_PAIRS = 250_000, 1 << 22
_LONGEST_REMEMBERED = 64
#: Characters, or bytes of ids, and documents that are worked on at once (one document at least).
_SIZE_AT_ONCE, _DOCS_AT_ONCE = 1 << 21, 512
#: Before a space or line break after anything else, and between a Latin letter and ASCII marks or digits.
_PLACES = re.compile(r"(?<=\S)(?=[ \n])|(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[!-@\[-`{-~])")
#: The same for texts of these characters alone, found faster: white space, marks, letters.
_ODD = re.compile(r"[^\n -~À-ÖØ-öø-ÿ]")
_UNITS = re.compile(r"[ \n]*(?:[!-@\[-`{-~]*[A-Za-zÀ-ÖØ-öø-ÿ]+|[!-@\[-`{-~]+)|[ \n]+")
_JOINED = re.compile(r"\n|[^▁]▁|[A-Za-zÀ-ÖØ-öø-ÿ][!-@\[-`{-~]")
_NONE = np.zeros(0, np.uint64)


def _letter_bytes() -> dict[str, int]:
    """Byte-level BPE spells bytes as letters: printable Latin-1 as it is, the others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """The two vocabularies, and the ids of units met before."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True  # their strings in a text are ordinary text
        self._b = SentencePieceProcessor(model_file=path_b)
        self._model, self._space_letter = self._a.model, next(c for c, x in _letter_bytes().items() if x == 32)
        letters, vocabulary = _letter_bytes(), self._a.get_vocab(with_added_tokens=False)
        self._bytes_a = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self._bytes_a[i] = bytes(letters[c] for c in token)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        #: Bytes of each token, and the widths of ids as they are written.
        self.lengths = [np.array([len(x) for x in table]) for table in (self._bytes_a, self._bytes_b)]
        self.kinds = [np.dtype("u2" if len(table) <= 1 << 16 else "u4") for table in (self._bytes_a, self._bytes_b)]
        # A space on its own, and what comes before a text that begins with a line break.
        self._space = self._b.piece_to_id("▁")
        self._lead = self._b.encode("\n", num_threads=1)
        special = {i for i in range(len(pieces)) if self._b.is_control(i) or self._b.is_unknown(i) or self._b.is_byte(i)}
        #: Whether B joins nothing across the places where texts are cut. The pattern of A never does.
        self.cuts = not any(_JOINED.search(p) for i, p in enumerate(pieces) if i not in special)
        self._known: dict[str, tuple[bytes, bytes] | None] = {}
        self._older: dict[str, tuple[bytes, bytes] | None] = {}

    def _ids(self, unit: str, a: list[int], b: list[int]) -> tuple[bytes, bytes] | None:
        """The packed ids of a unit; none where they do not spell it."""
        if unit[0] != " ":  # before it stand the space that the library adds and a line break, which joins nothing
            if b[:2] != self._lead:
                return None
            b = b[2:]
        elif len(unit) == 1:
            b = [self._space]
        data = unit.encode()
        if max(a) >= len(self._bytes_a) or b"".join(map(self._bytes_a.__getitem__, a)) != data:
            return None
        if b"".join(map(self._bytes_b.__getitem__, b)) != data:
            return None
        return array(self.kinds[0].char, a).tobytes(), array(self.kinds[1].char, b).tobytes()

    def _learn(self, names: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """Units met for the first time, all encoded in one call of each library."""
        plain = [n for n in names if n.isascii() and n[1:].isalpha() and (n[0] == " " or n[0].isalpha())]
        # Letters alone are one word to the pattern of A, which its model takes without the steps before it.
        tokens = self._model.tokenize
        of_a = {n: [t.id for t in tokens(n.replace(" ", self._space_letter))] for n in plain}
        rest = [n for n in names if n not in of_a]
        of_a |= zip(rest, [x.ids for x in self._a.encode_batch(rest, add_special_tokens=False)])
        b = self._b.encode([n[1:] if n[0] == " " else "\n" + n for n in names], num_threads=1)
        return {n: self._ids(n, of_a[n], y) for n, y in zip(names, b)}

    def _cut(self, whole: str) -> list[str]:
        if not self.cuts:
            return [whole]
        return _PLACES.split(whole) if _ODD.search(whole) else _UNITS.findall(whole)

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """The packed ids of each text by A and B; none for a null or empty one and where they do not spell it."""
        names = [self._cut(" " + t) if t else [] for t in texts]
        known, older = self._known, self._older
        met = {n for of_text in names for n in of_text if n not in known}
        again = {n: older[n] for n in met if n in older}
        new = again | self._learn([n for n in met if n not in again])
        known.update((n, u) for n, u in new.items() if len(n) <= _LONGEST_REMEMBERED)
        out = []
        for of_text in names:
            units = [known[n] if n in known else new[n] for n in of_text]
            if None in units:
                units = []
            out.append((b"".join([u[0] for u in units]), b"".join([u[1] for u in units])))
        if len(known) > REMEMBERED_UNITS:
            self._known, self._older = {}, known
        return out


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path_a: str, path_b: str) -> Encoder:
    """The worker's encoder of two vocabulary files, made on first use."""
    if (path_a, path_b) not in _encoders:
        _encoders[path_a, path_b] = Encoder(path_a, path_b)
    return _encoders[path_a, path_b]


def _portions(batch: pa.RecordBatch, sizes: list[int | None]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, as many at a time as are small together."""
    begin, n = 0, 0
    for at, size in enumerate(sizes):
        if at > begin and (n + (size or 0) > _SIZE_AT_ONCE or at - begin == _DOCS_AT_ONCE):
            yield batch.slice(begin, at - begin)
            begin, n = at, 0
        n += size or 0
    if begin < len(sizes):
        yield batch.slice(begin)


def encoded(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, a, b``: the ids of each row by both vocabularies, two bytes each (four for large vocabularies)."""
    kind = pa.schema([("doc_id", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])

    def run(batches):
        encode = encoder(path_a, path_b).encode
        for batch in batches:
            for part in _portions(batch, pc.utf8_length(batch.column("text")).to_pylist()):
                ids = encode(part.column("text").to_pylist())
                a, b = (pa.array([x[k] for x in ids], pa.binary()) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), a, b], schema=kind)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, a binary, b binary")


class Links:
    """The links of some documents, which stand one after the other like one text."""

    def __init__(self, given: Encoder, part: pa.RecordBatch):
        self.ids, ends, counts = [], [], []
        for column, kind, lengths in zip("ab", given.kinds, given.lengths):
            packed = part.column(column).to_pylist()
            ids = np.frombuffer(b"".join(packed), kind).astype(np.int64)
            self.ids.append(ids)
            ends.append(np.cumsum(lengths[ids]))
            counts.append(np.array([len(x) // kind.itemsize for x in packed], np.int64))
        self.n_a, self.n_b = counts
        self.ends = ends
        before = np.concatenate([[0], ends[0]])
        document_ends = before[np.cumsum(self.n_a)]
        every = np.sort(np.concatenate(ends), kind="stable")
        every = every[np.concatenate([[True], every[1:] != every[:-1]])] if len(every) else every
        at_a, at_b = (np.searchsorted(e, every) for e in ends)
        #: Of each link, the pair and the number of the document.
        self.pairs = self.ids[0][at_a].astype(np.uint64) << np.uint64(32) | self.ids[1][at_b].astype(np.uint64)
        self.document = np.searchsorted(document_ends, every)
        self.common = every[(ends[0][at_a] == every) & (ends[1][at_b] == every)]
        self.n_links = np.bincount(self.document, minlength=len(packed))
        self.n_groups = np.bincount(np.searchsorted(document_ends, self.common), minlength=len(packed))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of the values of each document's links."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return np.diff(total[np.concatenate([[0], np.cumsum(self.n_links)])])

    def spelled(self, table: list[bytes]) -> list[bytes]:
        """The groups of each document as text; the table has each id before a comma, a bar and a semicolon."""
        if not len(self.common):
            return [b""] * len(self.n_a)
        group = [np.searchsorted(self.common, e) for e in self.ends]
        sizes = [np.bincount(g, minlength=len(self.common)) for g in group]
        first = np.concatenate([[0], np.cumsum(sizes[0] + sizes[1])])[:-1]
        width = len(table) // 3
        codes = np.empty(len(group[0]) + len(group[1]), np.int64)
        for side, (g, n, ids) in enumerate(zip(group, sizes, self.ids)):
            inside = np.arange(len(g)) - (np.cumsum(n) - n)[g]
            last = inside == n[g] - 1
            codes[first[g] + inside + (sizes[0][g] if side else 0)] = ids + np.where(last, width * (1 + side), 0)
        out, at, codes = [], 0, codes.tolist()
        for n in (self.n_a + self.n_b).tolist():
            out.append(b"".join([table[c] for c in codes[at : at + n]])[:-1])
            at += n
        return out


def _linked(batches, path_a: str, path_b: str) -> Iterator[tuple[pa.RecordBatch, Links]]:
    given = encoder(path_a, path_b)
    for batch in batches:
        for part in _portions(batch, pc.binary_length(batch.column("a")).to_pylist()):
            yield part, Links(given, part)


def _different_pairs(ids: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``pair``: every pair once; tasks drop what they repeat themselves before the shuffle."""
    kind = pa.schema([("pair", pa.int64())])

    def run(batches):
        held, n = [_NONE], 0
        for _, links in _linked(batches, path_a, path_b):
            held.append(np.unique(links.pairs))
            n += len(held[-1])
            if n > HELD_PAIRS:
                held = [np.unique(np.concatenate(held))]
                n = len(held[0])
                if n > HELD_PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64))], schema=kind)
                    held, n = [_NONE], 0
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)).view(np.int64))], schema=kind)

    return ids.select("a", "b").mapInArrow(run, "pair long").distinct()


def _segment_of(pairs: np.ndarray, segments: int) -> np.ndarray:
    """All pairs of an id of A are in one segment, so its greatest count is found there."""
    return (spread(pairs >> np.uint64(32), _SEGMENT_LEVEL) % np.uint64(segments)).astype(np.int64)


_SEGMENT_LEVEL = 99


def _hash_segments(pairs: DataFrame, segments: int) -> DataFrame:
    """``segment, n, sizes, bits, keys`` of the perfect hash of each segment, each built in one task."""
    named = pa.schema([("segment", pa.int32()), ("pair", pa.int64())])

    def name(batches):
        for batch in batches:
            values = batch.column("pair").to_numpy().view(np.uint64)
            segment = _segment_of(values, segments).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(segment), batch.column("pair")], schema=named)

    built = pa.schema([("segment", pa.int32()), ("n", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("keys", pa.binary())])

    def build(table: pa.Table) -> pa.Table:
        keys = np.sort(table.column("pair").to_numpy().view(np.uint64))
        sizes, words, placed = build_segment(keys)
        row = [[table.column("segment")[0].as_py()], [len(keys)], [sizes.tolist()], [words.tobytes()], [placed.tobytes()]]
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(row, built)], schema=built)

    rows = pairs.mapInArrow(name, "segment int, pair long")
    return rows.groupBy("segment").applyInArrow(build, "segment int, n long, sizes array<long>, bits binary, keys binary")


@dataclass
class Table:
    """Perfect hash of some segments, from ``begin`` to ``end``, and the counts by its index."""

    begin: int
    end: int
    segments: int
    hash: PerfectHash
    counts: np.ndarray | None = None
    best: np.ndarray | None = None  # whether an index has the greatest count of its id of A

    def index(self, pairs: np.ndarray) -> np.ndarray:
        """The index of each pair, -1 of pairs of other segments. A pair of these that is unknown is an error."""
        segment = _segment_of(pairs, self.segments)
        here = (segment >= self.begin) & (segment < self.end)
        out = np.full(len(pairs), -1, np.int64)
        out[here] = self.hash.index(pairs[here], segment[here] - self.begin)
        if (out[here] < 0).any():
            raise ValueError("a pair that no document had in the first pass: did the input change?")
        return out


def _tables(hashes: DataFrame, segments: int, table_pairs: int) -> Iterator[Table]:
    """The tables of all segments, each of at most ``table_pairs`` pairs (or one segment). One at a time is held."""
    sizes = {r["segment"]: r["n"] for r in hashes.select("segment", "n").collect()}
    begin = 0
    while begin < segments:
        end, n = begin, 0
        while end < segments and (end == begin or n + sizes.get(end, 0) <= table_pairs):
            n += sizes.get(end, 0)
            end += 1
        rows = hashes.where(F.col("segment").between(begin, end - 1)).collect()
        held = {r["segment"]: [np.array(r["sizes"], np.int64), *(np.frombuffer(r[c], np.uint64) for c in ("bits", "keys"))] for r in rows}
        none = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        yield Table(begin, end, segments, PerfectHash.join([held.get(s, none) for s in range(begin, end)]))
        begin = end


_VECTOR = pa.schema([("block", pa.int64()), ("task", pa.int64()), ("counts", pa.binary())])
_VECTOR_DDL = "block long, task long, counts binary"


def _sum_vectors(vectors: DataFrame) -> DataFrame:
    """One row for each block: the sum of its vectors. ``task`` numbers the rows of a block; ``FAN_IN`` are added at
    a time and one stays in memory."""

    def add(batches):
        key, total = None, None
        for batch in batches:
            for block, task, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (block, task):
                    if key is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, total.tobytes()), _VECTOR)], schema=_VECTOR)
                    key, total = (block, task), np.zeros(len(counts) // 8, np.int64)
                total += np.frombuffer(counts, np.int64)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, total.tobytes()), _VECTOR)], schema=_VECTOR)

    def level(rows: DataFrame, task) -> DataFrame:
        dealt = rows.withColumn("task", task).repartition("block", "task").sortWithinPartitions("block", "task")
        return dealt.select("block", "task", "counts").mapInArrow(add, _VECTOR_DDL)

    return level(level(vectors, F.floor(F.col("task") / FAN_IN).cast("long")), F.lit(0).cast("long"))


def _count(ids: DataFrame, path_a: str, path_b: str, table: Table) -> np.ndarray:
    """In how many documents each pair of the table is linked, by its index."""
    shared = ids.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        from pyspark import TaskContext

        table, task = shared.value, TaskContext.get().partitionId()
        dense = np.zeros(-(-table.hash.n // BLOCK) * BLOCK, np.int64)
        for _, links in _linked(batches, path_a, path_b):
            index = table.index(links.pairs)
            once = np.unique(links.document[index >= 0] * table.hash.n + index[index >= 0])
            np.add.at(dense, once % max(1, table.hash.n), 1)
        blocks = dense.reshape(-1, BLOCK)
        for at in np.flatnonzero(blocks.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((at, task, blocks[at].tobytes()), _VECTOR)], schema=_VECTOR)

    total = np.zeros(-(-table.hash.n // BLOCK) * BLOCK, np.int64)
    for row in _sum_vectors(ids.select("a", "b").mapInArrow(run, _VECTOR_DDL)).toLocalIterator():
        total[row["block"] * BLOCK :][:BLOCK] = np.frombuffer(row["counts"], np.int64)
    shared.unpersist()
    return total[: table.hash.n]


def counted_tables(ids: DataFrame, path_a: str, path_b: str, segment_pairs: int = SEGMENT_PAIRS, table_pairs: int = TABLE_PAIRS) -> Iterator[Table]:
    """The counts of all pairs of the documents of ``a, b``, in tables of at most ``table_pairs`` pairs."""
    pairs = write_stage(_different_pairs(ids, path_a, path_b))
    segments = max(1, -(-pairs.count() // segment_pairs))
    hashes = write_stage(_hash_segments(pairs, segments))
    for table in _tables(hashes, segments, table_pairs):
        table.counts = _count(ids, path_a, path_b, table)
        a = (table.hash.keys >> np.uint64(32)).astype(np.int64)
        greatest = np.zeros(int(a.max(initial=0)) + 1, np.int64)
        np.maximum.at(greatest, a, table.counts)
        table.best = table.counts == greatest[a]
        yield table


def pair_counts(docs: DataFrame, path_a: str, path_b: str, **bounds) -> DataFrame:
    """``a_id, b_id, n_docs``: in how many rows of ``doc_id, text`` a token of A overlaps one of B, for all pairs
    that do."""
    spark, out = docs.sparkSession, None
    kind = pa.schema([("a_id", pa.int64()), ("b_id", pa.int64()), ("n_docs", pa.int64())])
    for table in counted_tables(write_stage(encoded(docs, path_a, path_b)), path_a, path_b, **bounds):
        keys = table.hash.keys
        columns = [(keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), table.counts]
        part = write_stage(spark.createDataFrame(pa.Table.from_arrays([pa.array(c) for c in columns], schema=kind)))
        out = part if out is None else out.unionByName(part)
    return out


def aligned(docs: DataFrame, path_a: str, path_b: str, segment_pairs: int = SEGMENT_PAIRS, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row of ``doc_id, text``.

    ``n_best`` links have the greatest count of their id of A, ties included; ``count_sum`` adds the counts of
    all links; ``groups_sha256`` is of the groups as ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and texts
    that the tokens do not spell (piece models may change characters), have no tokens: zeros and ''. Repeated
    rows count each time; null ids are kept. An empty table gives no row.

    Texts are read once, their ids once for the pairs and twice for every table of counts; tables beyond the
    first are needed only where there are more pairs than ``table_pairs``.
    """
    spark, ids = docs.sparkSession, write_stage(encoded(docs, path_a, path_b))
    counters = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    zeros = [F.lit(0).cast("long").alias(c) for c in counters]
    out = ids.select("doc_id", "a", "b", *zeros, F.lit("").alias("groups_sha256"))
    schema = out.schema
    for number, table in enumerate(counted_tables(ids, path_a, path_b, segment_pairs, table_pairs)):
        out = out.mapInArrow(_look_up(spark.sparkContext.broadcast(table), path_a, path_b, number == 0), schema)
    return out.select("doc_id", *counters, "groups_sha256")


def _look_up(shared, path_a: str, path_b: str, first: bool):
    """A pass that adds what one table knows; the first one also describes the alignment."""

    def run(batches):
        table, spelling = shared.value, []
        if first:
            n = max(map(len, encoder(path_a, path_b).lengths))
            spelling = [b"%d%s" % (i, mark) for mark in (b",", b"|", b";") for i in range(n)]
        for part, links in _linked(batches, path_a, path_b):
            columns = {c: part.column(c) for c in part.schema.names}
            index = table.index(links.pairs)
            known = index >= 0
            for c, of_index in (("n_best", table.best), ("count_sum", table.counts)):
                values = np.zeros(len(index), np.int64)
                values[known] = of_index[index[known]]
                columns[c] = pa.array(links.sums(values) + columns[c].to_numpy())
            if first:
                columns |= {c: pa.array(getattr(links, c).astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")}
                digests = [hashlib.sha256(s).hexdigest() if s else "" for s in links.spelled(spelling)]
                columns["groups_sha256"] = pa.array(digests, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run
