"""Windows of units (bytes or words) that occur more than once, found without a row per window.

Every window of ``length`` units is assigned the gram of ``gram`` units inside it whose hash is least (the
leftmost of equals). The choice depends on the window's units alone, so equal windows have equal grams at
equal places. Neighbouring windows mostly share their gram; such a run is one *cell*. Cells are compared
first, by the hash of their gram and a hash of all their units. Equal cells settle all their windows; a gram
in one cell only settles them too. What is left, grams in cells that differ (the borders of repeated
passages), is compared window by window.

Hot groups: each task settles what repeats among its own rows before the shuffle, so a shuffled key has at
most one row per task and distinct content. Nothing is collected by key.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsieve.llm.stages import release_shuffles, write_stage
from clipsieve.llm.texts import to_arrow

#: Units hashed at once, and rows settled at once, by a task.
BUFFER, ROWS = 1 << 20, 1 << 19
#: Open windows compared at once inside a task.
WINDOWS = 1 << 17
_INDEX = np.uint64(BUFFER - 1)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
#: Stands for a null doc_id, which is earlier than all others.
NULL_ID = -(1 << 63)

CELL, SPAN, OPEN = 0, 1, 2
#: What documents are joined by.
KEY = ["doc", "name", "tie"]
#: A document is ``doc`` (its id), ``name`` (64 bits of its text's hash) and the tie in ``pos`` (16 more).
_ROWS = "kind int, h long, c long, doc long, name long, pos long, flag int"
_COLUMNS = [x.split()[0] for x in _ROWS.split(", ")]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class RollingHashes:
    """Hashes of any range of a buffer of 64-bit unit values, modulo 2**64."""

    _up = _powers(_BASE, BUFFER + 1)
    _down = _powers(pow(_BASE, -1, 1 << 64), BUFFER + 1)

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._up[: len(values)], out=self.sums[1:])

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self._down[begin])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self._down[:n])


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours: prefix and suffix minima of blocks of that width."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def cells(values: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(first window, number of windows, gram hash, cell hash) of the cells of a buffer of documents that end
    at ``ends``."""
    n = len(values) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    hashes = RollingHashes(values)
    grams = hashes.all(gram)
    tagged = (grams & ~_INDEX) | np.arange(len(grams), dtype=np.uint64)
    place = (_sliding_least(tagged, length - gram + 1) & _INDEX).astype(np.int64)
    end_of = np.repeat(ends, np.diff(ends, prepend=0))[:n]
    inside = np.arange(n) + length <= end_of
    begins = inside.copy()
    begins[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    first = np.flatnonzero(begins)
    stops = np.flatnonzero(inside & np.append(begins[1:] | ~inside[1:], True))
    count = stops - first + 1
    content = hashes.ranges(first, stops + length)
    shape = ((place[first] - first) << 20 | count).astype(np.uint64)
    return first, count, grams[place[first]], mix(content ^ mix(shape))


@dataclass(frozen=True)
class Rule:
    """What a window is and which of equal windows are removed."""

    units: Callable[[bytes], np.ndarray]  # 64-bit values of the units of a text
    length: int
    gram: int
    first_stays: bool  # only later windows are removed, else all that occur twice
    # Exact comparison inside a task: (texts, owner, start, rank) of windows to whether one of lower rank is
    # equal. Repeated rows of one document are not given to it twice.
    earlier: Callable[[tuple[bytes, ...], np.ndarray, np.ndarray, np.ndarray], np.ndarray] | None = None


def tie(text: bytes) -> int:
    """Sixteen bits of a text's checksum: with its name, tells apart rows that share an id."""
    return zlib.crc32(text) & 0xFFFF


def name(text: bytes) -> int:
    """XXH64 of a text as a signed long, like Spark's xxhash64."""
    return int(np.uint64(xxhash.xxh64_intdigest(text, 42)).view(np.int64))


def _tie_column() -> Column:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.crc32(text.cast("binary")).bitwiseAND(0xFFFF).cast("int")


def _key_columns() -> list[Column]:
    """The columns of ``KEY`` from ``doc_id, text``."""
    doc, named = F.coalesce("doc_id", F.lit(NULL_ID)), F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return [doc.alias("doc"), named.alias("name"), _tie_column().alias("tie")]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _spans(doc, name, pos, units) -> dict:
    """Overlapping or touching spans merged. ``pos`` is tie << 40 | start << 8 | number of windows."""
    key, start = pos >> 40, (pos >> 8) & 0xFFFFFFFF
    end = start + (pos & 0xFF) - 1 + units
    order = np.lexsort((start, key, name, doc))
    doc, name, key, start, end = doc[order], name[order], key[order], start[order], end[order]
    if not len(doc):
        return {}
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1]) | (key[1:] != key[:-1])
    block = np.cumsum(other)
    reach = np.maximum.accumulate(block * (1 << 34) + end) - block * (1 << 34)
    fresh = other.copy()
    fresh[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    until = reach[np.append(at[1:], len(doc)) - 1]
    doc, name, pos = doc[at], name[at], key[at] << 40 | start[at] << 8
    n = len(at)
    return {
        "kind": np.full(n, SPAN, np.int32), "h": _signed(mix(doc.view(np.uint64))), "c": until, "doc": doc,
        "name": name, "pos": pos, "flag": np.zeros(n, np.int32),
    }


def _settle(h, c, doc, name, pos, flag, rule: Rule):
    """Sort rows and settle groups of equal (h, c): (positions settled as removed, positions that go on,
    their flags). Rows that repeat id, name, checksum and place count once. Positions index the arrays given."""
    order = np.lexsort((pos, name, doc, c, h))
    same_key = (h[order][1:] == h[order][:-1]) & (c[order][1:] == c[order][:-1])
    same_row = same_key & (doc[order][1:] == doc[order][:-1]) & (pos[order][1:] == pos[order][:-1])
    same_row &= name[order][1:] == name[order][:-1]
    keep = np.append(True, ~same_row)
    # A repeated row may carry the flag.
    flags = flag[order]
    if same_row.any():
        flags = np.maximum.reduceat(flags, np.flatnonzero(keep)) if len(flags) else flags
    order = order[keep]
    begins = np.ones(len(order), bool)
    begins[1:] = ~((h[order][1:] == h[order][:-1]) & (c[order][1:] == c[order][:-1]))
    at = np.flatnonzero(begins)
    size = np.diff(np.append(at, len(order)))
    if rule.first_stays:
        return order[~begins], order[at], np.zeros(len(at), np.int32)
    many = (size > 1) | (flags[at] > 0) if len(at) else size > 1
    removed = np.repeat(size > 1, size)
    return order[removed], order[at], many.astype(np.int32)


def _batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(columns[k], schema.field(k).type) for k in _COLUMNS}, schema)


def _going_on(kind, h, c, doc, name, pos, flag) -> dict:
    n = len(h)
    return {"kind": np.full(n, kind, np.int32), "h": h, "c": c, "doc": doc, "name": name, "pos": pos, "flag": flag}


class _Settler:
    """Collects the rows of a task, settles a bounded number at a time and gives batches to the shuffle."""

    def __init__(self, rule: Rule, schema: pa.Schema):
        self.rule, self.schema, self.rows, self.held = rule, schema, [], 0

    def add(self, h, c, doc, pos, name=0) -> Iterator[pa.RecordBatch]:
        self.rows.append((h, c, doc, np.broadcast_to(np.int64(name), len(h)), pos))
        self.held += len(h)
        if self.held >= ROWS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            h, c, doc, name, pos = (np.concatenate(x) for x in zip(*self.rows))
            gone, on, flag = _settle(h, c, doc, name, pos, np.zeros(len(h), np.int32), self.rule)
            if spans := _spans(doc[gone], name[gone], pos[gone], self.rule.length):
                yield _batch(spans, self.schema)
            yield _batch(_going_on(CELL, h[on], c[on], doc[on], name[on], pos[on], flag), self.schema)
        self.rows, self.held = [], 0


def _documents(batch, unit: Callable[[bytes], np.ndarray], key: Callable[[bytes], object] = tie):
    """(doc, key, unit values) of the rows of a batch."""
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
        text = text or b""
        yield NULL_ID if doc_id is None else doc_id, key(text), unit(text)


def _buffers(documents, length: int):
    """Group documents into buffers of at most BUFFER units: lists of (doc, tie, offset, values). A longer
    one is cut into parts that overlap by a window less one unit."""
    group, size = [], 0
    for doc, key, values in documents:
        if len(values) < length:
            continue
        step = BUFFER - length
        for at in range(0, max(1, len(values) - length + 1), step):
            part = values[at : at + step + length - 1]
            if size + len(part) > BUFFER:
                yield group
                group, size = [], 0
            group.append((doc, key, at, part))
            size += len(part)
    if group:
        yield group


def _cell_rows(docs: DataFrame, rule: Rule) -> DataFrame:
    schema = to_arrow(_parsed(_ROWS))

    def run(batches):
        settler = _Settler(rule, schema)
        for batch in batches:
            named = _documents(batch, rule.units, lambda text: (tie(text), name(text)))
            for group in _buffers(named, rule.length):
                ends = np.cumsum([len(v) for *_, v in group])
                first, count, h, c = cells(np.concatenate([v for *_, v in group]), ends, rule.length, rule.gram)
                own = np.searchsorted(ends, first, side="right")
                doc = np.array([d for d, *_ in group], np.int64)[own]
                key, names = np.array([t for _, t, *_ in group], np.int64)[own].T
                shift = np.array([a for _, _, a, _ in group], np.int64) - (ends - [len(v) for *_, v in group])
                pos = key << 40 | (first + shift[own]) << 8 | count
                yield from settler.add(_signed(h), _signed(c), doc, pos, names)
        yield from settler.flush()

    return docs.select("doc_id", "text").mapInArrow(run, _ROWS)


def _compare(
    rows: DataFrame, keys: list[str], rule: Rule, leave_open: bool, block_rows: int = ROWS
) -> DataFrame:
    """Settle rows across tasks. With ``leave_open``, a gram with cells that differ gives OPEN rows, one for
    each different cell. A partition is read in order and in bounded blocks; between blocks one row is kept."""
    schema = to_arrow(_parsed(_ROWS))

    def work(block: dict, last: bool):
        """Batches of a block, and the row to keep for the next one (flag 2: already left open)."""
        spans = block["kind"] == SPAN
        if spans.any():
            yield _batch({k: v[spans] for k, v in block.items()}, schema), None
            block = {k: v[~spans] for k, v in block.items()}
        if not len(block["h"]):
            return
        h, c, doc, name, pos = (block[k] for k in ("h", "c", "doc", "name", "pos"))
        gone, on, flag = _settle(h, c, doc, name, pos, block["flag"] & 1, rule)
        if found := _spans(doc[gone], name[gone], pos[gone], rule.length):
            yield _batch(found, schema), None
        order = np.argsort(h[on], kind="stable")
        on, flag = on[order], flag[order]
        begins = np.append(True, h[on][1:] != h[on][:-1])
        at = np.flatnonzero(begins)
        size = np.diff(np.append(at, len(on)))
        told = block["flag"][on] & 2 > 0
        several = np.repeat((size > 1) | np.logical_or.reduceat(told, at), size)
        if leave_open and (several & ~told).any():
            x = on[several & ~told]
            none = np.zeros(len(x), np.int32)
            yield _batch(_going_on(OPEN, h[x], c[x], doc[x], name[x], pos[x], none), schema), None
        if not last:
            x = on[-1:]
            kept = _going_on(CELL, h[x], c[x], doc[x], name[x], pos[x], flag[-1:] | np.int32(2) * several[-1:])
            yield None, kept

    def run(batches):
        kept, parts, held = None, [], 0

        def flush(last):
            nonlocal kept, parts, held
            block = {k: np.concatenate([p[k] for p in parts]) for k in _COLUMNS} if parts else None
            parts, held = [], 0
            if kept is not None:
                block = kept if block is None else {k: np.concatenate((kept[k], block[k])) for k in _COLUMNS}
            kept = None
            if block is not None:
                for out, keep in work(block, last):
                    if out is not None:
                        yield out
                    else:
                        kept = keep

        for batch in batches:
            parts.append({k: batch.column(k).to_numpy(zero_copy_only=False) for k in _COLUMNS})
            held += batch.num_rows
            if held >= block_rows:
                yield from flush(False)
        yield from flush(True)

    dealt = rows.repartition(*keys).sortWithinPartitions("h", "c", "doc", "name", "pos")
    return dealt.mapInArrow(run, _ROWS)


def _open_windows(docs: DataFrame, opened: DataFrame, rule: Rule) -> DataFrame:
    """The windows of the open cells, one row each, after every task has settled its own."""
    schema = to_arrow(_parsed(_ROWS))
    lists = opened.groupBy("doc", "name", F.shiftright("pos", 40).cast("int").alias("tie")).agg(
        F.collect_list(F.struct("h", "pos")).alias("open")  # the open cells of one document
    )
    texts = docs.select(*_key_columns(), "text")

    def windows_of(batch, seen):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        keys = zip(*(batch.column(k).to_pylist() for k in ("doc", "name", "tie")))
        for text, (doc, name, key), found in zip(texts, keys, batch.column("open")):
            if (doc, name, key) in seen:
                continue  # a repeated row: its windows are those of the first
            seen.add((doc, name, key))
            text = text or b""
            h = found.values.field("h").to_numpy()
            pos = found.values.field("pos").to_numpy()
            count = pos & 0xFF
            at = np.repeat((pos >> 8) & 0xFFFFFFFF, count)
            at = at + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            wh = _signed(window_hashes(rule.units(text), at, rule.length))
            place = np.int64(key) << 40 | at << 8 | 1
            own = (np.full(len(at), x, np.int64) for x in (doc, name))
            yield text, at, np.repeat(h, count), wh, *own, place

    def run(batches):
        settler = _Settler(rule, schema)
        held: list[tuple] = []
        seen: set[tuple] = set()  # the documents held

        def settle():
            texts, at, h, wh, doc, name, pos = zip(*held)
            owner = np.repeat(np.arange(len(texts)), [len(x) for x in at])
            at, h, wh, doc, name, pos = (np.concatenate(x) for x in (at, h, wh, doc, name, pos))
            held.clear()
            seen.clear()
            if rule.earlier is not None:
                rank = np.empty(len(at), np.int64)
                rank[np.lexsort((pos, name, doc))] = np.arange(len(at))
                gone = rule.earlier(texts, owner, at, rank)
                if spans := _spans(doc[gone], name[gone], pos[gone], rule.length):
                    yield _batch(spans, schema)
                h, wh, doc, name, pos = (x[~gone] for x in (h, wh, doc, name, pos))
            yield from settler.add(h, wh, doc, pos, name)

        for batch in batches:
            for found in windows_of(batch, seen):
                held.append(found)
                if sum(len(x[1]) for x in held) >= WINDOWS:
                    yield from settle()
        if held:
            yield from settle()
        yield from settler.flush()

    return texts.join(lists, KEY).mapInArrow(run, _ROWS)


def window_hashes(values: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows that begin at ``at`` (in a document of any length)."""
    out = np.empty(len(at), np.uint64)
    for begin in range(0, max(1, len(values)), BUFFER - length):
        mine = (at >= begin) & (at < begin + BUFFER - length)
        if mine.any():
            hashes = RollingHashes(values[begin : begin + BUFFER])
            local = at[mine] - begin
            out[mine] = hashes.ranges(local, local + length)
    return out


def removed_spans(docs: DataFrame, rule: Rule, block_rows: int = ROWS) -> DataFrame:
    """``doc, name, tie, spans``: for each document (null id: NULL_ID) with something to remove, its spans in units
    (start, end exclusive), which may overlap."""
    first = write_stage(_compare(_cell_rows(docs, rule), ["h"], rule, True, block_rows))
    # Each step moves about as much as the input; the files of one go before the next begins.
    release_shuffles(docs.sparkSession)
    windows = _open_windows(docs, first.where(F.col("kind") == OPEN), rule)
    second = write_stage(_compare(windows, ["h", "c"], rule, False, block_rows))
    del windows
    release_shuffles(docs.sparkSession)
    spans = first.where(F.col("kind") == SPAN).unionByName(second)
    place = F.shiftright("pos", 8).bitwiseAND(0xFFFFFFFF)
    return spans.groupBy("doc", "name", F.shiftright("pos", 40).cast("int").alias("tie")).agg(
        F.collect_list(F.struct(place.alias("start"), F.col("c").alias("end"))).alias("spans")  # of one document
    )


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """All columns of ``docs`` in ``row``, and ``spans`` (null: none)."""
    rows = docs.select(*_key_columns(), F.struct("*").alias("row"))
    return rows.join(spans, KEY, "left").select("row", "spans")


def kept_mask(n: int, spans) -> tuple[np.ndarray, int]:
    """Which of n units stay, and the number of maximal removed runs."""
    edge = np.zeros(n + 1, np.int32)
    for s in spans or ():
        edge[min(s["start"], n)] += 1
        edge[min(s["end"], n)] -= 1
    gone = np.cumsum(edge[:n]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return ~gone, runs


def _parsed(schema: str):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(schema)
