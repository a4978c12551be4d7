"""SimHash near-duplicates by tiled exact comparison.

A fingerprint bit is the majority of that bit over the hashes of all shingles. Different fingerprints are
sorted into tiles by the population counts of their parts: flipping a bit changes one count by one, so tiles
whose counts differ by more than the radius in sum hold no link and their pair is skipped. The other pairs are
compared in full, with exclusive-or and bit counts in numpy. Large tiles are cut into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsieve.llm.components import connected
from clipsieve.llm.stages import release_shuffles, write_stage
from clipsieve.llm.texts import map_batches, texts_of, to_arrow
from clipsieve.llm.windows import mix

SEED, SHINGLE, RADIUS = 42, 3, 2
#: Parts of a fingerprint that are counted alone, and about how many fingerprints a block has.
PARTS, BLOCK_ROWS = 4, 1 << 14
#: For ``keep_one``: words of 64 bits, bits by which candidates may differ, least Jaccard similarity. Sets at
#: that similarity are 25 to 40 bits apart on average (standard deviation 6), but sets of 4 and 5 are 48.
WIDE, WIDE_RADIUS, SIMILARITY = 4, 76, 0.8
#: Sets of at most so many shingles are also candidates with every set that they have one shingle more than.
SMALL = 8
#: Sets, and shingles in them, that a block has about where the sets of a group are compared.
SET_BLOCK_ROWS, SET_BLOCK_GRAMS = 2048, 1 << 20
_CELLS = 1 << 21  # exclusive-ors at once
_AT_ONCE = 1 << 15  # hashes whose bits are counted at once


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of the shingles of a text: its words, A-Z in lower case, joined by spaces, repeats included. A
    shorter text is one shingle; without a word there is none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    n, digest = len(words) - shingle + 1, xxhash.xxh64_intdigest
    grams = zip(*(words[i:] for i in range(shingle)))
    return np.fromiter((digest(b" ".join(g), SEED) for g in grams), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have; 0 for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _AT_ONCE):
        octets = hashes[at : at + _AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, shingle))


def set_name(grams: np.ndarray) -> int:
    """The hash of a sorted set of shingle hashes, as a signed long."""
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes(), SEED)).view(np.int64))


def wide_fingerprint(hashes: np.ndarray, words: int) -> np.ndarray:
    """Several words of 64 bits, each from the hashes spread anew."""
    steps = [np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)) for k in range(words)]
    return np.array([majority(mix(hashes + k) if k else hashes) for k in steps], np.uint64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) for each row of ``doc_id, text``; null text has none."""

    def run(batch):
        found = np.array([fingerprint(t, shingle) for t in texts_of(batch)], np.uint64)
        yield {"doc_id": batch.column("doc_id"), "fp": found.view(np.int64)}

    return map_batches(docs, ["doc_id", "text"], run, "doc_id long, fp long")


def part_counts(fp: Column, parts: int) -> list[Column]:
    """The population counts of the parts of a 64-bit fingerprint."""
    width = 64 // parts
    ones = (1 << width) - 1 if width < 64 else -1
    return [F.bit_count(F.shiftrightunsigned(fp, width * i).bitwiseAND(F.lit(ones).cast("long"))) for i in range(parts)]


def _near_tiles(radius: int, sides: list[int], width: int, banded: bool) -> list[tuple[int, ...]]:
    """Steps between tiles that may hold links, one of each two directions, the tile itself left out.

    The bits by which counts differ at least, summed over the parts, are at most the radius; a band, the
    last entry, differs by one at most."""
    far = 1 + (radius - 1) // width
    spans = [range(-far, far + 1)] * (len(sides) - banded) + [range(-1, 2)] * banded
    out = []
    for step in product(*spans):
        least = sum((abs(d) - 1) * width + 1 for d in step[: len(step) - banded] if d)
        if any(step) and least <= radius and next(x for x in step if x) > 0:
            out.append(step)
    return out


class _Forest:
    """Union-find over the links of one block; only links that join something are kept."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        above = self.above
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    def joins(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)
        return a != b


def _compare(left: np.ndarray, right: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in two arrays (one row of 64-bit words per fingerprint) of pairs within the radius, nearest
    first of some rows of the left array at a time. Wide fingerprints are compared by all but their last word first."""
    words = left.shape[1]
    front = max(1, words - 1)
    step = max(1, _CELLS // max(1, len(right)))
    for at in range(0, len(left), step):
        part = left[at : at + step]
        apart = np.bitwise_count(part[:, None, 0] ^ right[None, :, 0])
        for w in range(1, front):
            apart = apart + np.bitwise_count(part[:, None, w] ^ right[None, :, w])
        i, j = np.nonzero(apart <= radius)
        if len(i):
            whole = np.bitwise_count(part[i] ^ right[j]).sum(axis=1)
            order = np.argsort(whole, kind="stable")
            order = order[whole[order] <= radius]
            yield at + i[order], j[order]


def links(
    distinct: DataFrame,
    counts: list[Column],
    radius: int = RADIUS,
    side: int = 64 // PARTS + 1,
    width: int = 1,
    code: Column | None = None,
    band: Column | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``a, b``: links that connect all ``fp`` of ``distinct`` (all different) which links of at most
    ``radius`` bits connect. Within a pair of blocks only a spanning forest of its links is returned.

    ``counts`` are the population counts of parts, each below ``side``; ``width`` counts share a tile.
    ``code`` is the whole fingerprint where ``fp`` is only its name. With ``band``, a number from 0 to 127,
    bands more than one apart hold no link.
    """
    bins = [F.floor(c / width).cast("long") for c in counts] + ([band.cast("long")] if band is not None else [])
    sides = [-(-side // width)] * len(counts) + ([128] if band is not None else [])
    scale = [int(np.prod(sides[:i], dtype=np.int64)) for i in range(len(sides))]
    tile = sum((b * k for b, k in zip(bins, scale)), F.lit(0).cast("long"))
    coded = code is not None
    held, named = ["fp", *["code"] * coded], [F.col("fp"), *([code.alias("code")] if coded else [])]
    rows = distinct.select(*named, tile.alias("tile"), F.array(*bins).alias("bins"))
    # At most as many rows as tiles, which the sides bound.
    blocks = rows.groupBy("tile").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    blocks = F.broadcast(write_stage(blocks))
    placed = rows.join(blocks, "tile").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    home = F.struct(F.col("tile"), F.col("block"), F.lit(False).alias("guest"))
    later = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b > F.col("block")),
        lambda b: F.struct(F.col("tile").alias("tile"), b.alias("block"), F.lit(True).alias("guest")),
    )
    own = placed.select(*held, F.explode(F.concat(F.array(home), later)).alias("at")).select(*held, "at.*")
    targets = []
    for step in _near_tiles(radius, sides, width, band is not None):
        fits = F.lit(True)
        for i, d in enumerate(step):
            if d:
                fits = fits & (F.col("bins")[i] + d).between(0, sides[i] - 1)
        targets.append(F.when(fits, F.col("tile") + sum(d * k for d, k in zip(step, scale))))
    visits = rows.select(*held, F.explode(F.array_compact(F.array(*targets))).alias("tile")).join(blocks, "tile")
    visits = visits.select(*held, "tile", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    everything = own.unionByName(visits.withColumn("guest", F.lit(True)))
    schema = "a long, b long"
    arrow = to_arrow_schema(schema)

    def run(batches):
        key, homes, forest = None, [], _Forest()
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            if not coded:
                codes = fp.view(np.uint64).reshape(-1, 1)
            else:
                codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint64).reshape(len(fp), -1)
            place = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("tile", "block", "guest")]
            place = np.stack(place)
            cuts = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1
            out = []
            for begin, end in zip([0, *cuts], [*cuts, len(fp)]):
                if begin == end:
                    continue
                if key != (place[0, begin], place[1, begin]):
                    key, homes, forest = (place[0, begin], place[1, begin]), [], _Forest()
                mine, own_codes = fp[begin:end], codes[begin:end]
                if not place[2, begin]:
                    homes.append((mine, own_codes))  # so that the stretch is also compared with itself
                for other, other_codes in homes:
                    for i, j in _compare(own_codes, other_codes, radius):
                        pairs = zip(mine[i].tolist(), other[j].tolist())
                        out += [p for p in pairs if p[0] != p[1] and forest.joins(*p)]
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip("ab", map(list, zip(*out)))), schema=arrow)

    dealt = everything.repartition("tile", "block").sortWithinPartitions("tile", "block", "guest")
    return dealt.select("tile", "block", "guest", *held).mapInArrow(run, schema)


def to_arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow(_parse_datatype_string(schema))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, parts: int = PARTS) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` (least ``doc_id`` that links reach) for
    each row of ``doc_id, text``.

    Texts without words, null ones too, have fingerprint 0 and link like any other. Null ids are returned
    with the component of their fingerprint, whose id is null if no row in it has one. Repeated rows are
    kept. An empty table gives no row.
    """
    prints = write_stage(fingerprints(docs, shingle))
    distinct = write_stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    counts = part_counts(F.col("fp"), parts)
    roots = connected(links(distinct.select("fp"), counts, radius, 64 // parts + 1))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = write_stage(rooted.join(least, "root").select("fp", "component_id"))
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``fp, grams``: the different shingle hashes of each text of ``fp, text``."""

    def run(batch):
        sets = [np.unique(shingle_hashes(t, shingle)).view(np.int64) for t in texts_of(batch)]
        yield {"fp": batch.column("fp"), "grams": sets}

    return map_batches(docs, ["fp", "text"], run, "fp long, grams array<long>")


class _SetBlock:
    """Shingle sets with their fingerprints and the components that they are known to be in."""

    def __init__(self, rows: list[tuple]):
        names, roots, codes, grams = zip(*rows)
        self.names, self.roots = np.array(names), np.array(roots)
        self.codes = np.frombuffer(b"".join(codes), np.uint64).reshape(len(rows), -1)
        self.grams = grams
        self.sizes = np.array([len(g) for g in grams])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.different, self.at = np.unique(np.concatenate(grams), return_inverse=True)

    def similar(self, code: np.ndarray, grams: np.ndarray, roots: np.ndarray, root: int, upto: int, similarity: float, radius: int):
        """Places, before ``upto``, of sets in other components that are candidates and as similar as asked."""
        size, sizes = len(grams), self.sizes[:upto]
        fits = (roots[:upto] != root) & (np.minimum(sizes, size) >= similarity * np.maximum(sizes, size))
        if not fits.any():
            return ()
        near = np.bitwise_count(self.codes[:upto] ^ code).sum(axis=1) <= radius
        fits &= near | (np.minimum(sizes, size) <= SMALL)
        if not fits.any():
            return ()
        place = np.minimum(np.searchsorted(self.different, grams), len(self.different) - 1)
        marked = np.zeros(len(self.different), np.int32)
        marked[place[self.different[place] == grams]] = 1
        chosen = np.flatnonzero(fits)
        if 4 * len(chosen) < upto:
            shared = np.array([marked[self.at[b : b + n]].sum() for b, n in zip(self.starts[chosen], self.sizes[chosen])])
        else:
            end = self.starts[upto - 1] + self.sizes[upto - 1]
            shared = np.add.reduceat(marked[self.at[:end]], self.starts[:upto])[chosen]
        return chosen[shared >= similarity * (self.sizes[chosen] + size - shared)]


def _links_in_groups(rows: DataFrame, sets: DataFrame, similarity: float, radius: int) -> DataFrame:
    """``a, b``: links that hold between different roots of a group, a forest of each pair of blocks.

    Takes ``fp, group, root, code, n_grams`` and ``fp, grams`` (sorted, none empty). A group of any size is cut in
    blocks, bounded in rows and shingles, and each pair of blocks is a task's key of its own. Pairs that do not
    hold, or whose ends are already joined, are never rows, so that a pair of blocks returns fewer rows than
    it takes in."""
    size = F.greatest(F.count("*") / SET_BLOCK_ROWS, F.sum("n_grams") / SET_BLOCK_GRAMS)
    blocks = rows.groupBy("group").agg(F.ceil(size).cast("int").alias("blocks"))
    placed = rows.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(
            F.least(k, F.col("block")).alias("low"), F.greatest(k, F.col("block")).alias("high"), (F.col("block") > k).alias("guest")
        ),
    )
    held = ["group", "low", "high", "guest", "fp", "root", "code", "grams"]
    dealt = placed.join(sets, "fp").select("group", "fp", "root", "code", "grams", F.inline(pairs)).select(held)
    dealt = dealt.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high", "guest", "fp")
    schema = "a long, b long"
    arrow = to_arrow_schema(schema)

    def of_batch(batch):
        columns = [batch.column(c).to_pylist() for c in held[:-1]]
        grams = batch.column("grams")
        values, ends = grams.values.to_numpy(), grams.offsets.to_numpy()
        for i, row in enumerate(zip(*columns)):
            yield row[:4], (*row[4:], values[ends[i] : ends[i + 1]].copy())

    def run(batches):
        key, homes, block, forest, roots = None, [], None, None, None

        def compare(row, upto):
            name, root, code, grams = row
            root = forest.root(root)
            code = np.frombuffer(code, np.uint64)
            for j in block.similar(code, grams, roots, root, upto, similarity, radius):
                mine, other = forest.root(root), forest.root(int(roots[j]))
                if mine != other:
                    forest.joins(mine, other)
                    roots[roots == max(mine, other)] = min(mine, other)
                    yield name, int(block.names[j])

        def begin():
            nonlocal block, forest, roots
            block, forest = _SetBlock(homes), _Forest()
            roots = block.roots.copy()

        def inside():
            """The links of a block with itself, once it is whole."""
            if homes and key[1] == key[2]:
                begin()
                for i, row in enumerate(homes[1:], 1):
                    yield from compare(row, i)

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], schema=arrow)

        for batch in batches:
            found = []
            for (group, low, high, guest), row in of_batch(batch):
                if key != (group, low, high):
                    found += inside()
                    key, homes, block = (group, low, high), [], None
                if not guest:
                    homes.append(row)
                elif homes:
                    if block is None:
                        begin()
                    found += compare(row, len(homes))
            if found:
                yield out(found)
        found = list(inside())
        if found:
            yield out(found)

    return dealt.mapInArrow(run, schema)


def keep_one(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    shingle: int = 5,
    words: int = WIDE,
    radius: int = WIDE_RADIUS,
) -> DataFrame:
    """The rows of ``docs`` (all columns) without near-duplicates: one of each group stays, the one with the
    least ``doc_id`` (null last), of rows that share it the one with the least text hash.

    Candidates differ in at most ``radius`` of ``words * 64`` bits, or are small sets of which one has one
    shingle more. They are confirmed by the Jaccard similarity of their sets of ``shingle`` words: first the
    links of a spanning forest; where one of them fails, all candidates that confirmed links do not yet
    connect (these are looked through inside the tasks, of which each returns a forest of links that hold; see
    ``_links_in_groups``). Fingerprints are of these sets, without repeats. Texts with equal sets (by a hash of 64 bits) are one text here, so all rows
    without a word, null ones too, are one group. An empty table stays empty.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")

    def run(batch):
        names, codes, ones, sizes, less = [], [], [], [], []
        for text in texts_of(batch):
            grams = np.unique(shingle_hashes(text, shingle))
            code = wide_fingerprint(grams, words)
            codes.append(code.tobytes())
            names.append(set_name(grams))
            ones.append(int(np.bitwise_count(code).sum()))
            sizes.append(len(grams))
            few = range(len(grams)) if 1 < len(grams) <= SMALL else ()
            less.append([set_name(np.delete(grams, i)) for i in few])
        yield {
            "doc_id": batch.column("doc_id"), "tie": batch.column("tie"), "fp": names, "code": codes,
            "ones": ones, "n_grams": sizes, "less": less,
        }

    schema = "doc_id long, tie long, fp long, code binary, ones int, n_grams int, less array<long>"
    prints = write_stage(map_batches(rows, ["doc_id", "tie", "text"], run, schema))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")
    distinct = write_stage(
        prints.groupBy("fp").agg(
            F.min("code").alias("code"), F.min("ones").alias("ones"), F.min("n_grams").alias("n_grams"),
            F.min("less").alias("less"), F.min(order).alias("first"),
        )
    )
    # Sets as similar as asked differ in size by one band at most.
    band = F.floor(F.log(F.greatest("n_grams", F.lit(1))) / F.log(F.lit(1 / similarity)) + 1e-9)

    def candidates(of: DataFrame) -> DataFrame:
        side, width = 64 * words + 1, max(1, radius // 2)
        return links(of, [F.col("ones")], radius, side, width, F.col("code"), F.least(band, F.lit(127)))

    def sets_of(found: DataFrame) -> DataFrame:
        asked = found.select(F.col("a").alias("fp")).union(found.select("b")).distinct()
        asked = asked.join(distinct.select("fp", "first.doc_id", "first.tie"), "fp")
        same_row = rows["doc_id"].eqNullSafe(asked["doc_id"]) & rows["tie"].eqNullSafe(asked["tie"])
        release_shuffles(docs.sparkSession)
        # A repeated row has the same set.
        return write_stage(_shingle_sets(rows.join(asked, same_row).select("fp", "text"), shingle).dropDuplicates(["fp"]))

    def confirm(found: DataFrame, sets: DataFrame) -> DataFrame:
        left = sets.select(F.col("fp").alias("a"), F.col("grams").alias("grams_a"))
        right = sets.select(F.col("fp").alias("b"), F.col("grams").alias("grams_b"))
        shared = F.size(F.array_intersect("grams_a", "grams_b"))
        confirmed = found.join(left, "a").join(right, "b").where(
            shared >= F.lit(similarity) * (F.size("grams_a") + F.size("grams_b") - shared)
        )
        return write_stage(confirmed.select("a", "b"))

    names = distinct.select(F.col("fp").alias("b"))
    one_more = distinct.select(F.col("fp").alias("a"), F.explode("less").alias("b")).join(names, "b").select("a", "b")
    found = write_stage(candidates(distinct).unionByName(one_more).distinct())
    sets = sets_of(found)
    confirmed = confirm(found, sets)
    if confirmed.count() < found.count():
        # A link that failed may have stood in for one that holds.
        group = connected(found).select("node", F.col("root").alias("group"))
        root = connected(confirmed)
        labelled = group.join(root, "node", "left").select("node", "group", F.coalesce("root", "node").alias("root"))
        labelled = write_stage(labelled)
        several = labelled.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        open_groups = several.where("low < high").select("group")
        again = labelled.join(open_groups, "group").join(distinct, labelled["node"] == distinct["fp"])
        again = write_stage(again.where("n_grams > 0").select("fp", "group", "root", "code", "n_grams"))
        release_shuffles(docs.sparkSession)
        more = write_stage(_links_in_groups(again, sets, similarity, radius))
        confirmed = confirmed.unionByName(more)
    roots = connected(confirmed)
    first = distinct.join(roots, distinct["fp"] == roots["node"], "left").groupBy(F.coalesce("root", "fp")).agg(
        F.min("first").alias("first")
    )
    stays = write_stage(first.select("first.doc_id", "first.tie"))
    del confirmed, roots
    release_shuffles(docs.sparkSession)
    whole = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("tie"))
    same_row = whole["doc_id"].eqNullSafe(stays["doc_id"]) & whole["tie"].eqNullSafe(stays["tie"])
    kept = whole.join(stays, same_row, "left_semi").dropDuplicates(["doc_id", "tie"])
    return kept.select("row.*")
