"""Which ids two or more stages hold differently, without moving the ids that they share.

Each stage is summed into a small table of cells: every id adds its hash to three of them. The table of one stage
minus that of another holds only what differs, as equal ids cancel out. A cell in which one id is left gives this
id's hash; taking it away from its two other cells lays more of them open, until the table is empty. A table too
small for the differences does not become empty; a larger one is tried, and at last all ids are counted.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of each of the three parts of a table, as powers of two: tables are tried in this order. The last one
#: yields about 300,000 differing ids a stage, and the driver holds at most 393,216 rows of it.
PART_BITS = (11, 14, 17)
_PARTS = 3
_HALF = 0xFFFFFFFF
_FIELDS = ("n", "low", "high", "check")


def _hash(video_id: Column | str = "video_id") -> Column:
    return F.xxhash64(video_id)  # a null id has a hash as well


def _tagged(stages: Mapping[str, DataFrame]) -> DataFrame:
    rows = [frame.select("video_id", F.lit(i).alias("stage")) for i, frame in enumerate(stages.values())]
    return reduce(DataFrame.unionByName, rows)


def _places(key: int, bits: int) -> list[int]:
    return [(part << bits) | ((key >> (21 * part)) & ((1 << bits) - 1)) for part in range(_PARTS)]


def _check(key: int) -> int:
    return zlib.crc32(str(key).encode())


def summary(stages: Mapping[str, DataFrame], bits: int) -> DataFrame:
    """``cell, n_1, low_1, high_1, check_1, n_2, …``: what each stage after the first holds more than the first,
    summed by cell, where any of them differs. Partial sums are at most a row per task, stage and cell."""
    key = F.col("key")
    cell = F.explode(
        F.array(
            *[
                F.shiftrightunsigned(key, 21 * part).bitwiseAND(F.lit((1 << bits) - 1)) + F.lit(part << bits)
                for part in range(_PARTS)
            ]
        )
    )
    cells = _tagged(stages).select("stage", _hash().alias("key")).select(
        "stage",
        cell.alias("cell"),
        # Halves, so that sums of whole stages stay within a long.
        key.bitwiseAND(F.lit(_HALF)).alias("low"),
        F.shiftrightunsigned(key, 32).alias("high"),
        F.crc32(key.cast("string").cast("binary")).alias("check"),
    )
    sums = cells.groupBy("cell", "stage").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(name).alias(name) for name in _FIELDS[1:]]
    )

    def held(name: str, stage: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("stage") == stage, F.col(name))), F.lit(0))

    more = sums.groupBy("cell").agg(
        *[
            (held(name, stage) - held(name, 0)).alias(f"{name}_{stage}")
            for stage in range(1, len(stages))
            for name in _FIELDS
        ]
    )
    differs = reduce(Column.__or__, [F.col(name) != 0 for name in more.columns if name != "cell"])
    return more.where(differs)


def peel(cells: Mapping[int, Sequence[int]], bits: int) -> dict[int, int] | None:
    """Hash to surplus (negative: lacking) of a table of differences; None if it does not become empty."""
    table = {cell: list(fields) for cell, fields in cells.items()}
    found: dict[int, int] = {}
    ready = list(table)
    while ready:
        cell = ready.pop()
        n, low, high, check = table.get(cell, (0, 0, 0, 0))
        if n == 0 or low % n or high % n or check % n:
            continue
        low, high, check = low // n, high // n, check // n
        unsigned = (high << 32) | low
        if not (0 <= low <= _HALF and 0 <= high <= _HALF) or cell not in _places(unsigned, bits):
            continue
        key = unsigned - (1 << 64) if unsigned >> 63 else unsigned
        if check != _check(key):
            continue
        found[key] = found.get(key, 0) + n
        if len(found) > _PARTS << bits:
            return None
        for place in _places(unsigned, bits):
            fields = table.setdefault(place, [0, 0, 0, 0])
            for i, value in enumerate((1, low, high, check)):
                fields[i] -= n * value
            ready.append(place)
    return None if any(any(fields) for fields in table.values()) else {k: n for k, n in found.items() if n}


def differing_hashes(stages: Mapping[str, DataFrame], part_bits: Sequence[int] = PART_BITS) -> set[int] | None:
    """Hashes of the ids that a stage holds more or less often than the first; None if no table yields them."""
    if len(stages) < 2:
        return set()
    for bits in part_bits:
        rows = summary(stages, bits).collect()  # at most 3 << bits rows
        found: set[int] | None = set()
        for stage in range(1, len(stages)):
            names = [f"{name}_{stage}" for name in _FIELDS]
            peeled = peel({row["cell"]: [row[name] for name in names] for row in rows}, bits)
            if peeled is None:
                found = None
                break
            found |= peeled.keys()
        if found is not None:
            return found
    return None


def differing_ids(stages: Mapping[str, DataFrame], part_bits: Sequence[int] = PART_BITS) -> DataFrame:
    """``video_id, stage, n, n_first``: every id that a stage holds more or less often than the first stage, and
    how often both hold it.

    What is shuffled grows with the differences, not with the stages: cells, and then the rows of differing ids
    alone. The numbers are exact; an id is missed only if ids of equal 64-bit hash make up for each other, as in
    the fingerprint. A null id is an id of its own. Ids that all stages repeat alike do not differ. Empty stages
    lack all ids; a single stage, or stages that agree, give no row. Beyond the largest table all ids are counted.
    """
    names = list(stages)
    rows = _tagged(stages)
    hashes = differing_hashes(stages, part_bits)
    if hashes is not None:
        wanted = rows.sparkSession.createDataFrame([(key,) for key in sorted(hashes)], "key long")
        rows = rows.join(wanted, _hash(rows["video_id"]) == wanted["key"], "left_semi")
    counts = rows.groupBy("video_id").agg(
        *[F.count_if(F.col("stage") == i).alias(f"n_{i}") for i in range(len(names))]
    )
    others = F.array(
        *[
            F.struct(F.lit(name).alias("stage"), F.col(f"n_{i}").alias("n"), F.col("n_0").alias("n_first"))
            for i, name in enumerate(names)
        ]
    )
    return counts.select("video_id", F.inline(others)).where(F.col("n") != F.col("n_first"))
