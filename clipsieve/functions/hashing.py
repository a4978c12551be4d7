"""Order-free fingerprints of id columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hex_to_long(digest: Column, start: int) -> Column:
    # 15 hex digits fit a signed 64-bit integer.
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")


def id_fingerprint(ids: Column) -> Column:
    """md5 over count, xor and sum of per-id md5 parts.

    Equal multisets of ids give equal fingerprints. The state is three numbers, so it aggregates
    map-side and never sorts or concatenates the ids, as hashing a joined id list would have to.
    """
    digest = F.md5(ids)
    return F.md5(
        F.concat_ws(
            "|",
            F.count(ids).cast("string"),
            F.bit_xor(_hex_to_long(digest, 1)).cast("string"),
            F.sum(_hex_to_long(digest, 17).cast("decimal(38,0)")).cast("string"),
        )
    )
