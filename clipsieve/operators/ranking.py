"""Top-n per group without a hot task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SALTS = 64


def top_n(rows: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group in a total order, with their ``rank``.

    Up to the session's limit, ``n`` is pruned map-side by the planner. Beyond that, one group's rows are first ranked in
    salted slices, so a group holding a third of all rows is sorted by many tasks and the final sort
    sees at most ``n`` rows per slice. The result is the same: a row in the top ``n`` of its group is
    in the top ``n`` of its slice.
    """
    final = Window.partitionBy(*groups).orderBy(*order)
    pruned = int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > pruned:
        slices = Window.partitionBy(*groups, "_salt").orderBy(*order)
        rows = (
            rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(_SALTS)))
            .withColumn("_slice_rank", F.row_number().over(slices))
            .filter(F.col("_slice_rank") <= n)
            .drop("_salt", "_slice_rank")
        )
    return rows.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= n)
