"""The most frequent values of a column without counting every value.

A mergeable summary of bounded size (frequent items, with map-side partial summaries) proposes candidates, and
these alone are counted exactly. The summary's error is known beforehand from its size and the number of rows, so
it can be told whether a value that it does not hold could belong to the first ``n``. Where that cannot be ruled
out, all values are candidates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A summary that tracks ``m`` items is off by at most this many times ``rows / m`` (3.5 over the size of its
#: table, which is at least ``m / 0.75``).
ERROR_FACTOR = 3.5 * 0.75
#: Partial summaries are merged in so many tasks before the last one.
_MERGES = 64


def candidates(values: DataFrame, n: int, tracked: int) -> DataFrame | None:
    """``value``: a bounded set of values that surely holds the ``n`` most frequent ones of ``value``, ties at the
    last place included; None if the summary cannot prove that. Nulls are not counted.

    At most ``tracked`` values are held in a task and in the result. An estimate is never below the count and never
    above it by more than the error; a value that is not tracked occurs at most as often as the error.
    """
    held = values.where(F.col("value").isNotNull())
    partial = held.groupBy((F.spark_partition_id() % _MERGES).alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(value, {tracked})").alias("summary")
    )
    partial = partial.persist()  # at most one row for each merging task
    found = None
    try:
        rows = partial.agg(F.sum("rows")).first()[0]
        if rows is None:
            return values.sparkSession.createDataFrame([], values.select("value").schema)
        # In one partition: the function cannot merge the state of an empty one.
        combined = partial.coalesce(1).agg(F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary"))
        found = combined.select(F.inline(F.expr(f"approx_top_k_estimate(summary, {tracked})"))).persist()
        error = ERROR_FACTOR * rows / tracked
        of_nth = found.orderBy(F.desc("count")).select("count").offset(n - 1).limit(1).first()
        if of_nth is None:
            # Fewer values than asked are tracked. None was dropped if the table never filled up.
            least = 0.0
            proven = found.count() < tracked // 2 and found.agg(F.sum("count")).first()[0] == rows
        else:
            least = of_nth[0] - error  # the n-th most frequent value occurs at least so often
            proven = least > error
        if not proven:
            return None
        # The list is bounded by ``tracked`` and small beside the values; it is planned as what it is.
        return found.sparkSession.createDataFrame(
            [(r["item"],) for r in found.where(F.col("count") >= least).select("item").collect()],
            values.select("value").schema,
        )
    finally:
        if found is not None:
            found.unpersist()
        partial.unpersist()
