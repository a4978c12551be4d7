"""Exact quantiles per group, whatever its size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipsieve.session import materialize

# A sketch of this accuracy is off by one rank in _ACCURACY; cuts lie on both sides of each quantile.
_ACCURACY = 10_000
_MARGINS = (4 / _ACCURACY, 40 / _ACCURACY)


def exact_quantiles(
    rows: DataFrame, group: str, value: str, probabilities: Sequence[float]
) -> DataFrame:
    """``group, probability, quantile`` with linear interpolation between neighbours.

    A sketch of fixed size gives cuts around each quantile, which divide a group's values into sections.
    Rows are counted by section; the counts say which section holds a wanted rank, and only the values of
    these sections are ranked. The cuts decide how many values that is, not the result. All counts have
    map-side partial sums and ties are one row, so a group with a third of all rows puts only the values
    near its quantiles into one task.
    """
    data = rows.select(group, F.col(value).cast("double").alias("_value")).filter("_value is not null")
    cuts = sorted({min(1.0, max(0.0, q + side * m)) for q in probabilities for m in _MARGINS for side in (-1, 1)})
    bounds = materialize(
        data.groupBy(group).agg(
            F.count(F.lit(1)).alias("n"), F.percentile_approx("_value", cuts, _ACCURACY).alias("_cuts")
        )
    )
    section = F.size(F.filter("_cuts", lambda cut: cut < F.col("_value")))
    placed = data.join(bounds, group).select(group, "_value", section.alias("_section"))
    in_order = Window.partitionBy(group).orderBy("_section")
    sections = (
        placed.groupBy(group, "_section")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_end", F.sum("_rows").over(in_order))
    )
    position = F.col("probability") * (F.col("n") - 1)
    sides = F.array(F.floor("_position"), F.ceil("_position"))
    wanted = (
        bounds.select(group, "n", F.explode(F.array(*[F.lit(float(q)) for q in probabilities])).alias("probability"))
        .withColumn("_position", position)
        .withColumn("_rank", F.explode(F.array_distinct(sides)))
        .join(sections, group)
        .filter((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_rows")))
        .select(
            group, "_section", "probability", "_position", "_rank",
            (F.col("_rank") - F.col("_end") + F.col("_rows")).alias("_place"),
        )
    )
    wanted = materialize(wanted)
    inside = Window.partitionBy(group, "_section").orderBy("_value")
    values = (
        placed.join(wanted.select(group, "_section").distinct(), [group, "_section"], "left_semi")
        .groupBy(group, "_section", "_value")
        .agg(F.count(F.lit(1)).alias("_times"))
        .withColumn("_until", F.sum("_times").over(inside))
    )
    found = values.join(wanted, [group, "_section"]).filter(
        (F.col("_place") < F.col("_until")) & (F.col("_place") >= F.col("_until") - F.col("_times"))
    )
    left, right = F.min_by("_value", "_rank"), F.max_by("_value", "_rank")
    share = F.max("_position") - F.floor(F.max("_position"))
    return found.groupBy(group, "probability").agg((left + (right - left) * share).alias("quantile"))


def strength_quantiles(clusters: DataFrame) -> DataFrame:
    """``cluster_id, strength_median, strength_iqr``."""
    rows = exact_quantiles(clusters, "cluster_id", "strength", (0.25, 0.5, 0.75))

    def at(q: float):
        return F.max(F.when(F.col("probability") == q, F.col("quantile")))

    return rows.groupBy("cluster_id").agg(
        at(0.5).alias("strength_median"), (at(0.75) - at(0.25)).alias("strength_iqr")
    )
