"""Array helpers that keep per-row work inside the row, so that no shuffle is needed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Inside a lambda a plain nested expression would be evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def explode_items(rows: DataFrame, keep: Sequence[str], items: Column, name: str = "item") -> DataFrame:
    """One row per non-null array element.

    The outer form keeps the optimizer from testing the array's size in a filter of its own, which
    would compute a derived array a second time.
    """
    return rows.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())


def empty_array(ddl: str) -> Column:
    return F.array().cast(f"array<{ddl}>")


def string_list(values: Sequence[str]) -> Column:
    """A literal array of strings."""
    return F.lit(list(values)) if values else empty_array("string")


def is_any_of(value: Column, words: Sequence[str]) -> Column:
    """Membership in a literal word set (a hash set at run time)."""
    return value.isin(*words) if words else F.lit(False)


def value_counts(values: Column) -> Column:
    """``array<string>`` to ``array<struct<value, n>>``: distinct values with their counts.

    Sorts the array and measures runs, so it costs n log n within the row instead of a shuffle.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return bind(
            starts,
            lambda first: F.transform(
                first,
                lambda i, k: F.struct(
                    F.get(ordered, i).alias("value"),
                    (F.coalesce(F.get(first, k + 1), F.size(ordered)) - i)
                    .cast("bigint")
                    .alias("n"),
                ),
            ),
        )

    none = empty_array("struct<value:string,n:bigint>")
    return bind(
        F.sort_array(values), lambda ordered: F.when(F.size(ordered) > 0, runs(ordered)).otherwise(none)
    )
