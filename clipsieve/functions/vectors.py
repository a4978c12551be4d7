"""Vector arithmetic."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from clipsieve import schemas


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, product: total + product)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def ratio(part: Column, whole: Column) -> Column:
    """Quotient that is 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two arrays, 0 if either has no length."""
    return ratio(dot(left, right), norm(left) * norm(right))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def best_cosine(centers: Sequence[Sequence[float]]) -> Callable[[Column], Column]:
    """Function giving each vector's largest cosine to any of a few fixed centers.

    One matrix product per Arrow batch; the centers travel with the function.
    """
    directions = unit_rows(np.asarray(centers, dtype=float)).T

    @F.pandas_udf(schemas.DOUBLE)
    def strength(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype=float)
        rows = unit_rows(np.stack(vectors.to_list()).astype(float))
        return pd.Series((rows @ directions).max(axis=1))

    return strength
