"""Creation times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipsieve.functions.text import strip

# First and last second that a calendar date of the years 1 to 9999 can have.
_FIRST_SECOND = -62135596800
_END_SECOND = 253402300800
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def epoch_seconds(value: Column, data_type: T.DataType) -> Column:
    """Epoch seconds as double; null for anything that is not a time within the years 1 to 9999."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        seconds = F.unix_micros(value.cast("timestamp")) / F.lit(1e6)
    elif isinstance(data_type, T.NumericType):
        seconds = value.cast("double")
    else:
        text = strip(value.cast("string"))
        seconds = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when((seconds >= _FIRST_SECOND) & (seconds < _END_SECOND), seconds)


def utc_date(seconds: Column) -> Column:
    """``yyyy-MM-dd``, or the empty string when there is no time. The session time zone must be UTC."""
    return F.coalesce(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd"), F.lit(""))
