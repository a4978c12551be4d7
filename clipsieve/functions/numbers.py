"""Numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column | str, digits: int) -> Column:
    """A number with so many decimals; exact ties go to the even digit (0.125 is 0.12), as Python writes them.

    ``format_string`` rounds them up."""
    column = F.col(value) if isinstance(value, str) else value
    return F.call_function("format_number", column.cast("double"), F.lit("0." + "0" * digits))
