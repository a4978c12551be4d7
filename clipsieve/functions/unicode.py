"""Unicode normal forms, computed in the JVM by the ICU library that Spark ships with.

Text that is provably in the wanted form already skips the call.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below U+0300 every character is stable under composition; only ASCII is under compatibility folding.
_MAY_CHANGE_NFC = r"[^\x{0}-\x{2FF}]"
_MAY_CHANGE_NFKC = r"[^\x00-\x7F]"
# Joins the strings of an array for one call. It is whitespace, never composes and never reorders.
_UNIT_SEPARATOR = "\x1f"


def _compose(text: Column, compatibility: bool) -> Column:
    return F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(compatibility)
    )


def nfc(text: Column) -> Column:
    return F.when(text.rlike(_MAY_CHANGE_NFC), _compose(text, False)).otherwise(text)


def nfkc(text: Column) -> Column:
    return F.when(text.rlike(_MAY_CHANGE_NFKC), _compose(text, True)).otherwise(text)


def nfkc_all(texts: Column) -> Column:
    """Compatibility-fold every string of an array without nulls.

    A separator inside a string becomes a space, as the whitespace rules would make it anyway.
    """
    changes = F.exists(texts, lambda text: text.rlike(_MAY_CHANGE_NFKC))
    spaced = F.transform(texts, lambda text: F.translate(text, _UNIT_SEPARATOR, " "))
    folded = _compose(F.array_join(spaced, _UNIT_SEPARATOR), True)
    return F.when(changes, F.split(folded, _UNIT_SEPARATOR)).otherwise(texts)
