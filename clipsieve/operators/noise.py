"""Which words are removed, which platform words occur and which words remain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsieve.functions.arrays import explode_items, is_any_of
from clipsieve.functions.text import is_noise
from clipsieve.operators import heavy
from clipsieve.operators.evidence import unfiltered_tokens
from clipsieve.operators.ranking import top_n
from clipsieve.settings import Settings

REPORT_LIMIT = 25


def token_noise_report(evidence: DataFrame, settings: Settings, limit: int = REPORT_LIMIT) -> DataFrame:
    """``section, token, n, rank``: top tokens of the sections removed, platform and kept.

    Tokens are counted once, with map-side partial counts; a token's sections follow from the counted
    words, so the classification runs over the vocabulary and not over the occurrences. With
    ``settings.summary_values`` a summary chooses the kept tokens that can be among the first, if it can prove
    them, and only these and the words of the lists are counted; the rows are the same.
    """
    tokens = explode_items(unfiltered_tokens(evidence, settings), [], F.col("tokens"), "token")
    if settings.summary_values:
        listed = is_noise(F.col("token"), settings.noise) | is_any_of(F.col("token"), settings.noise.platform)
        values = tokens.where(~listed).select(F.col("token").alias("value"))
        chosen = heavy.candidates(values, limit, settings.summary_values)
        if chosen is not None:
            known = tokens.join(chosen, tokens["token"] == chosen["value"], "left")
            tokens = known.where(listed | F.col("value").isNotNull()).select("token")
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    noise = is_noise(F.col("token"), settings.noise)
    platform = is_any_of(F.col("token"), settings.noise.platform)
    sections = F.array_compact(
        F.array(
            F.when(noise, F.lit("removed")).otherwise(F.lit("kept")),
            F.when(platform, F.lit("platform")),
        )
    )
    return top_n(
        counted.select(F.explode(sections).alias("section"), "token", "n"),
        ["section"],
        [F.desc("n"), F.asc("token")],
        limit,
    )
