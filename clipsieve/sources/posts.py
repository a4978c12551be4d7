"""Reading tables of posts and resolving their columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipsieve.functions.challenges import parse_challenges
from clipsieve.functions.dates import epoch_seconds

# Accepted input names of each canonical column, in priority order.
COLUMN_ALIASES = {
    "video_id": ("video_id", "id", "aweme_id"),
    "author_id": ("author_id", "user_id", "uid"),
    "created_at": ("created_at", "create_time", "createTime"),
    "desc_raw": ("desc", "description", "desc_raw"),
    "challenges_raw": ("challenges", "hashtags", "challenges_raw"),
}
# Optional columns that are carried along for entity extraction.
STRUCTURED_COLUMNS = ("music_title", "poi_name")


def scan(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read any Spark-readable table of posts. Later projections prune the scan's columns."""
    return spark.read.format(fmt).load(path)


def _first_present(posts: DataFrame, names: Sequence[str]) -> str | None:
    return next((name for name in names if name in posts.columns), None)


def _source(posts: DataFrame, canonical: str) -> tuple[Column, T.DataType]:
    name = _first_present(posts, COLUMN_ALIASES[canonical])
    if name is None:
        return F.lit(None).cast("string"), T.StringType()
    return posts[name], posts.schema[name].dataType


def normalize_columns(posts: DataFrame) -> DataFrame:
    """Project the five canonical columns, plus the structured ones if present.

    The first accepted name wins and a missing column becomes all null. ``author_id`` is "unknown" where
    null: that covers a table without any author as well, so no pass over the data is needed for it.
    """
    columns = {}
    for canonical in COLUMN_ALIASES:
        value, _ = _source(posts, canonical)
        if canonical == "video_id":
            value = value.cast("string")
        elif canonical == "author_id":
            value = F.coalesce(value.cast("string"), F.lit("unknown"))
        columns[canonical] = value
    extra = [posts[name] for name in STRUCTURED_COLUMNS if name in posts.columns]
    return posts.select(*[value.alias(name) for name, value in columns.items()], *extra)


def ingest(posts: DataFrame) -> DataFrame:
    """Canonical columns with typed values and the parsed tag list; rows without an id are left out.

    ``ingest_checks`` counts the rows left out.
    """
    canonical = normalize_columns(posts)
    types = {field.name: field.dataType for field in canonical.schema}
    challenges = F.col("challenges_raw")
    if not isinstance(types["challenges_raw"], T.StringType):
        challenges = F.to_json(challenges) if _is_nested(types["challenges_raw"]) else challenges.cast("string")
    return canonical.filter(F.col("video_id").isNotNull()).select(
        "video_id",
        "author_id",
        epoch_seconds(F.col("created_at"), types["created_at"]).alias("created_at"),
        F.coalesce(F.col("desc_raw").cast("string"), F.lit("")).alias("desc_raw"),
        challenges.alias("challenges_raw"),
        parse_challenges(F.col("challenges_raw"), types["challenges_raw"]).alias("hashtags_list_raw"),
        *[name for name in STRUCTURED_COLUMNS if name in canonical.columns],
    )


def _is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ArrayType, T.StructType, T.MapType))


def ingest_checks(posts: DataFrame) -> DataFrame:
    """One row about the raw table: size, rows without id, and whether every author is missing."""
    video_id, _ = _source(posts, "video_id")
    author_id, _ = _source(posts, "author_id")
    return posts.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(video_id.isNull()).alias("rows_without_id"),
        F.count_if(author_id.isNull()).alias("rows_without_author"),
        (F.count(author_id) == 0).alias("all_authors_missing"),
    )


def duplicate_ids(rows: DataFrame, key: str = "video_id") -> DataFrame:
    """Ids that occur more than once, with their counts. Partial counts keep a hot id cheap."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_unique(rows: DataFrame, key: str = "video_id") -> DataFrame:
    """Fail with the number of repeated ids, or return ``rows`` unchanged. Runs one job."""
    repeated = duplicate_ids(rows, key).count()
    if repeated:
        raise ValueError(f"{repeated} values of {key} occur more than once")
    return rows


def keep_one(rows: DataFrame, order: Sequence[Column], key: str = "video_id") -> DataFrame:
    """One row per id: the first by ``order``. The rank limit prunes each map task before the shuffle."""
    window = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).filter("_rank <= 1").drop("_rank")
