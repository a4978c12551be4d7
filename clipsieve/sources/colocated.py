"""Stages dealt out by id once, so that joins on the id read them where they lie."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def default_buckets(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which sizes other shuffles of these rows too."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _qualified(spark: SparkSession, path: str) -> str:
    """With scheme and folder: the catalog would look for a relative path in the warehouse."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(place).toString()


def write_colocated(
    rows: DataFrame, path: str, key: str = "video_id", buckets: int | None = None, dealt: bool = False
) -> DataFrame:
    """Write ``rows`` as Parquet in buckets of ``key``, sorted in each, and return them as read back.

    Frames written with the same key and number of buckets (by default ``default_buckets``) join, group and
    compare on the key without an exchange. ``dealt`` says that the rows come from such a frame without having
    been moved since; others are shuffled here, once. The files are plain Parquet for any other reader; the
    catalog entry is only needed while reading is planned and is dropped again, which leaves the files.
    Rows with a null key are one bucket. What lies at ``path`` is replaced.
    """
    spark = rows.sparkSession
    n = buckets or default_buckets(spark)
    name = f"colocated_{uuid.uuid4().hex}"
    if not dealt:
        rows = rows.repartition(n, key)
    writer = rows.write.mode("overwrite").format("parquet").bucketBy(n, key).sortBy(key)
    writer.option("path", _qualified(spark, path)).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
