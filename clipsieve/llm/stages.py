"""Stages written once to the shared folder of the session and read again."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from clipsieve.session import stage_root


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's context cleaner remove the shuffle files that no DataFrame refers to.

    The cleaner learns of a shuffle when its plan is collected; plans that Python held are collected in the
    second round.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def write_stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as zstd Parquet below ``spark.checkpoint.dir`` and return it as read from there.

    The lineage ends here, and a lost executor costs only a second read.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
