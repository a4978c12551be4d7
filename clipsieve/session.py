"""Session options the stages rely on and shared-storage materialisation."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SESSION_OPTIONS = {
    # Dates are derived in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


_PACKAGE = Path(__file__).resolve().parent
_shipped_to: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped_to:
        return
    folder = tempfile.mkdtemp(prefix="clipsieve-")
    archive = shutil.make_archive(
        f"{folder}/clipsieve-package", "zip", root_dir=_PACKAGE.parent, base_dir=_PACKAGE.name
    )
    context.addPyFile(archive)
    _shipped_to.add(context.applicationId)


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the runtime options that the results depend on and make the package known to the workers;
    call before building any stage. The options stay set: the session's time zone is UTC from then on."""
    _ship_package(spark)
    for key, value in _SESSION_OPTIONS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which all executors must share."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir, when the session is built, to a folder that all executors share")
    return configured


def stage_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/stages-{spark.sparkContext.applicationId}"


def clear_stages(spark: SparkSession) -> None:
    """Remove what ``materialize`` wrote in this application. Call when no result is still to be read."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(stage_root(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used before steps that pass over the same rows many times: the lineage is cut, an executor that
    is lost costs only a re-read, and each pass prunes to the columns that it needs. The files also tell
    the planner their size, by which it decides on broadcasts.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deal_out(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out, by ``keys`` if there are any, to as many tasks as the session shuffles into, at least one for each core.

    For texts whose work is large beside their bytes: left to the planner, which goes by bytes, they would end in a
    few tasks.
    """
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, *keys)
