"""Tables that a job writes once and reads again, in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> str:
    """For sessions in one process only; it goes when the process ends."""
    folder = tempfile.mkdtemp(prefix="llm-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application under ``spark.checkpoint.dir``, which executors and driver must share.

    Where that is unset, a session in one process gets a folder of its own and a cluster is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = _own_folder()
    return f"{named.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Spark's setting for shuffle files to go when the query that wrote them has ended, not at some garbage collection of the driver.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Writes a table and reads it back: later steps neither repeat its work nor lose it with an executor.

    ``release`` gives back the shuffle files of the write at its end.  It is for tables that don't go back to cached ones.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    before = spark.conf.get(RELEASE, "false")
    if release:
        spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Removes what this application kept.  Results that were not written elsewhere by then can't be read any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
