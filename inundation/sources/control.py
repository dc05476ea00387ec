"""Small tables that steer a run (events, spans, scene choices, thresholds): computed once and kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir`` or set on the context; the caller provides one that all executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    return named


def settle(df: DataFrame) -> DataFrame:
    """Compute a table now and cut its lineage with a reliable checkpoint.

    For tables that are read by many later steps: without this, every use would repeat the plan, and the plans multiply.  The
    result survives the loss of executors.  Its files go with the last reference to it where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def is_there(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return bool(fs.exists(at))


def is_written(spark: SparkSession, path: str) -> bool:
    """Was a table written there to its end?"""
    return is_there(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)
