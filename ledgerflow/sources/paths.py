"""Whether a path is there, and removing one's own; on any file system that Spark reads."""

from pyspark.sql import SparkSession


def _found(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _found(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """The folder and all in it; nothing where there is none."""
    files, target = _found(spark, path)
    files.delete(target, True)
