"""Folders and small files in whatever store the tables lie in, through Spark's own file systems.

Only names and records of a few lines pass here; rows are read and written by Spark's sources.
"""

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder but for hidden ones (a leading dot); none where there is no folder."""
    files, place = _open(spark, folder)
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(name for name in names if not name.startswith("."))


def create(spark: SparkSession, path: str, text: str = "") -> bool:
    """Write a new file; False, and nothing is written, where there is one already."""
    files, place = _open(spark, path)
    try:
        out = files.create(place, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is no file."""
    files, place = _open(spark, path)
    if not files.exists(place):
        return None
    source = files.open(place)
    text = bytes(source.readAllBytes()).decode()
    source.close()
    return text


def rename(spark: SparkSession, old: str, new: str) -> None:
    files, place = _open(spark, old)
    if not files.rename(place, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{old} cannot be renamed to {new}")


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or a whole folder; False where there is none."""
    files, place = _open(spark, path)
    return files.delete(place, True)
