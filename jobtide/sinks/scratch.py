"""Tables written between two steps of a job, in the shared folder the cluster names."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from jobtide import files


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``.

    There is no other: what all executors can reach is for the cluster to say.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return named


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written once and read back; what reads it no longer depends on its lineage."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """Tables between the steps of one job, removed together when what needs them is written.

    ``with Steps(spark) as steps`` gives ``steps.stored``; at the end of the block all its tables go
    but those that ``steps.keep`` was called with, in whose hands they then are. What is kept was
    written in full, so it depends on none of the others.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> "Steps":
        return self

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{shared_folder(self.spark)}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((path, found))
        return found

    def keep(self, *frames: DataFrame) -> None:
        self.paths = [(path, found) for path, found in self.paths if not any(found is each for each in frames)]

    def __exit__(self, *_) -> None:
        for path, _ in self.paths:
            files.delete(self.spark, path)
