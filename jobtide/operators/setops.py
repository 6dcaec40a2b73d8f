"""Unions by column name, so a different column order cannot go unnoticed."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.schemas import UNIFIED_COLUMNS


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_postings(*frames: DataFrame) -> DataFrame:
    """All rows of the providers' unified frames, in the order of the contract."""
    return union_all(*[f.select(*UNIFIED_COLUMNS) for f in frames])


def union_counts(**frames: DataFrame) -> DataFrame:
    """Count frames of several providers, tagged with the provider they come from."""
    return union_all(*[f.withColumn("job_board", F.lit(p)) for p, f in frames.items()])
