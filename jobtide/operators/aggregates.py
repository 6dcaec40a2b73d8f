"""Grouped counts, distinct counts and lifespans; all combine before the shuffle."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lifespan(df: DataFrame, key: str, day: str) -> DataFrame:
    """First and last day per key."""
    return df.groupBy(key).agg(
        F.min(day).alias("earliest_opening_date"), F.max(day).alias("latest_opening_date")
    )


def count_by(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count_by(df: DataFrame, keys: list[str], col: str, name: str) -> DataFrame:
    """Distinct non-NULL values per key; Spark shuffles on key and value, so hot keys spread."""
    return df.groupBy(*keys).agg(F.count_distinct(col).alias(name))


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()
