"""The daily job that keeps the raw tables small: export what is old, then drop what is exported."""

from datetime import date, datetime

from pyspark.sql import SparkSession

from jobtide.fixed_values import RETENTION_DAYS
from jobtide.functions import utc_time
from jobtide.plans import side_by_side
from jobtide.schemas import LOADED_AT
from jobtide.sinks.storage import archive, cutoff_day, drop_days


def retain(
    spark: SparkSession, base: str, to: str, as_of: datetime, days: int = RETENTION_DAYS, fmt: str = "parquet"
) -> dict[str, tuple[list[date], list[date]]]:
    """Keep the load days of the last ``days`` days in the raw tables under ``base``; older ones go to the archive.

    Of each table, the days exported and the days dropped. A table is dropped from only after its
    export is on record, and only what the records hold, so the job may be repeated or fail anywhere.
    """
    before = cutoff_day(utc_time(as_of).date(), days)

    def job(name: str):
        exported = archive(spark, base, name, before, to, utc_time(as_of).date(), fmt)
        return exported, drop_days(spark, base, name, before, to)

    return side_by_side({name: lambda name=name: job(name) for name in LOADED_AT})
