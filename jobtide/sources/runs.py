"""Run metadata on extracted rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stamp_run(
    df: DataFrame,
    fetched_at: Column,
    run_id: Column,
    company: Column,
    source: Column,
    source_name: str = "source",
    created_at: Column | None = None,
    raw_file: Column | None = None,
    existing_used: Column | None = None,
) -> DataFrame:
    """Rows with when, by which run and from where they were fetched.

    Rows of a stored file also say where it lies, whether an earlier fetch made it, and that one's
    time as ``created_at``; for others there is no file and both times are that of the fetch.
    """
    return df.withColumns(
        {
            "created_at": fetched_at if created_at is None else created_at,
            "updated_at": fetched_at,
            "company_name": company,
            source_name: source,
            "run_id": run_id,
            "raw_file": F.lit(None).cast("string") if raw_file is None else raw_file,
            "existing_used": F.lit(False) if existing_used is None else existing_used,
        }
    )
