"""Staged tables: UTC times and days, one row per sighting worth keeping, one naming."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import DEPARTMENT_EPOCH
from jobtide.functions import (
    board_company,
    day_of,
    default_group,
    epoch_to_utc,
    full_link,
    is_remote,
    namespaced_id,
    provider_of,
)
from jobtide.operators.dedupe import first_seen, first_seen_per_day, first_seen_two_keys
from jobtide.schemas import UNIFIED_COLUMNS
from jobtide.sources.tables import since

_ORDER = ["updated_at", "id"]


def _timed(raw: DataFrame) -> DataFrame:
    created, updated = epoch_to_utc(F.col("created_at")), epoch_to_utc(F.col("updated_at"))
    return raw.withColumns(
        {
            "created_at_utc": created,
            "updated_at_utc": updated,
            "created_date_utc": day_of(created),
            "updated_date_utc": day_of(updated),
        }
    )


def _openings(raw: DataFrame) -> DataFrame:
    return first_seen_per_day(_timed(raw), "record_id", "opening_link", "updated_date_utc", _ORDER)


def _staged(df: DataFrame, job_board: Column, *columns, source: str = "source") -> DataFrame:
    return df.select(
        "id",
        "record_id",
        "created_at_utc",
        "updated_at_utc",
        "created_date_utc",
        "updated_date_utc",
        F.col(source).alias("source"),
        F.col("existing_used").cast("boolean").alias("uses_existing"),
        "raw_file",
        "run_id",
        *columns,
        job_board.alias("job_board"),
    )


def _with_public_id(staged: DataFrame) -> DataFrame:
    return staged.withColumn("id", namespaced_id(F.col("job_board"), F.col("id")))


def stage_greenhouse_departments(raw: DataFrame) -> DataFrame:
    """First per record id that is also first per department and run, after the fixed cutoff."""
    recent = _timed(since(raw, DEPARTMENT_EPOCH))
    kept = first_seen_two_keys(recent, ["record_id"], ["department_id", "run_id"], _ORDER)
    return _staged(
        kept,
        provider_of(F.col("source")),
        "company_name",
        "department_id",
        "department_category",
        "department_name",
    )


def stage_greenhouse(raw: DataFrame) -> DataFrame:
    """One opening per scraped link and day."""
    source = F.col("source")
    staged = _staged(
        _openings(raw),
        provider_of(source),
        board_company(source).alias("company_name"),
        default_group(F.col("department_ids")).alias("department_ids"),
        "location",
        "office_ids",
        full_link(source, F.col("opening_link")).alias("full_opening_link"),
        "opening_title",
    )
    return _with_public_id(staged)


def stage_lever(raw: DataFrame) -> DataFrame:
    """One opening per link and day."""
    staged = _staged(
        _openings(raw),
        provider_of(F.col("source")),
        "department_names",
        "location",
        "workplace_type",
        F.col("opening_link").alias("full_opening_link"),
        "opening_title",
        "company_name",
    )
    return _with_public_id(staged)


def stage_ashby(raw: DataFrame) -> DataFrame:
    """One opening per link and day."""
    staged = _staged(
        _openings(raw),
        F.lit("ashby"),
        "company_name",
        "opening_id",
        F.col("opening_name").alias("opening_title"),
        "department_id",
        "location_id",
        "location_name",
        "employment_type",
        "compensation_tier",
        F.col("opening_link").alias("full_opening_link"),
        source="board_source",
    )
    return _with_public_id(staged)


def _stage_ashby_parts(raw: DataFrame, *columns: str) -> DataFrame:
    kept = first_seen(_timed(raw), ["record_id"], _ORDER)
    return _staged(kept, F.lit("ashby"), "company_name", *columns, source="board_source")


def stage_ashby_departments(raw: DataFrame) -> DataFrame:
    return _stage_ashby_parts(raw, "department_id", "department_name", "parent_department_id")


def stage_ashby_locations(raw: DataFrame) -> DataFrame:
    return _stage_ashby_parts(
        raw, "opening_id", "secondary_location_id", "secondary_location_name"
    )


def stage_rippling(raw: DataFrame) -> DataFrame:
    """All raw rows, already in the unified shape; this board is not deduplicated."""
    seen_on = day_of(F.col("created_at"))
    missing = F.lit(None).cast("string")
    return raw.select(
        namespaced_id(F.lit("rippling"), F.col("id"), skip_null=False).alias("id"),
        F.col("job_id").alias("record_id"),
        seen_on.alias("created_date_utc"),
        seen_on.alias("updated_date_utc"),
        F.col("api_endpoint").alias("source"),
        F.col("board_token").alias("company_name"),
        F.lit(False).alias("uses_existing"),
        "location",
        F.col("url").alias("full_opening_link"),
        F.col("title").alias("opening_title"),
        is_remote(F.col("location")).alias("is_remote"),
        F.col("department").alias("primary_department"),
        missing.alias("secondary_department"),
        missing.alias("tertiary_department"),
        missing.alias("quaternary_department"),
        "run_id",
        F.lit("rippling").alias("job_board"),
    ).select(*UNIFIED_COLUMNS)
