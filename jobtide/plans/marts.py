"""Marts: all postings with their derived columns, and the active subsets."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.functions import categorise, days_active, is_active, length_bucket, searchable
from jobtide.operators.joins import on_boards, with_lifespan
from jobtide.operators.setops import union_postings
from jobtide.plans import staging, unify
from jobtide.schemas import MART_COLUMNS


# Staged table: the raw table it is made from and the step that makes it.
STAGED = {
    "greenhouse_departments": ("greenhouse_departments", staging.stage_greenhouse_departments),
    "greenhouse": ("greenhouse_openings", staging.stage_greenhouse),
    "lever": ("lever_openings", staging.stage_lever),
    "ashby": ("ashby_openings", staging.stage_ashby),
    "ashby_departments": ("ashby_departments", staging.stage_ashby_departments),
    "ashby_locations": ("ashby_locations", staging.stage_ashby_locations),
    "rippling": ("rippling_openings", staging.stage_rippling),
}

# Provider: the staged tables its unified postings are made from and the step that makes them.
UNIFIED = {
    "greenhouse": (("greenhouse", "greenhouse_departments"), unify.unify_greenhouse),
    "lever": (("lever",), unify.unify_lever),
    "ashby": (("ashby", "ashby_locations", "ashby_departments"), unify.unify_ashby),
    "rippling": (("rippling",), unify.conform),
}


def staged_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stage(raw[source]) for name, (source, stage) in STAGED.items()}


def unified_tables(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        name: unify_provider(*[staged[source] for source in sources])
        for name, (sources, unify_provider) in UNIFIED.items()
    }


def all_postings(unified: DataFrame, as_of: date | None = None) -> DataFrame:
    """All unified postings with lifespan, activity, length bucket and category.

    ``unified`` is read twice (see ``with_lifespan``), so it should be a stored table.
    """
    spanned = with_lifespan(unified, "full_opening_link", "created_date_utc")
    lasting = spanned.withColumns(
        {
            "is_active": is_active(F.col("created_date_utc"), as_of),
            "days_active": days_active(
                F.col("earliest_opening_date"), F.col("latest_opening_date")
            ),
            "_text": searchable(
                [F.col("primary_department"), F.col("secondary_department")],
                F.col("opening_title"),
            ),
        }
    )
    return lasting.withColumns(
        {
            "posting_length_category": length_bucket(F.col("is_active"), F.col("days_active")),
            "opening_category": categorise(F.col("_text")),
        }
    ).select(*MART_COLUMNS)


def union_unified(unified: dict[str, DataFrame]) -> DataFrame:
    return union_postings(*unified.values())


def active_postings(mart: DataFrame) -> DataFrame:
    return mart.where("is_active")


def active_for(mart: DataFrame, boards: DataFrame, wanted: Column) -> DataFrame:
    return on_boards(active_postings(mart), boards, wanted)


def active_selected(mart: DataFrame, boards: DataFrame) -> DataFrame:
    """Active postings of the selected boards, those with a low dimension id."""
    return active_for(mart, boards, F.col("id") <= V.SELECTED_BOARD_MAX_ID)


def active_prospect(mart: DataFrame, boards: DataFrame) -> DataFrame:
    """Active postings of boards marked as prospects."""
    return active_for(mart, boards, F.col("is_prospect"))
