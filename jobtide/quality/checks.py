"""Checks return their failing rows; ``verdict`` turns a number of those into pass, warn or error."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.functions import days_active, normalise_url, utc_literal
from jobtide.operators.aggregates import count_by, distinct_count_by
from jobtide.operators.dedupe import first_daily
from jobtide.operators.joins import count_mismatch, unmatched_both, value_mismatch
from jobtide.operators.setops import union_all, union_counts

_DAY_SECONDS = 86400


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of NULLs in each of the columns, a row per column from one pass over the rows."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failures")


def unique(df: DataFrame, col: str, where: str | Column | None = None) -> DataFrame:
    """Values that occur more than once, optionally among some rows only; NULL is ignored."""
    rows = df if where is None else df.where(where)
    return count_by(rows.where(F.col(col).isNotNull()), [col], "occurrences").where(
        "occurrences > 1"
    )


def accepted(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Values outside the accepted ones with their number of rows; NULL passes."""
    return count_by(df.where(~F.col(col).isin(values)), [col], "occurrences")


def columns_match(df: DataFrame, expected: list[str]) -> DataFrame:
    """One row: how many rows there are, which columns are missing and which unexpected."""
    missing = ",".join(sorted(set(expected) - set(df.columns)))
    unexpected = ",".join(sorted(set(df.columns) - set(expected)))
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(missing).alias("missing"), F.lit(unexpected).alias("unexpected")
    )


def age_seconds(newest: Column, as_of: datetime) -> Column:
    """Seconds from the newest row, in UTC, to ``as_of``, in UTC unless it has a zone."""
    return F.timestamp_diff("SECOND", newest, utc_literal(as_of))


def age_verdict(
    seconds: Column, warn_days: int = V.FRESH_WARN_DAYS, error_days: int = V.FRESH_ERROR_DAYS
) -> Column:
    """What an age means; of an empty table, which has none, it is an error."""
    return (
        F.when(seconds.isNull() | (seconds > error_days * _DAY_SECONDS), "error")
        .when(seconds > warn_days * _DAY_SECONDS, "warn")
        .otherwise("pass")
    )


def freshness(
    df: DataFrame,
    loaded_at: Column,
    as_of: datetime,
    warn_days: int = V.FRESH_WARN_DAYS,
    error_days: int = V.FRESH_ERROR_DAYS,
) -> DataFrame:
    """Age of the newest row in seconds, and its verdict."""
    newest = df.agg(F.max(loaded_at).alias("latest"))
    age = newest.withColumn("age_seconds", age_seconds(F.col("latest"), as_of))
    return age.withColumn("verdict", age_verdict(F.col("age_seconds"), warn_days, error_days))


def reconcile(
    boards: DataFrame, active: DataFrame, exclude: list[str] | None = None
) -> DataFrame:
    """Enabled boards without active postings, and sources that are no enabled board."""
    expected = boards.where("is_enabled").select(
        normalise_url(F.col("url")).alias("expected_source")
    )
    if exclude:
        expected = expected.where(~F.col("expected_source").isin(exclude))
    actual = active.select(normalise_url(F.col("source")).alias("actual_source"))
    return unmatched_both(
        expected.distinct(), actual.distinct(), "expected_source", "actual_source"
    )


def returning_by_days(mart: DataFrame) -> DataFrame:
    """Active postings whose days open differ from those of their link.

    Days open are worked out per link, so this can only fail if the mart is inconsistent.
    """
    expected = mart.select(
        "full_opening_link", F.col("days_active").alias("expected_days_active")
    ).distinct()
    daily = first_daily(mart, "full_opening_link", "created_date_utc", "id").where("is_active")
    return value_mismatch(
        daily, expected, "full_opening_link", "days_active", "expected_days_active"
    )


def returning(mart: DataFrame) -> DataFrame:
    """Links seen on fewer days than they were open: they vanished and came back."""
    day = "created_date_utc"
    links = mart.groupBy("full_opening_link").agg(
        F.count_distinct(day).alias("days_seen"),
        days_active(F.min(day), F.max(day)).alias("days_active"),
    )
    return links.where("days_seen < days_active")


def raw_link_counts(raw: dict[str, DataFrame]) -> DataFrame:
    """Distinct raw links per run and source of the boards that are counted."""
    ashby = raw["ashby_openings"].withColumnRenamed("board_source", "source")
    counted = {
        "greenhouse": raw["greenhouse_openings"],
        "lever": raw["lever_openings"],
        "ashby": ashby,
    }
    return union_counts(
        **{
            provider: distinct_count_by(
                df, ["run_id", "source"], "opening_link", "num_source_openings"
            )
            for provider, df in counted.items()
        }
    )


def active_count_match(active: DataFrame, raw: dict[str, DataFrame]) -> DataFrame:
    """Runs of a board whose active postings and distinct raw links differ in number."""
    shown = count_by(active, ["run_id", "source", "job_board"], "num_openings")
    links = raw_link_counts(raw).withColumnRenamed("job_board", "raw_job_board")
    return count_mismatch(
        shown, links, ["run_id", "source"], "num_openings", "num_source_openings"
    )


def verdict(
    failures: DataFrame, severity: str = "error", warn_at: int = 1, error_at: int = 1
) -> DataFrame:
    """Number of failing rows and what it means; with severity ``warn`` it is never an error."""
    counted = failures.agg(F.count(F.lit(1)).alias("failures"))
    return counted.withColumn("verdict", status(severity, warn_at, error_at))


def status(severity: str, warn_at: int = 1, error_at: int = 1, number: Column | None = None) -> Column:
    """What a number of failures means, that in a column ``failures`` unless given."""
    number = F.col("failures") if number is None else number
    label = F.when(number >= warn_at, "warn").otherwise("pass")
    return F.when(number >= error_at, "error").otherwise(label) if severity == "error" else label


@dataclass(frozen=True)
class Fold:
    """A check that one aggregate over a table's rows answers, so that many share a pass.

    ``failures`` is that aggregate: how many fail. With severity ``warn`` they are never an error.
    """

    failures: Column
    severity: str = "error"
    warn_at: int = 1
    error_at: int = 1


def fold_not_null(col: str, **limits) -> Fold:
    """The rows in which a column is NULL."""
    return Fold(F.count_if(F.col(col).isNull()), **limits)


def fold_accepted(col: str, values: list[str], **limits) -> Fold:
    """The values outside the accepted ones; NULL passes."""
    return Fold(F.count_distinct(F.when(~F.col(col).isin(values), F.col(col))), **limits)


def fold_where(wrong: Column, **limits) -> Fold:
    """The rows for which a condition holds."""
    return Fold(F.count_if(wrong), **limits)


def judged(df: DataFrame, folds: dict[str, Fold]) -> DataFrame:
    """A verdict row for each of the checks under its name, from one pass over the rows."""
    counted = df.agg(*[fold.failures.alias(f"c{i}") for i, fold in enumerate(folds.values())])
    listed = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.col(f"c{i}").alias("failures"),
            status(fold.severity, fold.warn_at, fold.error_at, F.col(f"c{i}")).alias("verdict"),
        )
        for i, (name, fold) in enumerate(folds.items())
    ]
    return counted.select(F.inline(F.array(*listed)))


def verdicts(checks: dict[str, DataFrame]) -> DataFrame:
    """Verdict rows of several checks under their names."""
    named = [v.select(F.lit(name).alias("check_name"), "*") for name, v in checks.items()]
    return union_all(*named)
