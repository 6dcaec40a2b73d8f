"""The checks every dataset has to pass, and a run of them.

The lists below are fixed values: which columns a dataset has, which of them must be filled, unique
or drawn from accepted values, which one tells its age, and which failures only warn.

A run reads a table once for its columns, NULLs, accepted values and age together, and once more for
each unique key. Checks across datasets run in the same job (``run_marts``).
"""

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.fixed_values import ACCEPTED
from jobtide.functions import epoch_to_utc
from jobtide.operators.setops import union_all
from jobtide.quality import checks
from jobtide.schemas import LOADED_AT, MART_COLUMNS, RAW


@dataclass(frozen=True)
class Declared:
    columns: list[str]
    filled: list[str] = field(default_factory=list)
    filled_warn: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    unique_where: dict[str, str] = field(default_factory=dict)
    accepted: dict[str, list[str]] = field(default_factory=dict)
    accepted_warn: dict[str, list[str]] = field(default_factory=dict)
    loaded_at: str | None = None


_HTML = ["id", "record_id", "created_at", "updated_at", "source"]
_JSON = ["id", "record_id", "created_at", "updated_at", "board_source", "company_name"]
_STAGED = """id record_id created_at_utc updated_at_utc created_date_utc updated_date_utc source
    uses_existing raw_file run_id job_board""".split()
_MART_ACCEPTED = {c: ACCEPTED[c] for c in ("posting_length_category", "opening_category")}

RAW_CHECKS = {
    "greenhouse_departments": Declared(
        RAW["greenhouse_departments"].names,
        loaded_at=LOADED_AT["greenhouse_departments"],
        filled=[*_HTML, "company_name"],
        unique=["id"],
        accepted_warn={"department_category": ACCEPTED["department_category"]},
    ),
    "greenhouse_openings": Declared(
        RAW["greenhouse_openings"].names,
        loaded_at=LOADED_AT["greenhouse_openings"],
        filled=[*_HTML, "opening_link", "opening_title"],
        filled_warn=["location"],
        unique=["id"],
    ),
    "lever_openings": Declared(
        RAW["lever_openings"].names,
        loaded_at=LOADED_AT["lever_openings"],
        filled=[*_HTML, "department_names", "opening_link", "opening_title"],
        filled_warn=["location"],
        unique=["id"],
        accepted={"workplace_type": ACCEPTED["workplace_type"]},
    ),
    **{
        name: Declared(
            RAW[name].names, loaded_at=LOADED_AT[name], filled=_JSON, unique=["id"]
        )
        for name in ("ashby_departments", "ashby_locations")
    },
    "ashby_openings": Declared(
        RAW["ashby_openings"].names,
        loaded_at=LOADED_AT["ashby_openings"],
        filled=[*_JSON, "opening_id", "opening_name", "location_id", "location_name"],
        unique=["id"],
        accepted={"employment_type": ACCEPTED["employment_type"]},
    ),
    "rippling_openings": Declared(
        RAW["rippling_openings"].names,
        loaded_at=LOADED_AT["rippling_openings"],
        filled=RAW["rippling_openings"].names,
        unique=["id"],
    ),
    "boards": Declared(RAW["boards"].names, filled=["id", "url"], unique=["id", "url"]),
}

STAGED_CHECKS = {
    "greenhouse_departments": Declared(
        [*_STAGED, "company_name", "department_category", "department_id", "department_name"],
        accepted={"job_board": ["greenhouse"]},
    ),
    "greenhouse": Declared(
        [
            *_STAGED,
            *"company_name department_ids location office_ids full_opening_link opening_title".split(),
        ],
        accepted={"job_board": ["greenhouse"]},
    ),
    "lever": Declared(
        [
            *_STAGED,
            *"company_name department_names location workplace_type full_opening_link".split(),
            "opening_title",
        ],
        accepted={"job_board": ["lever"]},
    ),
}


def _mart(boards: list[str], **more) -> Declared:
    accepted = {**_MART_ACCEPTED, "job_board": boards}
    return Declared(MART_COLUMNS, filled=["id", "record_id"], accepted=accepted, **more)


MART_CHECKS = {
    "all_postings": _mart(
        ACCEPTED["job_board"], unique=["id"], unique_where={"record_id": "job_board != 'rippling'"}
    ),
    "active_postings": _mart(ACCEPTED["job_board"], unique=["id", "record_id"]),
    "active_selected": _mart(ACCEPTED["selected_job_board"], unique=["id", "record_id"]),
    "active_prospect": _mart(ACCEPTED["job_board"], unique=["id", "record_id"]),
}


def _row_checks(df: DataFrame, declared: Declared, now: datetime | None) -> DataFrame:
    """All checks that need no grouping, from one pass over the rows."""
    found = []

    def add(check, column, failures, verdict):
        found.append((check, column, failures, verdict))

    off = len(set(declared.columns) ^ set(df.columns))
    add("columns match", "", F.lit(off).cast("bigint"), "error")
    for severity, columns in (("error", declared.filled), ("warn", declared.filled_warn)):
        for column in columns:
            add("not null", column, F.count_if(F.col(column).isNull()), severity)
    for severity, lists in (("error", declared.accepted), ("warn", declared.accepted_warn)):
        for column, values in lists.items():
            other = F.when(~F.col(column).isin(values), F.col(column))
            add("accepted values", column, F.count_distinct(other), severity)
    age = []
    if now is not None and declared.loaded_at:
        column = F.col(declared.loaded_at)
        is_epoch = dict(df.dtypes)[declared.loaded_at] == "bigint"
        newest = F.max(column)
        age = [(epoch_to_utc(newest) if is_epoch else newest).alias("newest")]
    counted = df.agg(*[c.alias(f"c{i}") for i, (_, _, c, _) in enumerate(found)], *age)
    listed = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"),
            F.col(f"c{i}").alias("failures"),
            F.when(F.col(f"c{i}") > 0, severity).otherwise("pass").alias("verdict"),
        )
        for i, (check, column, _, severity) in enumerate(found)
    ]
    if age:
        verdict = checks.age_verdict(checks.age_seconds(F.col("newest"), now))
        stale = F.when(verdict == "pass", 0).otherwise(1).cast("bigint")
        listed.append(
            F.struct(
                F.lit("freshness").alias("check_name"),
                F.lit(declared.loaded_at).alias("column_name"),
                stale.alias("failures"),
                verdict.alias("verdict"),
            )
        )
    return counted.select(F.inline(F.array(*listed)))


def run_declared(
    name: str, df: DataFrame, declared: Declared, now: datetime | None = None
) -> DataFrame:
    """A row per declared check of the dataset with its number of failures and its verdict.

    Freshness is judged at ``now``, in UTC, where given. Store a dataset that is costly to work out
    before it is checked: it is read once, and again for each unique key.
    """
    results = [_row_checks(df, declared, now)]
    wheres = {**dict.fromkeys(declared.unique), **declared.unique_where}
    for column, where in wheres.items():
        found = checks.verdict(checks.unique(df, column, where))
        named = found.select(F.lit("unique").alias("check_name"), F.lit(column).alias("column_name"), "*")
        results.append(named)
    return union_all(*results).select(F.lit(name).alias("dataset"), "*")


def run_all(
    frames: dict[str, DataFrame], declared: dict[str, Declared], now: datetime | None = None
) -> DataFrame:
    """The declared checks of several datasets."""
    return union_all(*[run_declared(name, frames[name], d, now) for name, d in declared.items()])


def run_across(raw: dict[str, DataFrame], mart: DataFrame, active: DataFrame) -> DataFrame:
    """The checks across datasets, each with its thresholds: boards without active postings or
    unknown boards, links that vanished and came back, postings whose days open differ from their
    link's, and runs whose active postings are not as many as the raw links."""
    limits = {"warn_at": V.RECONCILE_WARN_AT, "error_at": V.RECONCILE_ERROR_AT}
    judged = {
        ("boards", "boards reconciled"): checks.verdict(
            checks.reconcile(raw["boards"], active), **limits
        ),
        ("all_postings", "no returning postings"): checks.verdict(checks.returning(mart), "warn"),
        ("all_postings", "days open agree"): checks.verdict(checks.returning_by_days(mart)),
        ("active_postings", "active count match"): checks.verdict(
            checks.active_count_match(active, raw), "warn"
        ),
    }
    named = [
        found.select(
            F.lit(dataset).alias("dataset"),
            F.lit(check).alias("check_name"),
            F.lit("").alias("column_name"),
            "*",
        )
        for (dataset, check), found in judged.items()
    ]
    return union_all(*named)


def run_marts(
    raw: dict[str, DataFrame], marts: dict[str, DataFrame], now: datetime | None = None
) -> DataFrame:
    """One job for a day's build: raw tables, marts and the checks across them."""
    return union_all(
        run_all(raw, RAW_CHECKS, now),
        run_all(marts, MART_CHECKS, now),
        run_across(raw, marts["all_postings"], marts["active_postings"]),
    )
