from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from jobtide.plans import marts
from jobtide.quality import checks
from jobtide.schemas import UNIFIED


@pytest.fixture
def mart(spark):
    def make(*seen):
        partial = [
            {"id": f"lever_{n}", "full_opening_link": link, "created_date_utc": day, "source": source, "run_id": str(day), "job_board": "lever"}
            for n, (link, day, source) in enumerate(seen)
        ]
        df = spark.createDataFrame([tuple(p.get(f.name) for f in UNIFIED) for p in partial], UNIFIED)
        return marts.all_postings(df, date(2024, 1, 5))

    return make


def test_column_checks(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("z", 5)], "v string, n long")
    assert rows(checks.not_null(df, "v"), "n") == [(3,), (4,)]
    assert rows(checks.unique(df, "v")) == [("a", 2)]
    assert rows(checks.unique(df, "v", "n > 1")) == []
    assert rows(checks.accepted(df, "v", ["a"])) == [("z", 1)]
    assert rows(checks.columns_match(df, ["v", "n"])) == [(5, "", "")]
    assert rows(checks.columns_match(df, ["v", "m"])) == [(5, "m", "n")]


@pytest.mark.parametrize(
    "hours, status", [(0, "pass"), (24, "pass"), (24.01, "warn"), (48, "warn"), (48.01, "error")]
)
def test_freshness(spark, hours, status):
    newest = datetime(2024, 1, 30) - timedelta(hours=hours)
    df = spark.createDataFrame([(newest,), (datetime(2023, 1, 1),)], "at timestamp_ntz")
    assert checks.freshness(df, F.col("at"), datetime(2024, 1, 30)).first().verdict == status


def test_freshness_of_nothing_is_an_error(spark):
    df = spark.createDataFrame([], "at timestamp_ntz")
    assert checks.freshness(df, F.col("at"), datetime(2024, 1, 30)).first().verdict == "error"


@pytest.mark.parametrize(
    "failures, severity, status",
    [(0, "error", "pass"), (1, "error", "warn"), (9, "error", "warn"), (10, "error", "error"), (10, "warn", "warn")],
)
def test_verdict_thresholds(spark, failures, severity, status):
    row = checks.verdict(spark.range(failures), severity, 1, 10).first()
    assert (row.failures, row.verdict) == (failures, status)


def test_reconcile(spark, raw, mart, rows):
    today = date(2024, 1, 5)
    boards = raw(
        "boards",
        {"url": "u/both/", "is_enabled": True},
        {"url": "u/quiet", "is_enabled": True},
        {"url": "u/off", "is_enabled": False},
    )
    active = mart(("x", today, "u/both"), ("y", today, "u/off"), ("z", today, "u/unknown"))
    assert rows(checks.reconcile(boards, active)) == [(None, "u/off"), (None, "u/unknown"), ("u/quiet", None)]
    assert rows(checks.reconcile(boards, active, ["u/quiet"])) == [(None, "u/off"), (None, "u/unknown")]


def test_returning(mart, rows):
    days = [date(2024, 1, d) for d in (1, 2, 5)]
    df = mart(*[("gone and back", d, "u") for d in days], *[("steady", d, "u") for d in days[:2]])
    assert rows(checks.returning(df)) == [("gone and back", 3, 5)]
    assert rows(checks.returning_by_days(df), "id") == []


def test_active_count_match(raw, mart, rows):
    today = date(2024, 1, 5)
    active = mart(("a", today, "s1"), ("b", today, "s1"), ("c", today, "s2"))
    sighting = {"run_id": str(today)}
    tables = {
        "lever_openings": raw(
            "lever_openings",
            *[{**sighting, "source": "s1", "opening_link": v} for v in ("a", "b", "b")],
            *[{**sighting, "source": "s2", "opening_link": v} for v in ("c", "d")],
        ),
        "greenhouse_openings": raw("greenhouse_openings"),
        "ashby_openings": raw("ashby_openings"),
    }
    got = checks.active_count_match(active, tables)
    assert rows(got, "source", "num_openings", "num_source_openings") == [("s2", 1, 2)]


def test_a_table_is_read_once_for_its_row_checks_and_once_per_unique_key(spark, raw, tmp_path):
    from jobtide.quality import declared

    path = str(tmp_path / "lever")
    raw("lever_openings", {"id": 1, "workplace_type": "Elsewhere", "updated_at": 1706572800}).write.parquet(path)
    stored = spark.read.parquet(path)
    found = declared.run_declared("lever_openings", stored, declared.RAW_CHECKS["lever_openings"], datetime(2024, 2, 1))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    verdicts = {(r.check_name, r.column_name): (r.failures, r.verdict) for r in found.collect()}
    assert verdicts["accepted values", "workplace_type"] == (1, "error")
    assert verdicts["freshness", "updated_at"] == (1, "warn") and verdicts["not null", "location"] == (1, "warn")
    assert verdicts["unique", "id"] == (0, "pass") and verdicts["columns match", ""] == (0, "pass")


def test_checks_share_one_pass(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), (None, None), ("c", 5)], "v string, n long")
    folds = {
        "v filled": checks.fold_not_null("v"),
        "n filled, warn": checks.fold_not_null("n", severity="warn"),
        "n filled, some may fail": checks.fold_not_null("n", warn_at=2, error_at=3),
        "v accepted": checks.fold_accepted("v", ["a"], error_at=3),
        "n small": checks.fold_where(F.col("n") > 9),
    }
    found = checks.judged(df, folds)
    assert rows(found) == [
        ("n filled, some may fail", 2, "warn"),
        ("n filled, warn", 2, "warn"),
        ("n small", 0, "pass"),
        ("v accepted", 2, "warn"),
        ("v filled", 1, "error"),
    ]
    # the same as each check on its own
    assert checks.verdict(checks.accepted(df, "v", ["a"]), error_at=3).first()["failures"] == 2
    assert {r["failures"] for r in checks.judged(df.where("false"), folds).collect()} == {0}


def test_verdicts_scan_the_mart_once_and_once_per_key(spark, tmp_path):
    spark.range(5).selectExpr("id", "cast(id as string) AS v", "id AS n").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    folds = {c: checks.fold_not_null(c) for c in ("id", "v", "n")} | {"v accepted": checks.fold_accepted("v", ["1"])}
    both = checks.judged(df, folds).union(checks.verdicts({"unique": checks.verdict(checks.unique(df, "id"))}))
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
