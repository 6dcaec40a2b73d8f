import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from jobtide.plans import build, marts, staging, unify
from jobtide.schemas import MART_COLUMNS, RAW, UNIFIED_COLUMNS
from jobtide.sources import event_boards

DAY = 86400
SF = "/root/testdata/sf0.001"
T0 = 1706572800  # 2024-01-30
CLASSIC = "https://boards.greenhouse.io/acme"
LEVER = "https://jobs.lever.co/acme"


def opening(n, link, at=T0, **more):
    base = {"id": n, "record_id": f"r{n}", "created_at": at, "updated_at": at, "run_id": "run"}
    return {**base, "source": LEVER, "opening_link": link, "existing_used": False, **more}


def test_staging_keeps_first_sighting_per_link_and_day(raw, rows):
    df = raw(
        "lever_openings",
        opening(1, "x", record_id="a", at=T0 + 30),
        opening(2, "x", record_id="a", at=T0 + 10),
        opening(3, "x", record_id="b", at=T0 + 20),
        opening(4, "x", record_id="c", at=T0 + DAY),
        opening(5, "y", record_id="d", at=T0 + 10),
        opening(6, "y", record_id="e", at=T0 + 10),
    )
    assert rows(staging.stage_lever(df), "id") == [("lever_2",), ("lever_4",), ("lever_5",)]


def test_staged_greenhouse_columns(raw, rows):
    embed = "https://boards.greenhouse.io/embed/job_board?for=emb"
    df = raw(
        "greenhouse_openings",
        opening(1, "/acme/jobs/9", source=CLASSIC, department_ids=None, existing_used=True),
        opening(2, "https://x/9", source=embed, department_ids="1"),
    )
    staged = staging.stage_greenhouse(df)
    assert rows(staged, "id", "full_opening_link", "company_name", "department_ids", "uses_existing") == [
        ("greenhouse_1", CLASSIC + "/jobs/9", "acme", "No Dept", True),
        ("greenhouse_2", "https://x/9", "emb", "1", False),
    ]
    assert rows(staged, "created_date_utc") == [(date(2024, 1, 30),)] * 2


def department(n, dep, name, level=0, at=T0, **more):
    base = {"id": n, "record_id": f"d{n}", "created_at": at, "updated_at": at, "run_id": "run"}
    return {
        **base,
        "source": CLASSIC,
        "department_id": dep,
        "department_name": name,
        "department_category": f"level-{level}",
        **more,
    }


def test_staged_departments_need_both_firsts_and_the_cutoff(raw, rows):
    df = raw(
        "greenhouse_departments",
        department(1, "1", "late", at=T0 + 5),
        department(2, "1", "early", at=T0),
        department(3, "2", "ancient", at=1684600000),
        department(4, "2", "recent", at=1684600001),
        department(5, "3", "loses its record", at=T0 + 9, record_id="d2"),
        department(6, "3", "loses its department", at=T0 + 10),
    )
    staged = staging.stage_greenhouse_departments(df)
    assert rows(staged, "id", "department_name") == [(2, "early"), (4, "recent")]
    assert staged.first().job_board == "greenhouse"


def test_unify_greenhouse(raw, rows):
    staged = staging.stage_greenhouse(
        raw(
            "greenhouse_openings",
            opening(1, "/a/jobs/1", source=CLASSIC, department_ids="10,11,12,13", location="REMOTE"),
            opening(2, "/a/jobs/2", source=CLASSIC, department_ids=None, location="Rome"),
            opening(3, "/a/jobs/3", source=CLASSIC, department_ids=""),
            opening(4, "/a/jobs/4", source=CLASSIC, department_ids="99"),
            opening(5, "/a/jobs/5", source=CLASSIC, department_ids="10,20,14"),
            opening(6, "/a/jobs/6", source=CLASSIC, department_ids="10", run_id="other run"),
        )
    )
    departments = staging.stage_greenhouse_departments(
        raw(
            "greenhouse_departments",
            department(1, "10", "Eng", 0),
            department(2, "11", "Backend", 1),
            department(3, "12", "Infra", 2),
            department(4, "13", "Deep", 3),
            department(5, "14", "Deeper", 4),
            department(6, "20", "Zoo", 0),
        )
    )
    got = unify.unify_greenhouse(staged, departments)
    assert got.columns == UNIFIED_COLUMNS
    names = [c for c in UNIFIED_COLUMNS if c.endswith("_department")]
    assert rows(got, "id", *names, "is_remote") == [
        ("greenhouse_1", "Eng", "Backend", "Infra", "Deep", True),
        ("greenhouse_2", "No Department", None, None, None, False),
        ("greenhouse_4", None, None, None, None, None),
        ("greenhouse_5", "Zoo", None, None, None, None),
        ("greenhouse_6", None, None, None, None, None),
    ]
    assert rows(got, "full_opening_link")[0] == (CLASSIC + "/jobs/1",)


def test_unify_greenhouse_shuffles_the_posting_once(spark, tmp_path):
    for name in ("greenhouse_openings", "greenhouse_departments"):
        spark.createDataFrame([], RAW[name]).write.parquet(str(tmp_path / name))
    openings, departments = (spark.read.schema(RAW[n]).parquet(str(tmp_path / n)) for n in ("greenhouse_openings", "greenhouse_departments"))
    staged = openings.withColumns({"full_opening_link": F.col("opening_link"), "job_board": F.lit("greenhouse")})
    found, wide, narrow = unify.unify_greenhouse(staged, departments), [], []
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    node = found._jdf.queryExecution().executedPlan()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    todo = [node.initialPlan() if node.nodeName() == "AdaptiveSparkPlan" else node]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            columns = node.output().mkString(",")
            (wide if "opening_title" in columns or "location" in columns else narrow).append(columns)
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert len(wide) == 1 and len(narrow) == 3, (wide, narrow)


def test_unify_lever(raw, rows):
    staged = staging.stage_lever(
        raw(
            "lever_openings",
            opening(1, "1", department_names="A", workplace_type="Remote"),
            opening(2, "2", department_names=" A-b – C ", workplace_type="Hybrid"),
            opening(3, "3", department_names="A – B – C – D"),
            opening(4, "4", department_names="A – B – C – D – E"),
            opening(5, "5", department_names=None),
            opening(6, "6", department_names=""),
        )
    )
    got = unify.unify_lever(staged)
    names = [c for c in UNIFIED_COLUMNS if c.endswith("_department")]
    assert rows(got, "id", *names, "is_remote") == [
        ("lever_1", "A", None, None, None, True),
        ("lever_2", "A-b", "C", None, None, False),
        ("lever_3", "A", "B", "C", "D", None),
        ("lever_4", "A", "B", "C", "D", None),
    ]


def test_unify_ashby(raw, rows):
    def ashby(n, **more):
        return {**opening(n, f"l{n}"), "opening_id": f"o{n}", "location_name": "Rome", "board_source": "b", **more}

    staged = staging.stage_ashby(
        raw("ashby_openings", ashby(1, department_id="t"), ashby(2), ashby(3, opening_id="o1", run_id="other"))
    )
    locations = staging.stage_ashby_locations(
        raw(
            "ashby_locations",
            *[
                {**opening(n, None), "opening_id": "o1", "secondary_location_name": name}
                for n, name in ((12, "Remote - EU"), (11, "Oslo"))
            ],
        )
    )
    teams = staging.stage_ashby_departments(
        raw(
            "ashby_departments",
            {**opening(1, None), "department_id": "t", "department_name": "Web", "parent_department_id": "e"},
            {**opening(2, None), "department_id": "e", "department_name": "Eng"},
        )
    )
    got = unify.unify_ashby(staged, locations, teams)
    assert rows(got, "id", "location", "is_remote", "primary_department", "secondary_department") == [
        ("ashby_1", "Rome, Oslo, Remote - EU", True, "Eng", "Web"),
        ("ashby_2", "Rome", False, None, None),
        ("ashby_3", "Rome", False, None, None),
    ]
    assert got.columns == UNIFIED_COLUMNS


@pytest.fixture
def unified(spark):
    def make(*partial):
        from jobtide.schemas import UNIFIED

        return spark.createDataFrame([tuple(p.get(f.name) for f in UNIFIED) for p in partial], UNIFIED)

    return make


def seen(n, link, day, board="lever", **more):
    return {"id": f"{board}_{n}", "full_opening_link": link, "created_date_utc": day, "job_board": board, **more}


def test_all_postings(unified, rows):
    today = date(2024, 1, 30)
    df = unified(
        seen(1, "x", today),
        seen(2, "x", today - timedelta(days=7)),
        seen(3, "y", today, opening_title="Data Engineer"),
        seen(4, None, today),
        seen(5, "z", today, board="ashby"),
        seen(6, "z", today - timedelta(days=90), board="greenhouse"),
    )
    mart = marts.all_postings(df, today)
    assert mart.columns == MART_COLUMNS
    assert rows(mart, "id", "is_active", "days_active", "posting_length_category", "opening_category") == [
        ("ashby_5", True, 91, "Stale", "Other"),
        ("greenhouse_6", False, 91, "Inactive", "Other"),
        ("lever_1", True, 8, "Recent", "Other"),
        ("lever_2", False, 8, "Inactive", "Other"),
        ("lever_3", True, 1, "New", "Data"),
    ]
    assert rows(marts.active_postings(mart), "id") == [("ashby_5",), ("lever_1",), ("lever_3",)]


def test_active_subsets(spark, unified, raw, rows):
    today = date(2024, 1, 30)
    mart = marts.all_postings(
        unified(seen(1, "x", today, source="u/1"), seen(2, "y", today, source="u/2"), seen(3, "z", today, source="u/3")),
        today,
    )
    boards = raw(
        "boards",
        {"id": 22, "url": "u/1/", "is_prospect": False},
        {"id": 23, "url": "u/2", "is_prospect": True},
        {"id": 24, "url": "u/3"},
    )
    assert rows(marts.active_selected(mart, boards), "id") == [("lever_1",)]
    assert rows(marts.active_prospect(mart, boards), "id") == [("lever_2",)]


def test_build_twice_gives_the_same_marts(spark, tmp_path, rows):
    raw_tables = event_boards.raw_tables(spark, SF)
    first = build.build(raw_tables, str(tmp_path / "one"), event_boards.AS_OF)
    before = {name: rows(df) for name, df in first.items()}
    again = build.build(raw_tables, str(tmp_path / "two"), event_boards.AS_OF)
    assert {name: rows(df) for name, df in again.items()} == before
    assert again["all_postings"].columns == MART_COLUMNS
    assert before["active_selected"] and before["active_prospect"]
    assert spark.catalog.tableExists("core.active_postings")
    active = spark.table("core.all_postings").where("is_active")
    plan = active._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*is_active", plan)


def test_lifespan_survives_a_hot_link(spark, rows):
    """A third of all rows share one link; sort-merge join and grouping give what a window gives."""
    n = 3000
    link = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), (F.col("id") % 500).cast("string")))
    df = spark.range(n).select(
        "id", link.alias("link"), F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("day")
    )
    from jobtide.operators.joins import with_lifespan

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rows(with_lifespan(df, "link", "day"), "id", "earliest_opening_date", "latest_opening_date")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    days = {}
    data = [(i, "hot" if i % 3 == 0 else f"l{i % 500}", date(2024, 1, 1) + timedelta(days=i % 40)) for i in range(n)]
    for _, k, d in data:
        days.setdefault(k, []).append(d)
    assert got == [(i, min(days[k]), max(days[k])) for i, k, _ in data]
