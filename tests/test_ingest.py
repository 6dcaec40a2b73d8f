from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F
from test_sources import POSTING, SECOND, grouped, nested, paged

from jobtide.plans import build, ingest
from jobtide.quality import declared
from jobtide.schemas import PAGES, RAW, RESPONSES
from jobtide.sources import tables

T0 = 1706572800  # 2024-01-30
CLASSIC = """<section class="level-0"><h3 id="10">Sales</h3></section>
<div class="opening" department_id="10" office_id="1"><a href="/old/jobs/1">Lead</a><span>Rome</span></div>"""


def inputs(spark, at, run):
    pages = spark.createDataFrame(
        [
            ("https://boards.greenhouse.io/old/", 1, run, at, CLASSIC),
            ("https://job-boards.greenhouse.io/new", 1, run, at, paged(("Data", [("https://n/1", "A")]))),
            ("https://job-boards.greenhouse.io/new", 2, run, at, paged(("Data", [("https://n/2", "B")]))),
            ("https://jobs.lever.co/lev", 1, run, at, grouped(("Product", "Web", ["https://l/1"]))),
        ],
        PAGES,
    )
    import json

    ashby = json.dumps(nested([POSTING, SECOND], [{"id": "t", "name": "Eng", "parentTeamId": None}]))
    flat = json.dumps(
        [
            {
                "uuid": "j1",
                "name": "Cook",
                "department": {"id": "d", "label": "Operations"},
                "url": "https://r/1",
                "workLocation": {"id": "w", "label": place},
            }
            for place in ("Rome", "Remote")
        ]
    )
    responses = spark.createDataFrame([("https://jobs.ashbyhq.com/ash", run, at, ashby)], RESPONSES)
    flats = spark.createDataFrame([("https://api/rip/jobs", run, at, flat)], RESPONSES)
    return pages, responses, flats


def test_two_days_from_pages_to_marts(spark, raw, rows, tmp_path):
    base = str(tmp_path / "raw")
    for day, run in ((0, "first"), (8, "second")):
        pages, responses, flats = inputs(spark, T0 + day * 86400, run)
        landed = ingest.all_rows(pages, responses, flats)
        assert set(landed) - {"rejected"} | {"boards"} == set(RAW)
        ingest.land(landed, base, run, datetime(2024, 1, 30 if day == 0 else 31))
    boards = raw("boards", {"id": 1, "url": "https://jobs.lever.co/lev/", "is_prospect": True})
    stored = {name: tables.read_raw(spark, base, name) for name in RAW if name != "boards"}

    checks = declared.run_all(stored, {k: d for k, d in declared.RAW_CHECKS.items() if k in stored})
    assert rows(checks.where("verdict <> 'pass'")) == []

    marts = build.build({**stored, "boards": boards}, str(tmp_path / "built"), date(2024, 2, 7))
    mart = marts["all_postings"]
    assert mart.count() == 14
    found = rows(mart.where("is_active"), "full_opening_link", "primary_department", "days_active", "opening_category")
    ashby = "https://jobs.ashbyhq.com/ash/"
    assert found == [
        ("https://boards.greenhouse.io/old/jobs/1", "Sales", 9, "Sales"),
        (ashby + "p1", "Eng", 9, "Other"),
        (ashby + "p2", "Eng", 9, "Other"),
        ("https://l/1", "Product", 9, "Product"),
        ("https://n/1", "Data", 9, "Data"),
        ("https://n/2", "Data", 9, "Data"),
    ]
    assert rows(mart.where("job_board = 'rippling'"), "location", "is_remote") == [("Rome, Remote", True)] * 2
    assert rows(marts["active_prospect"], "full_opening_link") == [("https://l/1",)]
    assert rows(marts["active_selected"], "full_opening_link") == [("https://l/1",)]


def test_a_run_in_parts_each_landed_twice(spark, rows, tmp_path):
    base, parts = str(tmp_path), {}
    for name, run in (("one", "run"), ("two", "run")):
        pages, responses, flats = inputs(spark, T0, run)
        moved = [df.withColumn(c, F.concat(F.col(c), F.lit(f"-{name}"))) for df, c in ((pages, "source"), (responses, "board"), (flats, "board"))]
        parts[name] = ingest.all_rows(*moved)
    # the second landing of each part is after midnight, and told in another zone
    late = datetime(2024, 1, 31, 5, 30, tzinfo=timezone(timedelta(hours=5)))
    for at in (datetime(2024, 1, 30, 23, 59), late):
        for name, found in parts.items():
            ingest.land(found, base, f"run/{name}", at)
    for name in RAW:
        if name != "boards":
            expected = sum(found[name].count() for found in parts.values())
            assert tables.read_raw(spark, base, name).count() == expected > 0, name
    # a table without times of its own keeps that of the first landing
    dated = tables.read_raw(spark, base, "rippling_openings")
    assert rows(dated.select("created_at").distinct()) == [(datetime(2024, 1, 30, 23, 59),)]
    ids = tables.read_raw(spark, base, "lever_openings")
    assert ids.count() == ids.select("id").distinct().count()


def test_what_cannot_be_read_is_kept_with_its_reason(spark, rows, tmp_path):
    pages = spark.createDataFrame([("https://careers.example.org/x", 1, "r", T0, "<p>")], PAGES)
    bad = spark.createDataFrame([("https://jobs.ashbyhq.com/a", "r", T0, "{cut"), ("https://jobs.ashbyhq.com/b", "r", T0, None)], RESPONSES)
    flat = spark.createDataFrame([("https://api/rip/jobs", "r", T0, "[]")], RESPONSES)
    assert rows(ingest.read_rejected(spark, str(tmp_path))) == []
    for _ in range(2):
        ingest.land(ingest.all_rows(pages, bad, flat), str(tmp_path), "r", datetime(2024, 1, 30))
    found = rows(ingest.read_rejected(spark, str(tmp_path)), "kind", "reason")
    assert found == [("flat response", "no_postings"), ("nested response", "decode_error"), ("nested response", "decode_error"), ("page", "unknown_board")]


def test_pages_and_bodies_are_read_from_their_parsed_form(spark):
    pages, responses, flats = inputs(spark, T0, "r")
    for df in ingest.all_rows(pages, responses, flats).values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" not in plan and "from_json" not in plan


def test_a_stored_file_says_where_and_when(spark, rows):
    pages, responses, flats = inputs(spark, T0, "r")
    filed = pages.withColumns({"raw_file": F.lit("f"), "existing_used": F.lit(True), "first_seen_at": F.lit(T0 - 5)})
    found = ingest.page_rows(filed)["lever_openings"]
    assert rows(found, "raw_file", "existing_used", "created_at", "updated_at") == [("f", True, T0 - 5, T0)]
