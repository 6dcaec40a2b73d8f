import json
import re
import time
import tracemalloc
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobtide.schemas import PAGES, RESPONSES
from jobtide.sources import html_boards as H
from jobtide.sources import json_boards as J
from jobtide.sources import tables
from jobtide.sources.page_elements import page_elements, read_elements
from jobtide.sources.runs import stamp_run


@pytest.fixture
def pages(spark):
    def make(*rows, source="https://boards.greenhouse.io/acme"):
        full = [(source, n, "run", 5, html) for n, html in enumerate(rows, 1)]
        return spark.createDataFrame(full, PAGES)

    return make


def test_read_elements_mends_tag_soup():
    found = read_elements('<div class="a"><p>one<p>two<br>three</div><b>x &amp; y<i>z</b>')
    assert [(e[0], e[1], e[2], e[3], e[4]) for e in found] == [
        (0, 3, None, "div", None),
        (1, 1, 0, "p", "one"),
        (2, 3, 0, "p", "two"),
        (3, 3, 2, "br", None),
        (4, 5, None, "b", "x & y"),
        (5, 5, 4, "i", "z"),
    ]
    script = read_elements('<script>if (a<b) "</p>"</script><p>k</p>')
    assert [(e[3], e[4]) for e in script] == [("script", 'if (a<b) "</p>"'), ("p", "k")]
    assert read_elements("1 < 2 and <a href='q\"'>l</a>")[0][7] == 'q"'
    assert read_elements("<!-- <a> --><A HREF=x>l</A>")[0][3] == "a"
    assert read_elements("plain") == []


@pytest.fixture
def peak(monkeypatch):
    """Most bytes of Python objects at once while a batch of equal pages is read."""
    monkeypatch.setattr("jobtide.sources.page_elements._SLICE", 1 << 16)
    _peak("<p>", 1)  # what a first call loads is not counted
    return _peak


def _peak(page, count):
    tracemalloc.start()
    sizes = [len(part) for part in page_elements.func(iter([pa.array([page] * count)]))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == count
    return most


def test_pages_are_read_in_slices_of_a_batch(spark, peak):
    """A batch of ten times the pages takes no more memory in Python, and gives each page its elements."""
    page = '<div class="opening"><a href="/jobs/1">Cook</a><span>Rome</span></div>' * 50
    assert 1.5 * peak(page, 30) > peak(page, 300)
    texts = [None, "", page, "<p>a", page * 400, page * 400, None, "<br>"]
    found = spark.createDataFrame(list(enumerate(texts)), "n int, html string").repartition(1)
    counts = found.select("n", F.size(page_elements("html")).alias("size")).collect()
    assert {r["n"]: r["size"] for r in counts} == {n: len(read_elements(t or "")) for n, t in enumerate(texts)}


def test_openings_are_read_in_slices(peak):
    block = '<div class="opening" department_id="1,2" office_id="o1"><a href="/j">Cook</a><br><span>Rome</span></div>'
    assert 1.5 * peak(block * 40, 30) > peak(block * 40, 300)


def test_grouped_pages_are_read_in_slices(peak):
    page = "".join(grouped(("Head", f"g{i}", [f"/{i}", f"/{i}x"])) for i in range(20))
    assert 1.5 * peak(page, 30) > peak(page, 300)


@pytest.fixture
def worker_peak(spark):
    """Most MB that one of Spark's Python workers takes while an extraction reads a batch of equal pages."""

    def status(process, field):
        found = re.search(rf"^{field}:\s+(\d+)", (process / "status").read_text(), re.M)
        return int(found[1]) if found else 0

    def workers():
        jvm = spark._jvm.java.lang.ProcessHandle.current().pid()
        parents = {}
        for process in Path("/proc").glob("[0-9]*"):
            try:
                parents[int(process.name)] = status(process, "PPid")
            except OSError:  # it ended meanwhile
                pass
        return [Path(f"/proc/{pid}") for pid, parent in parents.items() if parents.get(parent) == jvm]

    def measure(extract, page, count):
        for process in workers():
            (process / "clear_refs").write_text("5")  # its peak counts from now on
        pages = spark.range(0, count, 1, 1).select(
            F.lit("https://jobs.lever.co/acme").alias("source"),
            F.col("id").alias("page_number"),
            F.lit("run").alias("run_id"),
            F.lit(5).cast("bigint").alias("fetched_at"),
            F.concat(F.lit(page), "id").alias("html"),
        )
        extract(pages).write.format("noop").mode("overwrite").save()
        return max(status(process, "VmHWM") for process in workers()) / 1024

    return measure


def test_a_batch_of_grouped_pages_fits_a_worker(worker_peak):
    """Spark sends 10,000 pages at once; as Python objects their elements would take some 600 MB."""
    page = "".join(grouped(("Head", f"g{i}", [f"/{i}", f"/{i}x"])) for i in range(10))
    assert worker_peak(H.extract_grouped, page, 10_000) < 350


def test_a_batch_of_openings_fits_a_worker(worker_peak):
    block = '<div class="opening" department_id="1,2" office_id="o1"><a href="/j">Cook</a><br><span>Rome</span></div>'
    assert worker_peak(H.extract_openings, block * 25, 10_000) < 350


def test_extract_departments(pages, rows):
    html = """<section class="level level-0"><h3 id="10">Eng</h3>
      <section class="child level-1"><h4 id="11">Backend</h4></section></section>
      <section class="level-2"><h5>No id</h5><p id="x">t</p></section>
      <section class="other"><h3 id="12">Skip</h3></section>"""
    got = H.extract_departments(pages(html, None, ""))
    assert rows(got, "department_category", "department_id", "department_name") == [
        ("level-0", "10", "Eng"),
        ("level-1", "11", "Backend"),
        ("level-2", None, "No id"),
    ]
    assert rows(got, "company_name", "source", "run_id", "created_at", "existing_used")[0] == (
        "acme",
        "https://boards.greenhouse.io/acme",
        "run",
        5,
        False,
    )
    assert got.select("record_id").distinct().count() == 3


def test_extract_openings(pages, rows):
    html = """<div class="opening" department_id="1,2" office_id="7"><a href="/acme/jobs/1">Title <b>x</b></a>
      <br><span class="location">Rome</span></div>
      <div class="opening" department_id=""><a href="">No link</a></div>
      <div class="opening featured"><a href="/no">Other class</a></div>"""
    got = H.extract_openings(pages(html, html))
    columns = ["department_ids", "office_ids", "opening_link", "opening_title", "location"]
    assert rows(got, *columns) == [
        (None, None, None, "No link", None),
        (None, None, None, "No link", None),
        ("1,2", "7", "/acme/jobs/1", "Title ", "Rome"),
        ("1,2", "7", "/acme/jobs/1", "Title ", "Rome"),
    ]
    assert got.select("record_id").distinct().count() == 4


def paged(*groups):
    made = []
    for heading, cells in groups:
        inner = "".join(
            f'<tr><td class="cell"><a href="{link}"><p class="body body--medium">{title}</p>'
            f'<p class="body body--metadata">Rome</p></a></td></tr>'
            for link, title in cells
        )
        made.append(
            '<div class="job-posts"><div class="job-posts--table--department">'
            f"<h3>{heading}</h3><table>{inner}</table></div></div>"
        )
    return "".join(made)


def test_extract_paged(pages, rows):
    one = paged(("Eng", [("l1", "t1"), ("l2", "t2")]), ("Ops", [("l3", "t3")]))
    two = paged(("Eng", [("l4", "t4")]))
    board = pages(one, two, paged(), source="https://job-boards.greenhouse.io/acme")
    got = H.extract_paged_openings(board)
    assert rows(got, "opening_link", "opening_title", "department_ids", "location") == [
        ("l1", "t1", "acme_Eng", "Rome"),
        ("l2", "t2", "acme_Eng", "Rome"),
        ("l3", "t3", "acme_Ops", "Rome"),
        ("l4", "t4", "acme_Eng", "Rome"),
    ]
    assert got.select("record_id").distinct().count() == 4
    departments = H.extract_paged_departments(board)
    assert rows(departments, "department_id", "department_category") == [
        ("acme_Eng", "level-0"),
        ("acme_Eng", "level-0"),
        ("acme_Ops", "level-0"),
    ]
    assert departments.select("record_id").distinct().count() == 3


def grouped(*groups):
    made = []
    for header, label, links in groups:
        top = f'<div class="large-category-header">{header}</div>' if header else ""
        inner = "".join(
            f'<a class="posting-title" href="{link}"><h5>T</h5><span class="x workplaceTypes">Remote — </span>'
            '<span class="sort-by-location location">Rome</span></a>'
            for link in links
        )
        made.append(
            f'<div class="postings-group">{top}<div class="large-category-label">{label}</div>{inner}</div>'
        )
    return "".join(made)


def test_extract_grouped_carries_headers_within_a_page(pages, rows):
    carried = grouped(("H1", "a", ["1"]), (None, "b", ["2", "3"]), ("H2", "c", ["4"]), (None, "d", ["5"]))
    labels_only = grouped((None, "a", ["6"]), ("H1", "b", ["7"]))
    got = H.extract_grouped(pages(carried, labels_only, "<p>none</p>", source="https://jobs.lever.co/acme"))
    assert rows(got, "opening_link", "department_names") == [
        ("1", "H1 – a"),
        ("2", "H1 – b"),
        ("3", "H1 – b"),
        ("4", "H2 – c"),
        ("5", "H2 – d"),
        ("6", "a"),
        ("7", "b"),
    ]
    assert rows(got, "workplace_type", "location", "opening_title")[0] == ("Remote", "Rome", "T")
    assert got.select("record_id").distinct().count() == 7


def test_page_functions_run_once(pages):
    page = pages("<p>x</p>")
    for extract in (
        H.extract_departments,
        H.extract_openings,
        H.extract_paged_departments,
        H.extract_paged_openings,
        H.extract_grouped,
    ):
        text = extract(page)._jdf.queryExecution().executedPlan().toString()
        assert text.count("ArrowEvalPython") == 1
        assert "Exchange" not in text


POSTING = {
    "id": "p1",
    "title": "T",
    "teamId": "t",
    "locationId": "l",
    "locationName": "Rome",
    "employmentType": "FullTime",
    "compensationTierSummary": "",
    "secondaryLocations": None,
}
SECOND = {**POSTING, "id": "p2", "secondaryLocations": [{"locationId": "x", "locationName": "Oslo"}] * 2}


@pytest.fixture
def responses(spark):
    def make(*bodies):
        full = [
            (f"https://jobs.ashbyhq.com/The%20Firm{n}", "run", 5, b if b is None or isinstance(b, str) else json.dumps(b))
            for n, b in enumerate(bodies)
        ]
        return spark.createDataFrame(full, RESPONSES)

    return make


def nested(postings, teams=()):
    return {"data": {"jobBoard": {"teams": list(teams), "jobPostings": postings}}}


def test_split_valid(responses, rows):
    broken = {k: v for k, v in POSTING.items() if k != "title"}
    df = responses(
        nested([POSTING]),
        {"data": {"jobBoard": None}},
        nested([]),
        '{"data": {"jobBoard"',
        nested([POSTING, broken]),
        None,
        "null",
        "[]",
    )
    good, rejected = J.split_valid(df)
    assert rows(good, "board") == [("https://jobs.ashbyhq.com/The%20Firm0",)]
    assert [(r[0][-1], r[1]) for r in rows(rejected, "board", "reason")] == [
        ("1", "no_board"),
        ("2", "no_postings"),
        ("3", "decode_error"),
        ("4", "decode_error"),
        ("5", "decode_error"),
        ("6", "decode_error"),
        ("7", "decode_error"),
    ]


def test_bodies_are_parsed_once(responses):
    df = responses(nested([POSTING]))
    frames = [*J.split_valid(df), *J.split_valid_flat(df), J.decode_flat_board(df)]
    frames += [J.decode_postings(df), J.decode_locations(df), J.decode_teams(df)]
    for frame in frames:
        assert frame._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1


def test_decode_nested(responses, rows):
    teams = [{"id": "t", "name": "Web", "parentTeamId": "e"}, {"id": "e", "name": "Eng", "parentTeamId": None}]
    df = responses(nested([POSTING, SECOND], teams), nested([], teams[1:]), "{")
    postings = J.decode_postings(df)
    assert rows(postings, "opening_id", "opening_link", "compensation_tier", "company_name") == [
        ("p1", "https://jobs.ashbyhq.com/The%20Firm0/p1", None, "The Firm0"),
        ("p2", "https://jobs.ashbyhq.com/The%20Firm0/p2", None, "The Firm0"),
    ]
    locations = J.decode_locations(df)
    assert rows(locations, "opening_id", "secondary_location_name") == [("p2", "Oslo")] * 2
    decoded_teams = J.decode_teams(df)
    assert rows(decoded_teams, "department_id", "parent_department_id") == [
        ("e", None),
        ("e", None),
        ("t", "e"),
    ]
    keys = [r.record_id for d in (postings, locations, decoded_teams) for r in d.collect()]
    assert len(set(keys)) == len(keys) == 7


def test_decode_flat(spark, rows):
    def entry(uuid, place):
        return {
            "uuid": uuid,
            "name": "T",
            "department": {"id": "d", "label": "Eng"},
            "url": f"u/{uuid}",
            "workLocation": {"id": "w", "label": place},
        }

    body = json.dumps([entry("j1", "Rome"), entry("j2", "Oslo"), entry("j1", "Bern"), entry("j1", "Aix")])
    full = [("https://api/acme/jobs", "run", 5, b) for b in (body, "[]", "{broken", None)]
    df = spark.createDataFrame(full, RESPONSES)
    got = J.decode_flat_board(df)
    assert rows(got, "job_id", "location", "department", "board_token") == [
        ("j1", "Rome, Bern, Aix", "Eng", "acme"),
        ("j2", "Oslo", "Eng", "acme"),
    ]
    good, rejected = J.split_valid_flat(df)
    assert good.count() == 1
    assert rows(rejected, "reason") == [("decode_error",), ("decode_error",), ("no_postings",)]


def test_stamp_run(spark):
    stamped = stamp_run(spark.range(1), F.lit(5), F.lit("run"), F.lit("acme"), F.lit("src"))
    row = stamped.first()
    assert (row.created_at, row.updated_at, row.company_name, row.source, row.run_id) == (5, 5, "acme", "src", "run")
    assert row.raw_file is None and row.existing_used is False


def test_enabled_boards(raw, rows):
    boards = raw(
        "boards",
        {"url": "a", "is_enabled": True, "job_board_provider": "lever", "board_token": "ta"},
        {"url": "a", "is_enabled": True, "job_board_provider": "rippling", "board_token": "tb"},
        {"url": "c", "is_enabled": False, "job_board_provider": "rippling", "board_token": "tc"},
    )
    assert rows(tables.enabled_boards(boards)) == [("a",)]
    assert rows(tables.enabled_boards(boards, "rippling")) == [("tb",)]


def test_a_flat_response_of_many_entries(spark):
    """Postings are listed at two places far apart; a quadratic pass over these would take an hour."""
    half = 50_000
    entries = [
        {"uuid": f"j{i % half}", "name": "Cook", "department": {"id": "d", "label": "Ops"}, "url": f"u{i % half}", "workLocation": {"id": "w", "label": f"p{i}"}}
        for i in range(2 * half)
    ]
    flat = spark.createDataFrame([("https://api/rip/jobs", "r", 0, json.dumps(entries))], RESPONSES)
    start = time.time()
    found = J.decode_flat_board(flat).select("job_id", "location").collect()
    assert [tuple(r) for r in found[:2]] == [("j0", f"p0, p{half}"), ("j1", f"p1, p{half + 1}")]
    assert len(found) == half and time.time() - start < 60


def test_a_page_of_many_groups(spark):
    page = grouped(*[("Head" if i % 1000 == 0 else None, f"g{i}", [f"https://l/{i}"]) for i in range(20_000)])
    pages = spark.createDataFrame([("https://jobs.lever.co/lev", 1, "r", 0, page)], PAGES)
    start = time.time()
    found = H.extract_grouped(pages).select("department_names").distinct().count()
    assert found == 20_000 and time.time() - start < 60
