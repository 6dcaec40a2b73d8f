"""Staging, unifying and lifespans on random rows against plain Python."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobtide.plans import marts, staging, unify
from jobtide.sources.page_elements import read_elements

T0 = 1706572800
SOURCES = ["https://boards.greenhouse.io/a", "https://job-boards.greenhouse.io/b"]
NAMES = ["primary_department", "secondary_department", "tertiary_department", "quaternary_department"]


def day(at):
    return datetime.fromtimestamp(at, timezone.utc).date()


def first_by(rows, key):
    best = {}
    for r in sorted(rows, key=lambda r: (r["updated_at"], r["id"])):
        best.setdefault(key(r), r)
    return list(best.values())


def random_openings(rng, n):
    made = []
    for i in range(n):
        at = T0 - rng.randrange(40) * 86400 + rng.randrange(3) * 20000
        source = rng.choice(SOURCES)
        link = f"/x/jobs/{rng.randrange(12)}" if source == SOURCES[0] else f"https://l/{rng.randrange(12)}"
        ids = rng.choice([None, "", "1", "1,2", "2,3,4", "9", "5,1,1"])
        made.append(
            {
                "id": i,
                "record_id": f"r{rng.randrange(n // 2)}",
                "created_at": at,
                "updated_at": at,
                "source": source,
                "run_id": str(day(at).day % 3),
                "existing_used": rng.random() < 0.5,
                "department_ids": ids,
                "location": rng.choice([None, "Rome", "remote"]),
                "opening_link": link,
                "opening_title": f"t{i}",
            }
        )
    return made


def random_departments(rng, n):
    return [
        {
            "id": i,
            "record_id": f"d{rng.randrange(n)}",
            "created_at": T0,
            "updated_at": rng.choice([T0 + rng.randrange(5), 1684600000 - rng.randrange(2)]),
            "source": rng.choice(SOURCES),
            "run_id": str(rng.randrange(3)),
            "department_category": f"level-{rng.randrange(5)}",
            "department_id": str(rng.randrange(1, 6)),
            "department_name": rng.choice("ABCDEF"),
        }
        for i in range(n)
    ]


def expected_greenhouse(openings, departments):
    kept = first_by(first_by(openings, lambda r: r["record_id"]), lambda r: (r["opening_link"], day(r["updated_at"])))
    recent = [d for d in departments if d["updated_at"] > 1684600000]
    by_record = {d["id"] for d in first_by(recent, lambda d: d["record_id"])}
    winners = [d for d in first_by(recent, lambda d: (d["department_id"], d["run_id"])) if d["id"] in by_record]
    found = {(d["source"], d["department_id"], d["run_id"]): d for d in winners}
    unified = []
    for o in kept:
        ids = "No Dept" if o["department_ids"] is None else o["department_ids"]
        if ids == "":
            continue
        levels = [[] for _ in NAMES]
        for one in ids.split(","):
            d = found.get((o["source"], one, o["run_id"]))
            level = int(d["department_category"][-1]) if d else None
            if level is not None and level < 4:
                levels[level].append(d["department_name"])
            if one == "No Dept":
                levels[0].append("No Department")
        link = o["opening_link"] if o["source"] == SOURCES[1] else o["source"] + o["opening_link"].removeprefix("/x")
        names = [max(v) if v else None for v in levels]
        unified.append((f"greenhouse_{o['id']}", link, day(o["created_at"]), *names))
    return unified


@pytest.mark.parametrize("seed", range(3))
def test_greenhouse(spark, raw, rows, seed):
    rng = random.Random(seed)
    openings, departments = random_openings(rng, 300), random_departments(rng, 60)
    unified = unify.unify_greenhouse(
        staging.stage_greenhouse(raw("greenhouse_openings", *openings)),
        staging.stage_greenhouse_departments(raw("greenhouse_departments", *departments)),
    )
    expected = expected_greenhouse(openings, departments)
    got = unified.select("id", "full_opening_link", "created_date_utc", *NAMES).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert len(expected) > 50

    as_of = day(T0)
    days = {}
    for _, link, seen, *_ in expected:
        days.setdefault(link, []).append(seen)
    spans = sorted((e[0], e[2] == as_of, (max(days[e[1]]) - min(days[e[1]])) // timedelta(days=1) + 1) for e in expected)
    mart = marts.all_postings(unified, as_of).select("id", "is_active", "days_active").collect()
    assert sorted(map(tuple, mart)) == spans


TAGS = st.sampled_from(["<div>", "</div>", "<p class='a'>", "</p>", "<br>", "x", " ", "<a href=\"u\">", "</a>", "<", ">", "&amp;", "<!--", "-->", "'", '"', "<script>", "</script>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(TAGS, max_size=30).map("".join))
def test_elements_of_any_text_are_nested(html):
    found = read_elements(html)
    for place, element in enumerate(found):
        start, end, parent = element[:3]
        assert start == place <= end < len(found)
        if parent is not None:
            assert found[parent][0] < start and end <= found[parent][1]
