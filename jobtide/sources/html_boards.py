"""Stored board pages to raw rows.

HTML is tag soup, which no built-in Spark function reads, so one small Arrow function lists the
elements of a page in document order. What the elements mean for each board style is stated as
Spark expressions over that list. A page row is (source, page_number, run_id, fetched_at, html), and
may say where its file lies (``raw_file``), whether a file of an earlier fetch was used
(``existing_used``) and when that was made (``first_seen_at``). Every page is one row and is worked
on within its row, so nothing is shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import PATH_SEPARATOR
from jobtide.functions import (
    blank_to_null,
    first_value,
    first_word,
    keyed_id,
    last_word,
    page_company,
)
from jobtide.operators.in_row import carried
from jobtide.operators.reshape import entries
from jobtide.sources.page_elements import page_elements
from jobtide.sources.runs import stamp_run

def _classed(element: Column, text: str, exact: bool = False) -> Column:
    found = element["class"] == text if exact else element["class"].contains(text)
    return F.coalesce(found, F.lit(False))


def _tagged(element: Column, tag: str) -> Column:
    return element["tag"] == tag


def _heading(element: Column) -> Column:
    return element["tag"].startswith("h")


def _subtree(root: Column) -> Column:
    """The element and all beneath it: they follow each other in document order."""
    return F.slice("_elements", root["start"] + 1, root["end"] - root["start"] + 1)


def _within(element: Column, tag: str, text: str, exact: bool = False) -> Column:
    """Is the parent an element of that tag and class?"""
    parent = F.get(F.col("_elements"), element["parent"])
    return F.coalesce(_tagged(parent, tag) & _classed(parent, text, exact), F.lit(False))


def _pick(elements: Column, condition) -> Column:
    return F.filter(elements, condition)


def _first(elements: Column, field: str) -> Column:
    return first_value(F.transform(elements, lambda e: e[field]))


#: What a page may say of its file, and what holds where it does not.
_FILE = {"raw_file": "string", "existing_used": "boolean", "first_seen_at": "bigint"}


def with_elements(pages: DataFrame) -> DataFrame:
    """Pages with the list of their elements in place of the markup; pages that have it stay.

    Store this where several extractions read the same pages, and each is parsed once.
    """
    if "_elements" in pages.columns:
        return pages
    missing = {c: F.lit(None).cast(t) for c, t in _FILE.items() if c not in pages.columns}
    return pages.withColumns({**missing, "_elements": page_elements("html")}).drop("html")


def _stamped(rows: DataFrame, kind: str, places: list[str]) -> DataFrame:
    key = keyed_id(
        F.lit(kind), *[F.col(c) for c in ["source", "run_id", "fetched_at", "page_number", *places]]
    )
    return stamp_run(
        rows.withColumn("record_id", key),
        F.col("fetched_at"),
        F.col("run_id"),
        page_company(F.col("source")),
        F.col("source"),
        created_at=F.coalesce("first_seen_at", "fetched_at"),
        raw_file=F.col("raw_file"),
        existing_used=F.coalesce("existing_used", F.lit(False)),
    )


_HEADER = ["record_id", "created_at", "updated_at", "source", "run_id", "raw_file", "existing_used"]
_DEPARTMENTS = [
    *_HEADER,
    "company_name",
    "department_category",
    "department_id",
    "department_name",
]
_OPENINGS = [
    *_HEADER,
    "department_ids",
    "location",
    "office_ids",
    "opening_link",
    "opening_title",
]
_GROUPED = [
    *_HEADER,
    "company_name",
    "department_names",
    "location",
    "opening_link",
    "opening_title",
    "workplace_type",
]


def page_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Every anchor with a target on a page, with its 0-based place among them and its text."""
    anchors = _pick(page_elements("html"), lambda e: _tagged(e, "a") & e["href"].isNotNull())
    return entries(pages, anchors, "_place", "_a", key).select(
        key,
        F.col("_place").cast("bigint").alias("link_index"),
        F.col("_a.href").alias("href"),
        F.col("_a.text").alias("link_text"),
    )


def extract_departments(pages: DataFrame) -> DataFrame:
    """Classic boards: a department per section with a level, named by its heading."""

    def department(section: Column) -> Column:
        headings = _pick(
            _subtree(section), lambda h: _heading(h) & _within(h, "section", "level")
        )
        return F.struct(
            last_word(section["class"]).alias("department_category"),
            _first(headings, "id").alias("department_id"),
            _first(headings, "text").alias("department_name"),
        )

    sections = _pick(
        F.col("_elements"), lambda e: _tagged(e, "section") & _classed(e, "level")
    )
    rows = with_elements(pages).withColumn("_rows", F.transform(sections, department))
    return _exploded(rows, "_row", "department", ["_row"]).select(*_DEPARTMENTS)


def _exploded(rows: DataFrame, place: str, kind: str, places: list[str]) -> DataFrame:
    page = ["source", "page_number", "run_id", "fetched_at", *_FILE]
    fields = entries(rows, "_rows", place, "_r", *page).select(*page, place, "_r.*")
    return _stamped(fields, kind, places)


def extract_openings(pages: DataFrame) -> DataFrame:
    """Classic boards: an opening per block, with its department and office lists."""

    def opening(block: Column) -> Column:
        inside = _subtree(block)
        anchors = _pick(inside, lambda e: _tagged(e, "a"))
        return F.struct(
            blank_to_null(block["department_id"]).alias("department_ids"),
            blank_to_null(block["office_id"]).alias("office_ids"),
            _first(anchors, "href").alias("opening_link"),
            _first(anchors, "text").alias("opening_title"),
            _first(_pick(inside, lambda e: _tagged(e, "span")), "text").alias("location"),
        )

    blocks = _pick(
        F.col("_elements"), lambda e: _tagged(e, "div") & _classed(e, "opening", exact=True)
    )
    rows = with_elements(pages).withColumn("_rows", F.transform(blocks, opening))
    return _exploded(rows, "_row", "opening", ["_row"]).select(*_OPENINGS)


def extract_paged_departments(pages: DataFrame) -> DataFrame:
    """Paged boards: a top-level department per table heading, its id made of company and name."""
    headings = _pick(
        F.col("_elements"),
        lambda h: _heading(h)
        & h["text"].isNotNull()
        & _within(h, "div", "job-posts--table--department", exact=True),
    )
    names = F.transform(headings, lambda h: F.struct(h["text"].alias("department_name")))
    rows = _exploded(
        with_elements(pages).withColumn("_rows", names), "_row", "paged department", ["_row"]
    )
    return rows.withColumns(
        {
            "department_category": F.lit("level-0"),
            "department_id": F.concat("company_name", F.lit("_"), "department_name"),
        }
    ).select(*_DEPARTMENTS)


def extract_paged_openings(pages: DataFrame) -> DataFrame:
    """Paged boards: an opening per table cell, in the department its group is headed by."""

    def headed(group: Column) -> Column:
        inside = _subtree(group)
        return F.struct(
            _first(_pick(inside, _heading), "text").alias("heading"),
            _pick(inside, lambda e: _tagged(e, "td") & _classed(e, "cell", exact=True)).alias(
                "cells"
            ),
        )

    def opening(cell: Column) -> list[Column]:
        inside = _subtree(cell)
        lines = _pick(inside, lambda e: _tagged(e, "p"))
        title = _pick(lines, lambda e: _classed(e, "body--medium"))
        location = _pick(lines, lambda e: _classed(e, "body--metadata"))
        return [
            _first(_pick(inside, lambda e: _tagged(e, "a")), "href").alias("opening_link"),
            _first(title, "text").alias("opening_title"),
            _first(location, "text").alias("location"),
        ]

    def openings(group: Column, place: Column) -> Column:
        return F.transform(
            group["cells"],
            lambda cell, row: F.struct(
                place.alias("_group"),
                row.alias("_row"),
                group["heading"].alias("_heading"),
                *opening(cell),
            ),
        )

    groups = _pick(
        F.col("_elements"), lambda e: _tagged(e, "div") & _classed(e, "job-posts", exact=True)
    )
    found = F.transform(groups, headed)
    rows = with_elements(pages).withColumn("_rows", F.flatten(F.transform(found, openings)))
    stamped = _exploded(rows, "_place", "paged opening", ["_group", "_row"])
    return stamped.withColumns(
        {
            "department_ids": F.concat("company_name", F.lit("_"), "_heading"),
            "office_ids": F.lit(None).cast("string"),
        }
    ).select(*_OPENINGS)


def page_groups(pages: DataFrame) -> DataFrame:
    """Grouped boards: the groups of a page with header, label and openings, as an array."""

    def opening(anchor: Column) -> Column:
        inside = _subtree(anchor)
        spans = _pick(inside, lambda e: _tagged(e, "span"))
        kinds = F.transform(
            _pick(spans, lambda e: _classed(e, "workplaceType")), lambda e: first_word(e["text"])
        )
        return F.struct(
            anchor["href"].alias("opening_link"),
            _first(_pick(inside, lambda e: _tagged(e, "h5")), "text").alias("opening_title"),
            first_value(kinds).alias("workplace_type"),
            _first(_pick(spans, lambda e: _classed(e, "location")), "text").alias("location"),
        )

    def group_row(group: Column) -> Column:
        inside = _subtree(group)

        def named(text: str) -> Column:
            return _first(_pick(inside, lambda e: _tagged(e, "div") & _classed(e, text)), "text")

        titles = _pick(inside, lambda e: _tagged(e, "a") & _classed(e, "posting-title", exact=True))
        return F.struct(
            named("large-category-header").alias("header"),
            named("large-category-label").alias("label"),
            F.transform(titles, opening).alias("openings"),
        )

    groups = _pick(
        F.col("_elements"), lambda e: _tagged(e, "div") & _classed(e, "postings-group", exact=True)
    )
    found = with_elements(pages).withColumn("_groups", F.transform(groups, group_row))
    return found.drop("_elements")


def extract_grouped(pages: DataFrame) -> DataFrame:
    """Grouped boards: openings under a ``header – label`` path.

    A header holds for the groups after it until the next one; a page whose first group has none
    uses labels alone. A page is one row, so headers are carried within it without a shuffle.
    """
    groups = F.col("_groups")
    headed = F.get(groups, F.lit(0))["header"].isNotNull()
    def named(group: Column, header: Column) -> Column:
        full = F.concat(header, F.lit(f" {PATH_SEPARATOR} "), group["label"])
        return F.struct(
            F.when(headed, full).otherwise(group["label"]).alias("path"),
            group["openings"].alias("openings"),
        )

    def openings(group: Column, place: Column) -> Column:
        return F.transform(
            group["openings"],
            lambda o, row: F.struct(
                place.alias("_group"),
                row.alias("_row"),
                group["path"].alias("department_names"),
                *[o[c].alias(c) for c in _GROUPED[-4:]],
            ),
        )

    paths = F.zip_with(groups, carried(F.transform(groups, lambda g: g["header"])), named)
    rows = page_groups(pages).withColumn("_rows", F.flatten(F.transform(paths, openings)))
    return _exploded(rows, "_place", "grouped opening", ["_group", "_row"]).select(*_GROUPED)
