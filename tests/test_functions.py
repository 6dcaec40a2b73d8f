from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide import functions as C


@pytest.fixture
def value(spark):
    def get(column, **given):
        names = {k: F.lit(v).cast("string") if v is None else F.lit(v) for k, v in given.items()}
        frame = spark.range(1).select(*[c.alias(k) for k, c in names.items()] or ["id"])
        return frame.select(column).collect()[0][0]

    return get


def test_words_and_values(value):
    t = F.col("t")
    assert value(C.first_word(t), t="  Remote — x ") == "Remote"
    assert value(C.last_word(t), t="level  level-0 ") == "level-0"
    assert value(C.last_word(t), t="  ") is None
    assert value(C.first_value(F.array(F.lit(None), F.lit(""), t)), t="a") == "a"
    assert value(C.first_value(F.array(F.lit("").cast("string"))), t="a") is None
    assert value(C.blank_to_null(t), t="") is None
    assert value(C.default_group(t), t=None) == "No Dept"
    assert value(C.default_group(t), t="") == ""


@pytest.mark.parametrize(
    "text, parts",
    [("1", ["1"]), ("1,2,,3", ["1", "2", "", "3"]), ("", []), (None, None), ("a.b", ["a.b"])],
)
def test_split_literal(value, text, parts):
    assert value(C.split_literal(F.col("t"), ","), t=text) == parts


def test_split_literal_takes_the_separator_literally(value):
    assert value(C.split_literal(F.col("t"), "."), t="a.b") == ["a", "b"]


def test_links(value):
    s, link = F.col("s"), F.col("l")
    classic = "https://boards.greenhouse.io/acme"
    embed = "https://boards.greenhouse.io/embed/job_board?for=acme"
    newer = "https://job-boards.greenhouse.io/acme"
    assert value(C.full_link(s, link), s=classic, l="/acme/jobs/7") == classic + "/jobs/7"
    assert value(C.full_link(s, link), s=classic, l=None) == classic + "//"
    for source in (embed, newer):
        assert value(C.full_link(s, link), s=source, l="https://x/7") == "https://x/7"
    assert value(C.is_full_link(s), s=classic) is False
    assert value(C.board_company(s), s=embed) == "acme"
    assert value(C.board_company(s), s=newer + "?page=2") == "acme"
    assert value(C.page_company(s), s=embed) == "acme"
    assert value(C.page_company(s), s=classic + "?x=1") == "acme"
    assert value(C.token_company(s), s="https://jobs.ashbyhq.com/The%20Firm") == "The Firm"
    assert value(C.provider_of(s), s="https://jobs.lever.co/acme") == "lever"
    assert value(C.normalise_url(s), s=classic + "/") == classic
    assert value(C.normalise_url(s), s=classic + "//") == classic + "/"


def test_ids(value):
    a, b = F.col("a"), F.col("b")
    assert value(C.namespaced_id(a, b), a="lever", b=7) == "lever_7"
    assert value(C.namespaced_id(a, b), a="lever", b=None) == "lever_"
    assert value(C.namespaced_id(a, b, skip_null=False), a="lever", b=None) is None
    key = C.keyed_id(a, b)
    assert value(key, a=1, b=11) != value(key, a=11, b=1)
    assert len(value(key, a=None, b=1)) == 64


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_times_do_not_depend_on_the_session_zone(spark, value, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = C.epoch_to_utc(F.col("e"))
        assert value(at, e=1706659199) == datetime(2024, 1, 30, 23, 59, 59)
        assert value(C.day_of(at), e=1706659199) == date(2024, 1, 30)
        today = value(F.to_date(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())))
        assert value(C.is_active(F.col("d")), d=today) is True
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "location, flag",
    [("Remote", True), ("REMOTE - US", True), ("Berlin", False), (None, None)],
)
def test_is_remote(value, location, flag):
    assert value(C.is_remote(F.col("l")), l=location) is flag


@pytest.mark.parametrize(
    "span, bucket",
    [
        (1, "New"),
        (7, "New"),
        (8, "Recent"),
        (30, "Recent"),
        (31, "Medium"),
        (60, "Medium"),
        (61, "Old"),
        (90, "Old"),
        (91, "Stale"),
    ],
)
def test_length_bucket(value, span, bucket):
    label = C.length_bucket(F.col("a"), F.col("d"))
    assert value(label, a=True, d=span) == bucket
    assert value(label, a=False, d=span) == "Inactive"


def test_days_active(value):
    days = C.days_active(F.col("a"), F.col("b"))
    assert value(days, a=date(2024, 1, 1), b=date(2024, 1, 1)) == 1
    assert value(days, a=date(2023, 12, 31), b=date(2024, 1, 30)) == 31


@pytest.mark.parametrize(
    "primary, secondary, title, category",
    [
        ("Engineering", None, "Data Engineer", "Data"),
        ("Engineering", "Product", "Lead", "Software Engineering"),
        (None, "ANALYTICS", None, "Data"),
        ("GTM", None, "Senior Account Executive", "Sales"),
        ("GTM", None, "Account Executive, West", "Other"),
        ("Account Executive", None, "Lead", "Other"),
        (None, "Account Executive", None, "Other"),
        ("Account", None, "Executive", "Other"),
        ("Finance", "Operations", "Lead", "Finance & Accounting"),
        (None, None, "Business Operations", "Operations"),
        (None, "Product", "Lead", "Product"),
        (None, None, None, "Other"),
    ],
)
def test_categorise(value, primary, secondary, title, category):
    label = C.categorise(C.searchable([F.col("p"), F.col("s")], F.col("t")))
    assert value(label, p=primary, s=secondary, t=title) == category
    assert category in V.ACCEPTED["opening_category"]
