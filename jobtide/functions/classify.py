"""Flags, buckets and categories of a posting."""

from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide import fixed_values as V


def is_remote(location: Column) -> Column:
    """Does the location mention remote work? NULL stays NULL."""
    return F.lower(location).contains("remote")


def is_active(created_date: Column, as_of: date | None = None) -> Column:
    """Seen on the given day; by default on the current UTC day."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return created_date == (F.lit(as_of) if as_of else F.to_date(now))


def days_active(earliest: Column, latest: Column) -> Column:
    return F.datediff(latest, earliest).cast("bigint") + 1


def length_bucket(active: Column, days: Column, buckets=V.LENGTH_BUCKETS) -> Column:
    """Bucket by days open; anything not active is one bucket of its own."""
    branch = F.when(~active, V.LENGTH_INACTIVE)
    for more_than, label in buckets:
        branch = branch.when(days > more_than, label)
    return branch.otherwise(V.LENGTH_SHORTEST)


def searchable(departments: list[Column], title: Column) -> Column:
    """Departments and title in lower case, a line each and the title last, to look words up in.

    A frame should hold this as a column, so that it is worked out once per row.
    """
    return F.lower(F.concat_ws("\n", *departments, F.coalesce(title, F.lit(""))))


def categorise(text: Column, rules=V.CATEGORY_RULES) -> Column:
    """First rule with one of its words in a ``searchable`` text, or an ending at its end."""
    branch = F
    for category, words, endings in rules:
        hits = [text.contains(word) for word in words]
        hits += [text.endswith(ending) for ending in endings]
        branch = branch.when(reduce(Column.__or__, hits), category)
    return branch.otherwise(V.CATEGORY_DEFAULT)
