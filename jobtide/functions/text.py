"""Text helpers: first values and words, blanks, defaults, literal splits."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.fixed_values import NO_GROUP_LIST


def first_value(values: Column) -> Column:
    """First entry of an array that is neither NULL nor the empty string; NULL when there is none."""
    return F.get(F.filter(values, lambda v: v.isNotNull() & (v != "")), F.lit(0))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def first_word(text: Column) -> Column:
    return F.get(_words(text), F.lit(0))


def last_word(text: Column) -> Column:
    return F.try_element_at(_words(text), F.lit(-1))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def default_group(department_ids: Column) -> Column:
    return F.coalesce(department_ids, F.lit(NO_GROUP_LIST))


def split_literal(text: Column, separator: str) -> Column:
    r"""Split on a literal separator; empty text has no entries and NULL stays NULL.

    ``split`` takes a regular expression, hence the ``\Q..\E`` quotes.
    """
    parts = F.split(text, rf"\Q{separator}\E")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(parts)
