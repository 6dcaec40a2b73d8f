"""Lists to rows, rows to columns, rows to text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import NAME_SEPARATOR
from jobtide.functions import split_literal


def entries(df: DataFrame, array: Column | str, place: str, item: str, *keep: str) -> DataFrame:
    """One row per array entry with its 0-based place; rows without entries vanish.

    For a plain ``posexplode`` Spark adds a filter on the array's size and works the array out twice,
    parsing and Python functions included. The outer form is free of that.
    """
    exploded = df.select(*(keep or ["*"]), F.posexplode_outer(array).alias(place, item))
    return exploded.where(F.col(place).isNotNull())


def explode_list(
    df: DataFrame, col: str, separator: str, item: str, ordinal: str | None = None
) -> DataFrame:
    """One row per entry of a delimited text, with its 1-based place if asked for.

    Rows with NULL or empty text have no entries and vanish.
    """
    placed = entries(df, split_literal(F.col(col), separator), "_place", item)
    numbered = [] if ordinal is None else [(F.col("_place") + 1).cast("bigint").alias(ordinal)]
    return placed.select(*df.columns, item, *numbered)


def pivot_by_value(
    df: DataFrame, keys: list[str], category: str, value: str, levels: list, names: list[str]
) -> DataFrame:
    """Greatest value per key for each listed category, one column per category."""
    cells = [
        F.max(F.when(F.col(category) == level, F.col(value))).alias(name)
        for level, name in zip(levels, names, strict=True)
    ]
    return df.groupBy(*keys).agg(*cells)


def pivot_by_ordinal(
    df: DataFrame, keys: list[str], ordinal: str, value: str, names: list[str]
) -> DataFrame:
    """The same by place: 1 goes to the first name, 2 to the second, and so on."""
    return pivot_by_value(df, keys, ordinal, value, list(range(1, len(names) + 1)), names)


def _joined_names(col: str, order: str):
    return F.expr(f"listagg(`{col}`, '{NAME_SEPARATOR}') within group (order by `{order}`)")


def concat_children(
    df: DataFrame, keys: list[str], col: str, order: str, name: str
) -> DataFrame:
    """Children's names per parent as one text, in the given order; NULL names are skipped.

    A parent's names become one cell: reduce children to those that count before, so that a parent
    holds as many as it has distinct children.
    """
    return df.groupBy(*keys).agg(_joined_names(col, order).alias(name))


def concat_all_but_one(df: DataFrame, col: str, order: str) -> DataFrame:
    """Rows equal in every column but ``col`` become one, their ``col`` values joined as text."""
    keys = [c for c in df.columns if c not in (col, order)]
    return concat_children(df, keys, col, order, col).select(
        *[c for c in df.columns if c != order]
    )
