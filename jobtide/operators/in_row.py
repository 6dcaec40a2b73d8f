"""Grouping and carrying forward among the entries of an array, inside the row that holds it.

Time grows with the entries, or with sorting them; nothing is shuffled. An expression that is looked
up for each entry is named first (``_named``): Spark would work it out again for every look.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), use)[0]


def _places(entries: Column) -> Column:
    """0 to the number of entries less one, for an array that has some."""
    return F.sequence(F.lit(0), F.size(entries) - 1)


def _until_next(starts: Column, number: Column, entries: Column) -> Column:
    """How many entries there are from a start to the next one, or to the end."""
    return F.coalesce(F.get(starts, number + 1), F.size(entries)) - starts[number]


def grouped(entries: Column, key: Callable[[Column], Column]) -> Column:
    """The entries of an array as one array per key, keys as they first come, entries in their order."""

    def groups(placed: Column) -> Column:
        begins = F.filter(
            _places(placed),
            lambda i: ~F.equal_null(F.get(placed, i)["key"], F.get(placed, i - 1)["key"]) | (i == 0),
        )
        return _named(
            begins,
            lambda starts: F.transform(
                starts, lambda start, n: F.slice(placed, start + 1, _until_next(starts, n, placed))
            ),
        )

    keyed = F.transform(
        entries,
        lambda e, i: F.struct(key(e).alias("key"), i.alias("place"), e.alias("entry")),
    )
    found = F.transform(
        _named(F.sort_array(keyed), groups),
        lambda g: F.struct(g[0]["place"].alias("place"), F.transform(g, lambda x: x["entry"]).alias("entries")),
    )
    in_order = F.transform(F.sort_array(found), lambda g: g["entries"])
    return F.when(F.size(entries) > 0, in_order).when(entries.isNotNull(), F.array().cast("array<void>"))


def carried(values: Column) -> Column:
    """An array of texts with each NULL replaced by the last value before it."""

    def filled(given: Column) -> Column:
        shown = F.filter(_places(given), lambda i: F.get(given, i).isNotNull())

        def runs(starts: Column) -> Column:
            ahead = F.coalesce(F.get(starts, F.lit(0)), F.size(given))
            each = F.transform(
                starts, lambda start, n: F.array_repeat(F.get(given, start), _until_next(starts, n, given))
            )
            return F.concat(F.array_repeat(F.lit(None).cast("string"), ahead), F.flatten(each))

        return F.when(F.size(given) > 0, _named(shown, runs)).otherwise(given)

    return _named(values, filled)
