"""Equi-joins. None is forced to broadcast: Spark does so by itself below its size threshold and
otherwise sort-merges, where adaptive execution splits hot keys of the larger side.

That splitting needs both sides to come straight from a shuffle made for the join. A side grouped by
the join keys is not shuffled again, and a hot key of the other side then ends up in one task. So
where one side is grouped, ``_splittable_join`` adds a hash of the keys as one more key, which the
grouping does not cover.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import NAME_SEPARATOR
from jobtide.functions import normalise_url, skipping_concat
from jobtide.operators.aggregates import lifespan
from jobtide.operators.dedupe import latest


def _splittable_join(
    detail: DataFrame, grouped: DataFrame, keys: list[str], how: str
) -> DataFrame:
    hashed = F.xxhash64(*keys)
    left, right = detail.withColumn("_hash", hashed), grouped.withColumn("_hash", hashed)
    return left.join(right, [*keys, "_hash"], how).drop("_hash")


def left_lookup(detail: DataFrame, dims: DataFrame, keys: list[str]) -> DataFrame:
    """Detail rows with the matching dimension columns, NULL where nothing matches."""
    return _splittable_join(detail, dims, keys, "left")


def team_paths(
    teams: DataFrame, order: list[str], row_id: str = "department_id"
) -> DataFrame:
    """Latest name per team, placed under its parent: parent first when it is known, else alone.

    The adjacency list is resolved among the teams, so postings need a single join afterwards.
    """
    names = latest(teams.where(F.col(row_id).isNotNull()), [row_id], order)
    own = names.select(row_id, "parent_department_id", F.col("department_name").alias("own_name"))
    parent = names.select(
        F.col(row_id).alias("parent_department_id"), F.col("department_name").alias("parent_name")
    )
    placed = own.join(parent, "parent_department_id", "left")
    return placed.select(
        row_id,
        F.coalesce("parent_name", "own_name").alias("primary_department"),
        F.when(F.col("parent_name").isNotNull(), F.col("own_name")).alias("secondary_department"),
    )


def hierarchy_path(items: DataFrame, teams: DataFrame, order: list[str]) -> DataFrame:
    """Items with the two-level path of their team."""
    return left_lookup(items, team_paths(teams, order), ["department_id"])


def attach_children(
    parents: DataFrame, children: DataFrame, keys: list[str], own: str, extra: str, name: str
) -> DataFrame:
    """Parents' own text followed by their children's, or alone when they have none."""
    both = skipping_concat(F.col(own), F.lit(NAME_SEPARATOR), F.col(extra))
    joined = left_lookup(parents, children, keys)
    return joined.withColumn(name, F.when(F.col(extra).isNull(), F.col(own)).otherwise(both))


def with_group_values(detail: DataFrame, grouped: DataFrame, key: str) -> DataFrame:
    """Detail rows with the values of their group."""
    return _splittable_join(detail, grouped, [key], "inner")


def combine_on_id(first: DataFrame, *others: DataFrame, key: str = "id") -> DataFrame:
    """Frames side by side, for the ids that all of them have."""
    combined = first
    for other in others:
        combined = combined.join(other, key, "inner")
    return combined


def with_lifespan(df: DataFrame, key: str, day: str) -> DataFrame:
    """Rows with first and last day of their key; rows without a key drop out.

    Grouping and joining rather than a window: partial min/max shrinks a hot key before the
    shuffle and the join can split it. The input is read twice, so pass a stored table.
    """
    keyed = df.where(F.col(key).isNotNull())
    return with_group_values(keyed, lifespan(keyed, key, day), key)


def join_boards(df: DataFrame, boards: DataFrame, source: str = "source") -> DataFrame:
    """Rows with the columns of their board, matched on the URL without its trailing slash."""
    dims = boards.select(
        normalise_url(F.col("url")).alias("_board_url"),
        *[F.col(c).alias(f"board_{c}") for c in boards.columns],
    )
    return df.join(dims, normalise_url(df[source]) == dims["_board_url"]).drop("_board_url")


def on_boards(
    df: DataFrame, boards: DataFrame, wanted: Column, source: str = "source"
) -> DataFrame:
    """Rows whose board satisfies a condition on the board columns."""
    urls = boards.where(wanted).select(normalise_url(F.col("url")).alias("_board_url"))
    return df.join(urls, normalise_url(df[source]) == urls["_board_url"], "left_semi")


def unmatched_both(expected: DataFrame, actual: DataFrame, left: str, right: str) -> DataFrame:
    """Values present on one side only; the other side's column is NULL."""
    joined = expected.select(left).join(
        actual.select(right), expected[left] == actual[right], "full_outer"
    )
    return joined.where(F.col(left).isNull() | F.col(right).isNull())


def count_mismatch(
    a: DataFrame, b: DataFrame, keys: list[str], count_a: str, count_b: str
) -> DataFrame:
    """Groups present on both sides whose counts differ."""
    return a.join(b, keys, "inner").where(F.col(count_a) != F.col(count_b))


def value_mismatch(a: DataFrame, b: DataFrame, key: str, col: str, expected: str) -> DataFrame:
    """Rows of ``a`` whose value differs from the expected one for their key."""
    return a.join(b, key, "inner").where(F.col(col) != F.col(expected))
