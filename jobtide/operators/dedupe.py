"""First, latest and carried-forward rows per key.

Top-1 per key is ``row_number`` with a filter right on it: Spark then limits each group to one row
inside every map task, so even a key holding a third of the table sends one row per task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANK = "_rank"
_HASH = "_hash"


def _ordered(order: list[str], descending: bool = False) -> list[Column]:
    return [F.desc_nulls_last(c) if descending else F.asc_nulls_last(c) for c in order]


def _top_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key. A hash of the keys leads them: sorting compares it first, and keys such as
    URLs, which all begin alike, seldom have to be compared themselves."""
    group = W.partitionBy(_HASH, *keys).orderBy(*order)
    ranked = df.withColumn(_HASH, F.xxhash64(*keys)).withColumn(_RANK, F.row_number().over(group))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK, _HASH)


def first_seen(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The earliest row per key; end ``order`` with a unique column to settle ties."""
    return _top_one(df, keys, _ordered(order))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row per key with the greatest first order column; later ones break ties upwards.

    A row without a time never wins over one that has a time.
    """
    newest, *ties = order
    return _top_one(df, keys, _ordered([newest], descending=True) + _ordered(ties))


def first_seen_per_day(
    df: DataFrame, record: str, link: str, day: str, order: list[str]
) -> DataFrame:
    """First sighting per record, and of those the first per link and day."""
    return first_seen(first_seen(df, [record], order), [link, day], order)


def first_seen_two_keys(
    df: DataFrame, keys_a: list[str], keys_b: list[str], order: list[str], row_id: str = "id"
) -> DataFrame:
    """Rows that come first within both groupings of the same input.

    Two windows side by side would shuffle whole hot groups. Each grouping is reduced on its own
    instead, the second one to narrow rows, and the winners meet on the unique row id.
    """
    narrow = df.select(*dict.fromkeys([*keys_b, *order, row_id]))
    winners_b = first_seen(narrow, keys_b, order).select(row_id)
    return first_seen(df, keys_a, order).join(winners_b, row_id, "left_semi")


def first_daily(df: DataFrame, link: str, day: str, row_id: str) -> DataFrame:
    """One row per link and day, the one with the smallest id."""
    return first_seen(df, [link, day], [row_id])


#: Rows in a run of ``fill_forward``, most runs, rows sampled for each, and runs in a block of runs.
RUN_ROWS, MOST_RUNS, SAMPLED, BLOCK_RUNS = 1_000_000, 4096, 64, 256

_FIRST, _LAST = -(1 << 63), (1 << 63) - 1


def _bounds(places: DataFrame, run_rows: int) -> list[tuple[int, int]]:
    """Places (``_at``, ``_tie``) at which runs end, so that each has about so many rows: quantiles of
    a sample of bounded size. None where all rows fit into one run."""
    rows = places.count()
    if rows <= run_rows:
        return []
    runs = min(MOST_RUNS, -(-rows // run_rows))
    drawn = places.sample(fraction=min(1.0, runs * SAMPLED / rows), seed=7).collect()
    sample = sorted((r["_at"], r["_tie"]) for r in drawn)
    return sorted({sample[len(sample) * i // runs] for i in range(1, runs)} if sample else ())


def _run(bounds: list[tuple[int, int]]) -> Column:
    """Number of the run that holds a place: how many bounds are before it, by halving."""
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    filled = [*bounds, *[(_LAST, _LAST)] * (2 * steps[0] - 1 - len(bounds))] if steps else []

    def listed(numbers: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")

    if not steps:
        return F.lit(0)
    at, tie = (listed([bound[i] for bound in filled]) for i in (0, 1))

    def further(place: Column, step: Column) -> Column:
        last = place + step - 1
        same = (F.get(at, last) == F.col("_at")) & (F.get(tie, last) < F.col("_tie"))
        return place + F.when((F.get(at, last) < F.col("_at")) | same, step).otherwise(0)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)


def _entering(ends: DataFrame) -> DataFrame:
    """For each run (``_part``, ``_run``) the last value of the runs before it, from their own last
    values (``_end``). Runs are reduced in blocks first, so no task sees all runs of a part."""
    blocked = ends.withColumn("_block", F.floor(F.col("_run") / BLOCK_RUNS))
    value = F.when(F.col("_end").isNotNull(), F.col("_run"))
    blocks = blocked.groupBy("_part", "_block").agg(F.max_by("_end", value).alias("_block_end"))
    before = W.partitionBy("_part").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select(
        "_part", "_block", F.last("_block_end", ignorenulls=True).over(before).alias("_carried")
    )
    earlier = W.partitionBy("_part", "_block").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    inside = blocked.withColumn("_inside", F.last("_end", ignorenulls=True).over(earlier))
    return inside.join(carried, ["_part", "_block"]).select(
        "_part", "_run", F.coalesce("_inside", "_carried").alias("_entering")
    )


def fill_forward(
    df: DataFrame, part: list[str], order: str, col: str, run_rows: int = RUN_ROWS
) -> DataFrame:
    """Replace NULLs in ``col`` by the last value before them, per ``part`` in ``order``.

    ``order`` is a whole number. Where rows share one, a NULL takes the greatest value there, if
    there is any; rows without one stay as they are. Parts may be NULL.

    Values are first reduced to one per part and order, so however many rows repeat one, it is
    shuffled once a task. Only rows with a NULL are shuffled: their parts are cut into runs of about
    ``run_rows`` rows at sampled quantiles of the order, and of a hash where very many rows share one
    order; a run is filled on its own, and what enters it from the runs before comes from one
    summary row per run. So neither a hot part, nor a sparse or dense order makes a task long.
    """
    known, placed = F.col(col).isNotNull(), F.col(order).isNotNull()
    place = {"_part": F.struct(*part), "_at": F.col(order).cast("bigint")}
    gaps = df.where(~known & placed).withColumns({**place, "_tie": F.xxhash64(*df.columns)})
    values = df.where(known & placed).select(*[c.alias(n) for n, c in place.items()], F.col(col).alias("_value"))
    values = values.groupBy("_part", "_at").agg(F.max("_value").alias("_value")).withColumn("_tie", F.lit(_FIRST))
    bounds = _bounds(df.where(placed).select(place["_at"].alias("_at"), F.when(known, _FIRST).otherwise(F.xxhash64(*df.columns)).alias("_tie")), run_rows)

    wide = gaps.select("_part", "_at", "_tie", F.struct(*df.columns).alias("_row"))
    rows = wide.unionByName(values, allowMissingColumns=True).withColumn("_run", _run(bounds))
    so_far = W.partitionBy("_part", "_run").orderBy("_at", "_tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = rows.withColumn("_value", F.last("_value", ignorenulls=True).over(so_far)).where(F.col("_row").isNotNull())
    if bounds:
        narrow = gaps.select("_part", "_at", "_tie").unionByName(values, allowMissingColumns=True).withColumn("_run", _run(bounds))
        ends = narrow.groupBy("_part", "_run").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_at"))).alias("_end"))
        filled = filled.join(_entering(ends), ["_part", "_run"], "left").withColumn("_value", F.coalesce("_value", "_entering"))
    told = filled.select(*[F.col("_value" if c == col else f"_row.{c}").alias(c) for c in df.columns])
    return df.where(known | ~placed).unionByName(told)
