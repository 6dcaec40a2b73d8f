import random

import pytest
from pyspark.sql import functions as F

from jobtide.operators import aggregates, dedupe, in_row, joins, reshape, setops


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_seen_and_latest(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 20), (2, "a", 10), (3, "a", 10), (4, "b", None), (5, "b", 7), (6, None, 1)],
        "id long, k string, at long",
    )
    assert rows(dedupe.first_seen(df, ["k"], ["at", "id"]), "id") == [(2,), (5,), (6,)]
    assert rows(dedupe.latest(df, ["k"], ["at", "id"]), "id") == [(1,), (5,), (6,)]


def test_first_seen_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("k"))
    text = plan(dedupe.first_seen(df, ["k"], ["id"]))
    assert "WindowGroupLimit" in text.split("Exchange", 1)[1]


def test_first_seen_per_day_filters_records_first(spark, rows):
    df = spark.createDataFrame(
        [(1, "r1", "x", 1, 10), (2, "r1", "x", 2, 20), (3, "r2", "x", 1, 15), (4, "r3", "x", 2, 30)],
        "id long, record string, link string, day long, at long",
    )
    kept = dedupe.first_seen_per_day(df, "record", "link", "day", ["at", "id"])
    assert rows(kept, "id") == [(1,), (4,)]


def test_first_seen_two_keys_needs_both(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "r1", "d1", 10),  # first of both
            (2, "r2", "d1", 20),  # first record, second of its department
            (3, "r1", "d2", 30),  # first of its department, second record: d2 is lost
            (4, "r4", "d2", 40),
        ],
        "id long, record string, dep string, at long",
    )
    kept = dedupe.first_seen_two_keys(df, ["record"], ["dep"], ["at", "id"])
    assert rows(kept, "id") == [(1,)]


def filled(data):
    """Rows (part, place, h, row) with h filled one after the other."""
    at_place = {}
    for part, place, h, _ in data:
        if h is not None and place is not None:
            at_place[part, place] = max(h, at_place.get((part, place), h))
    out = []
    for part, place, h, row in data:
        if h is None and place is not None:
            earlier = [p for q, p in at_place if q == part and p <= place]
            h = at_place[part, max(earlier)] if earlier else None
        out.append((row, h))
    return sorted(out)


ORDERS = {
    "dense": lambda i, _: i,
    "microseconds": lambda i, _: 1_700_000_000_000_000 + i * 86_400_000_000,
    "one third alike": lambda i, rng: 50 if rng.random() < 0.3 else i,
    "few": lambda i, rng: rng.randrange(4),
    "extremes": lambda i, rng: rng.choice([-(2**63), 2**63 - 1, i, None]),
}


@pytest.mark.parametrize("kind", ORDERS)
def test_fill_forward_matches_brute_force(spark, rows, kind):
    rng = random.Random(7)
    data = []
    for part in ["hot"] * 300 + ["a"] * 40 + [None] * 25:
        i = len(data)
        data.append((part, ORDERS[kind](i, rng), rng.choice([None, None, None, f"h{i}"]), i))
    rng.shuffle(data)
    df = spark.createDataFrame(data, "part string, place long, h string, row long")
    for run_rows in (3, 20, 1000):
        got = dedupe.fill_forward(df, ["part"], "place", "h", run_rows=run_rows)
        assert got.columns == df.columns
        assert rows(got, "row", "h") == filled(data)


def test_runs_are_alike_for_dense_and_sparse_orders(spark):
    for order in ("id", "id * 3600000000", "id * id", "id % 10", "0", "cast(pow(1.9, id % 60) as long)"):
        df = spark.range(20_000).selectExpr(f"{order} AS _at", "xxhash64(id) AS _tie")
        found = df.select(dedupe._run(dedupe._bounds(df, 1000)).alias("run")).groupBy("run").count()
        counts = [r["count"] for r in found.collect()]
        assert len(counts) == 20 and max(counts) < 1500 and min(counts) > 600, order


def test_fill_forward_shuffles_a_repeated_value_once_a_task(spark):
    df = spark.range(0, 40_000, 1, 4).selectExpr("'p' AS part", "if(id % 100 < 99, 5, id) AS place", "if(id % 100 < 99, 'h', NULL) AS h")
    got = dedupe.fill_forward(df, ["part"], "place", "h", run_rows=100)
    assert max(shuffled_rows(got)) < 3000
    assert dedupe.fill_forward(df.where("false"), ["part"], "place", "h").count() == 0


def test_entries_are_grouped_and_carried_within_the_row(spark, rows):
    rng = random.Random(3)
    lists = [None, [], [None], ["x"], [None, "a", None, "a", "b", None], *[rng.choices([None, "a", "b", "c"], k=40) for _ in range(20)]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "id int, v array<string>")
    pairs = df.withColumn("v", F.transform("v", lambda e, i: F.struct(e.alias("e"), i.alias("i"))))
    groups = {r["id"]: r["g"] for r in pairs.select("id", in_row.grouped(F.col("v"), lambda e: F.struct(e["e"])).alias("g")).collect()}
    carried = {r["id"]: r["c"] for r in df.select("id", in_row.carried(F.col("v")).alias("c")).collect()}
    for i, values in enumerate(lists):
        expected, last, filled_ = {}, None, []
        for place, value in enumerate(values or []):
            expected.setdefault(value, []).append((value, place))
            last = last if value is None else value
            filled_.append(last)
        assert (groups[i] and [[tuple(e) for e in g] for g in groups[i]]) == (None if values is None else list(expected.values()))
        assert carried[i] == (None if values is None else filled_)


def test_first_daily(spark, rows):
    df = spark.createDataFrame(
        [("b", "x", 1), ("a", "x", 1), ("c", "x", 2), ("d", "y", 1)], "id string, link string, day long"
    )
    assert rows(dedupe.first_daily(df, "link", "day", "id"), "id") == [("a",), ("c",), ("d",)]


def test_explode_list(spark, rows):
    df = spark.createDataFrame(
        [(1, "7"), (2, "7,8"), (3, None), (4, ""), (5, "7,,9")], "id long, l string"
    )
    got = reshape.explode_list(df, "l", ",", "e", "n")
    assert rows(got, "id", "e", "n") == [
        (1, "7", 1),
        (2, "7", 1),
        (2, "8", 2),
        (5, "", 2),
        (5, "7", 1),
        (5, "9", 3),
    ]
    assert reshape.explode_list(df, "l", ",", "e").columns == ["id", "l", "e"]


def test_pivots(spark, rows):
    df = spark.createDataFrame(
        [(1, "x", "b"), (1, "x", "c"), (1, "y", None), (2, "z", "a")], "id long, cat string, val string"
    )
    assert rows(reshape.pivot_by_value(df, ["id"], "cat", "val", ["x", "y"], ["p", "q"])) == [
        (1, "c", None),
        (2, None, None),
    ]
    placed = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 5, "e")], "id long, n long, v string")
    assert rows(reshape.pivot_by_ordinal(placed, ["id"], "n", "v", ["p", "q", "r", "s"])) == [
        (1, "a", "b", None, None)
    ]


def test_concats(spark, rows):
    df = spark.createDataFrame(
        [(3, "j1", "C"), (1, "j1", "A"), (2, "j1", None), (4, "j2", None), (5, None, "N")],
        "n long, job string, place string",
    )
    assert rows(reshape.concat_children(df, ["job"], "place", "n", "all"), "job", "all") == [
        (None, "N"),
        ("j1", "A, C"),
        ("j2", None),
    ]
    merged = reshape.concat_all_but_one(df, "place", "n")
    assert merged.columns == ["job", "place"]
    assert merged.count() == 3


def test_hierarchy_path(spark, rows):
    teams = spark.createDataFrame(
        [
            (1, "root", "Root", None, 10),
            (2, "mid", "Mid old", "root", 10),
            (3, "mid", "Mid", "root", 20),
            (4, "leaf", "Leaf", "mid", 10),
            (5, "lost", "Lost", "gone", 10),
        ],
        "id long, department_id string, department_name string, parent_department_id string, at long",
    )
    items = spark.createDataFrame(
        [(1, "root"), (2, "mid"), (3, "leaf"), (4, "lost"), (5, "nope"), (6, None)],
        "item long, department_id string",
    )
    got = joins.hierarchy_path(items, teams, ["at", "id"])
    assert rows(got, "item", "primary_department", "secondary_department") == [
        (1, "Root", None),
        (2, "Root", "Mid"),
        (3, "Mid", "Leaf"),
        (4, "Lost", None),
        (5, None, None),
        (6, None, None),
    ]


def test_attach_children(spark, rows):
    parents = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "k long, own string")
    children = spark.createDataFrame([(1, "X, Y"), (3, "Z")], "k long, extra string")
    got = joins.attach_children(parents, children, ["k"], "own", "extra", "all")
    assert rows(got, "k", "all") == [(1, "A, X, Y"), (2, "B"), (3, ", Z")]


def test_with_lifespan_drops_missing_keys(spark, rows):
    df = spark.createDataFrame([("x", 1), ("x", 5), ("y", 2), (None, 3)], "link string, day long")
    got = joins.with_lifespan(df, "link", "day")
    assert rows(got, "link", "day", "earliest_opening_date", "latest_opening_date") == [
        ("x", 1, 1, 5),
        ("x", 5, 1, 5),
        ("y", 2, 2, 2),
    ]


def test_boards_match_without_trailing_slash(spark, rows):
    posts = spark.createDataFrame([(1, "u/a"), (2, "u/b/"), (3, "u/c")], "n long, source string")
    boards = spark.createDataFrame(
        [(1, "u/a/", True), (2, "u/a", True), (3, "u/b", False)], "id long, url string, ok boolean"
    )
    assert rows(joins.join_boards(posts, boards), "n", "board_id") == [(1, 1), (1, 2), (2, 3)]
    assert rows(joins.on_boards(posts, boards, F.col("ok")), "n") == [(1,)]


def test_mismatches(spark, rows):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "k string, n long")
    b = spark.createDataFrame([("x", 1), ("y", 5), ("w", 3)], "k string, m long")
    assert rows(joins.count_mismatch(a, b, ["k"], "n", "m")) == [("y", 2, 5)]
    assert rows(joins.value_mismatch(a, b, "k", "n", "m")) == [("y", 2, 5)]
    renamed = b.select(F.col("k").alias("j"))
    assert rows(joins.unmatched_both(a, renamed, "k", "j")) == [(None, "w"), ("z", None)]


def test_counts_and_unions(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None)], "k string, v long")
    assert rows(aggregates.count_by(df, ["k"], "n")) == [("a", 3), ("b", 1)]
    assert rows(aggregates.distinct_count_by(df, ["k"], "v", "n")) == [("a", 2), ("b", 0)]
    assert rows(aggregates.distinct_rows(df, ["k"])) == [("a",), ("b",)]
    both = setops.union_counts(x=df, y=df.select("v", "k"))
    assert both.where("job_board = 'y' and k = 'a'").count() == 3


def test_union_postings_goes_by_name(spark):
    from jobtide.schemas import UNIFIED, UNIFIED_COLUMNS

    one = spark.createDataFrame([tuple([None] * len(UNIFIED))], UNIFIED)
    other = one.select(*reversed(UNIFIED_COLUMNS)).withColumn("id", F.lit("second"))
    union = setops.union_postings(one, other)
    assert union.columns == UNIFIED_COLUMNS
    assert {r.id for r in union.collect()} == {None, "second"}


def test_combine_on_id(spark, rows):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    b = spark.createDataFrame([(2, "c"), (3, "d")], "id long, y string")
    assert rows(joins.combine_on_id(a, b)) == [(2, "b", "c")]


def shuffled_rows(df):
    """Rows written to each shuffle of a finished query, with adaptive execution on."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture
def hot(spark):
    """10,000 rows of which nine in ten share a key."""
    key = F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id"))
    return spark.range(10_000).select("id", key.alias("k"), (F.col("id") % 50).alias("v"))


def test_first_seen_shuffles_one_row_per_key_and_task(hot):
    kept = dedupe.first_seen(hot, ["k"], ["id"])
    assert sum(shuffled_rows(kept)) <= 1001 + 8


def test_two_keys_shuffle_only_the_winners(hot):
    kept = dedupe.first_seen_two_keys(hot, ["k"], ["v"], ["id"])
    written = shuffled_rows(kept)
    assert max(written) <= 1001 + 8


def test_grouped_counts_shuffle_one_row_per_key_and_task(hot):
    assert sum(shuffled_rows(aggregates.lifespan(hot, "k", "v"))) <= 1001 + 8
    assert max(shuffled_rows(aggregates.distinct_count_by(hot, ["k"], "v", "n"))) <= 1000 + 8 * 50


@pytest.fixture
def skew_splitting(spark):
    """Thresholds low enough for small data, and no broadcast."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in low.items():
        spark.conf.set(name, value)
    yield
    for name in low:
        spark.conf.unset(name)


@pytest.fixture
def hot_links(spark):
    link = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5000).cast("string"))
    return spark.range(0, 60_000, 1, 6).select(
        "id", link.alias("link"), (F.col("id") % 77).alias("day"), F.sha2(F.hex("id"), 256).alias("rest")
    )


def test_joins_with_a_grouped_side_split_hot_keys(skew_splitting, hot_links):
    spanned = joins.with_lifespan(hot_links, "link", "day")
    assert len(spanned.collect()) == 60_000
    assert "skew=true" in plan(spanned)
    counted = aggregates.count_by(hot_links, ["link"], "n")
    looked_up = joins.left_lookup(hot_links, counted, ["link"])
    assert looked_up.where("link = 'hot' and n = 20000").count() == 20_000
    looked_up.collect()
    assert "skew=true" in plan(looked_up)


def test_board_and_team_joins_split_hot_keys(spark, skew_splitting, hot_links):
    boards = spark.createDataFrame([(1, "hot/", True), (2, "7", True)], "id long, url string, ok boolean")
    kept = joins.on_boards(hot_links, boards, F.col("ok"), "link")
    assert len(kept.collect()) == 20_000 + 8
    assert "skew=true" in plan(kept)
    teams = hot_links.where("id < 4000").selectExpr(
        "id", "day AS at", "link AS department_id", "rest AS department_name", "'hot' AS parent_department_id"
    )
    items = hot_links.withColumnRenamed("link", "department_id")
    placed = joins.hierarchy_path(items, teams, ["at", "id"])
    assert len(placed.collect()) == 60_000
    assert "skew=true" in plan(placed)
