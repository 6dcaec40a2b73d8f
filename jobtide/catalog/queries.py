"""One query per operator and dataset; each takes (spark, sf_dir) and returns a DataFrame."""

from datetime import datetime
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide import functions as C
from jobtide.operators import aggregates, dedupe, joins, reshape, setops
from jobtide.plans import build, ingest, marts, retention, side_by_side, staging, unify
from jobtide.quality import checks, declared
from jobtide.schemas import LOADED_AT, MART_COLUMNS, RAW
from jobtide.sinks import storage
from jobtide.sinks.scratch import shared_folder, stored
from jobtide.sources import event_boards as E
from jobtide.sources import event_pages as P
from jobtide.sources import html_boards, json_boards, runs, tables

AS_OF_TIME = datetime(2024, 1, 30, 12)
CUTOFF = storage.cutoff_day(E.AS_OF)
QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid4().hex}"


def _staged(spark, sf, name) -> DataFrame:
    raw, stage = marts.STAGED[name]
    return stage(E.TABLES[raw](spark, sf))


def _unify(spark, sf, name) -> DataFrame:
    sources, unify_provider = marts.UNIFIED[name]
    return unify_provider(*[_staged(spark, sf, source) for source in sources])


def _unified(spark, sf) -> DataFrame:
    return setops.union_postings(*[_unify(spark, sf, name) for name in marts.UNIFIED])


def _mart(spark, sf) -> DataFrame:
    return marts.all_postings(stored(_unified(spark, sf), "unified"), E.AS_OF)


# A: sources, extraction, sinks


def _whole_rows(df, name) -> DataFrame:
    """A table's rows with all their values as one text."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(df.columns)]
    return df.select(F.lit(name).alias("table_name"), "id", F.concat_ws("|", *values).alias("row_text"))


@query
def typed_scan(spark, sf):
    path, frames = _folder(spark), []
    for name, make in E.TABLES.items():
        make(spark, sf).write.parquet(f"{path}/{name}")
        frames.append(_whole_rows(tables.read_raw(spark, path, name), name))
    return setops.union_all(*frames)


@query
def page_links(spark, sf):
    return html_boards.page_links(E.table(spark, sf, "pages"))


@query
def extract_departments(spark, sf):
    return html_boards.extract_departments(P.classic_department_pages(spark, sf))


@query
def extract_openings(spark, sf):
    return html_boards.extract_openings(P.classic_opening_pages(spark, sf))


@query
def extract_paged(spark, sf):
    return html_boards.extract_paged_openings(P.paged_pages(spark, sf))


@query
def extract_paged_departments(spark, sf):
    return html_boards.extract_paged_departments(P.paged_pages(spark, sf))


@query
def extract_grouped(spark, sf):
    return html_boards.extract_grouped(P.grouped_pages(spark, sf))


@query
def decode_props(spark, sf):
    props = F.from_json("props", "k BIGINT")
    return E.table(spark, sf, "events").select("event_id", props["k"].alias("k"))


@query
def decode_postings(spark, sf):
    return json_boards.decode_postings(P.nested_responses(spark, sf))


@query
def decode_locations(spark, sf):
    return json_boards.decode_locations(P.nested_responses(spark, sf))


@query
def decode_teams(spark, sf):
    return json_boards.decode_teams(P.nested_responses(spark, sf))


@query
def decode_flat_board(spark, sf):
    return json_boards.decode_flat_board(P.flat_responses(spark, sf))


@query
def reject_split(spark, sf):
    good, rejected = json_boards.split_valid(P.damaged_responses(spark, sf))
    accepted = good.withColumn("reason", F.lit(None).cast("string"))
    return accepted.unionByName(rejected).drop("body")


@query
def reject_split_flat(spark, sf):
    good, rejected = json_boards.split_valid_flat(P.damaged_flat_responses(spark, sf))
    accepted = good.withColumn("reason", F.lit(None).cast("string"))
    return accepted.unionByName(rejected).drop("body")


@query
def stamp_run(spark, sf):
    events = E.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    user = F.col("user_id")
    return runs.stamp_run(
        events,
        F.lit(E.AS_OF_EPOCH).cast("bigint"),
        F.lit("2024-01-30"),
        F.concat(F.lit("company"), (user % 20).cast("string")),
        F.concat(F.lit("https://jobs.lever.co/company"), (user % 20).cast("string")),
    )


@query
def first_and_last_words(spark, sf):
    text = F.col("text")
    return E.table(spark, sf, "documents").select(
        "doc_id",
        C.first_word(text).alias("first_word"),
        C.last_word(text).alias("last_word"),
        C.first_value(F.split("text", "\n")).alias("first_line"),
    )


@query
def append_runs(spark, sf):
    """Two runs of each table appended to files of two formats and read back, tables and formats side by side."""
    path = _folder(spark)

    def appended(name, fmt):
        raw = E.TABLES[name](spark, sf)
        this_year = F.col("run_id") >= "2024-01-01"
        for run in (raw.where(~this_year), raw.where(this_year)):
            storage.append_raw(run, f"{path}/{fmt}/{name}", fmt)
        back = tables.read_raw(spark, f"{path}/{fmt}", name, fmt)
        return _whole_rows(back, name).withColumn("stored_as", F.lit(fmt))

    places = [(name, fmt) for name in LOADED_AT for fmt in ("parquet", "json")]
    return setops.union_all(*side_by_side({place: partial(appended, *place) for place in places}).values())


@query
def landed_in_parts(spark, sf):
    """Each table landed in two parts, each of them twice, and read back."""
    path = _folder(spark)

    def landed(name):
        raw = E.TABLES[name](spark, sf)
        odd = F.col("id") % 2 == 1
        for label, part in {"even": raw.where(~odd), "odd": raw.where(odd)}.items():
            for _ in range(2):
                storage.append_raw(part, f"{path}/{name}", landing=label)
        return _whole_rows(tables.read_raw(spark, path, name), name)

    return setops.union_all(*_each_table(landed))


def _each_table(job) -> list[DataFrame]:
    return list(side_by_side({name: lambda name=name: job(name) for name in LOADED_AT}).values())


def _by_load_time(spark, sf, pick):
    """Rows of each raw table, laid out by load day, that are picked from it in place."""
    path = _folder(spark)

    def picked(name):
        storage.append_raw(E.TABLES[name](spark, sf), f"{path}/{name}")
        return pick(path, name).select(F.lit(name).alias("table_name"), "id")

    return setops.union_all(*_each_table(picked))


def _archive(spark, path, name):
    return storage.archive(spark, path, name, CUTOFF, f"{path}/archive", E.AS_OF)


def _drop(spark, path, name):
    return storage.drop_days(spark, path, name, CUTOFF, f"{path}/archive")


@query
def archive_roundtrip(spark, sf):
    def archived(path, name):
        _archive(spark, path, name)
        return storage.read_archive(spark, f"{path}/archive", name)

    return _by_load_time(spark, sf, archived)


@query
def retained_rows(spark, sf):
    def kept(path, name):
        _archive(spark, path, name)
        _drop(spark, path, name)
        return tables.read_raw(spark, path, name)

    return _by_load_time(spark, sf, kept)


def _late(spark, sf, path, name):
    """Half of a table's rows archived; then the other half, of the same days, lands."""
    raw, late = E.TABLES[name](spark, sf), F.col("id") % 2 == 1
    storage.append_raw(raw.where(~late), f"{path}/{name}")
    _archive(spark, path, name)
    storage.append_raw(raw.where(late), f"{path}/{name}")
    _drop(spark, path, name)


@query
def late_rows(spark, sf):
    """What is left of each table when rows of old days landed between the archive and the drop."""
    path = _folder(spark)

    def left(name):
        _late(spark, sf, path, name)
        return tables.read_raw(spark, path, name).select(F.lit(name).alias("table_name"), "id")

    return setops.union_all(*_each_table(left))


@query
def archive_repeated(spark, sf):
    """Archive and table after late rows, and after the daily job ran two times more."""
    path = _folder(spark)

    def landed(name):
        _late(spark, sf, path, name)

    _each_table(landed)
    for _ in range(2):
        retention.retain(spark, path, f"{path}/archive", AS_OF_TIME)
    frames = []
    for name in LOADED_AT:
        places = {"archive": storage.read_archive(spark, f"{path}/archive", name), "table": tables.read_raw(spark, path, name)}
        frames += [df.select(F.lit(name).alias("table_name"), "id", F.lit(place).alias("place")) for place, df in places.items()]
    return setops.union_all(*frames)


@query
def published_layers(spark, sf):
    marts_built = build.build(E.raw_tables(spark, sf), _folder(spark), E.AS_OF)
    tagged = [df.withColumn("mart", F.lit(name)) for name, df in marts_built.items()]
    return setops.union_all(*tagged)


@query
def landed_rows(spark, sf):
    """All pages and responses, sound and damaged, landed and read back: the rows of the seven raw
    tables without the ids that the landing gave out, and what was rejected."""
    path = _folder(spark)
    rows = ingest.all_rows(
        P.all_pages(spark, sf), P.damaged_responses(spark, sf), P.damaged_flat_responses(spark, sf)
    )
    ingest.land(rows, path, "all", AS_OF_TIME)
    frames = []
    for name in LOADED_AT:
        back = tables.read_raw(spark, path, name)
        shown = [c for c in ("record_id", "job_id", "run_id", "created_at", "updated_at", "raw_file", "existing_used") if c in back.columns]
        values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in shown]
        frames.append(back.select(F.lit(name).alias("table_name"), F.concat_ws("|", *values).alias("row_text")))
    bad = ingest.read_rejected(spark, path)
    values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in ingest.REJECTED]
    frames.append(bad.select(F.lit("rejected").alias("table_name"), F.concat_ws("|", *values).alias("row_text")))
    return setops.union_all(*frames)


# B: projections, filters, derived columns


@query
def epoch_dates(spark, sf):
    at = C.epoch_to_utc(F.col("updated_at"))
    return E.lever_openings(spark, sf, None).select(
        "id", at.alias("updated_at_utc"), C.day_of(at).alias("updated_date_utc")
    )


@query
def link_parts(spark, sf):
    source, link = F.col("source"), F.col("opening_link")
    return E.greenhouse_openings(spark, sf, None).select(
        "id",
        C.provider_of(source).alias("provider"),
        C.is_full_link(source).alias("is_full_link"),
        C.full_link(source, link).alias("full_opening_link"),
        C.board_company(source).alias("company_name"),
        C.page_company(source).alias("page_company"),
        C.normalise_url(F.concat(source, F.lit("/"))).alias("board_url"),
        C.namespaced_id(C.provider_of(source), F.col("id")).alias("public_id"),
        C.namespaced_id(F.col("department_ids"), F.col("id"), skip_null=False).alias("strict_id"),
    )


@query
def token_companies(spark, sf):
    source = F.col("board_source")
    return E.ashby_openings(spark, sf, None).select(
        "id",
        C.token_company(source).alias("company_name"),
        C.skipping_concat(source, F.lit("/"), F.col("opening_id")).alias("opening_link"),
    )


@query
def defaults_and_blanks(spark, sf):
    ids = F.col("department_ids")
    return E.greenhouse_openings(spark, sf, None).select(
        "id",
        C.default_group(ids).alias("department_ids"),
        C.blank_to_null(ids).alias("listed_ids"),
        F.when(C.default_group(ids) == V.NO_GROUP_LIST, V.NO_GROUP_NAME).alias("shown_as"),
        F.col("existing_used").cast("string").cast("boolean").alias("uses_existing"),
    )


@query
def remote_flag(spark, sf):
    by_location = E.greenhouse_openings(spark, sf, None).select(
        "id", C.is_remote(F.col("location")).alias("is_remote")
    )
    by_workplace = E.lever_openings(spark, sf, None).select(
        "id", (F.col("workplace_type") == "Remote").alias("is_remote")
    )
    return by_location.unionByName(by_workplace)


@query
def since_cutoff(spark, sf):
    return tables.since(E.greenhouse_departments(spark, sf, None), V.DEPARTMENT_EPOCH).select(
        "id", "record_id", "updated_at"
    )


@query
def length_bucket(spark, sf):
    postings = E.rippling_openings(spark, sf, None).select(
        "id", "url", C.day_of(F.col("created_at")).alias("day")
    )
    spanned = joins.with_lifespan(postings, "url", "day").select(
        "id",
        C.is_active(F.col("day"), E.AS_OF).alias("is_active"),
        C.days_active(F.col("earliest_opening_date"), F.col("latest_opening_date")).alias(
            "days_active"
        ),
    )
    bucket = C.length_bucket(F.col("is_active"), F.col("days_active"))
    return spanned.withColumn("posting_length_category", bucket)


@query
def opening_category(spark, sf):
    """Categories of documents: source and language stand for departments, the text for a title."""
    text = C.searchable([F.col("source"), F.col("lang")], F.col("text")).alias("searchable")
    documents = E.table(spark, sf, "documents").select("doc_id", text)
    return documents.select("doc_id", C.categorise(F.col("searchable")).alias("opening_category"))


@query
def enabled_boards(spark, sf):
    boards = E.boards(spark, sf)
    urls = tables.enabled_boards(boards).select(F.lit("url").alias("kind"), F.col("url").alias("board"))
    tokens = tables.enabled_boards(boards, "rippling").select(
        F.lit("token").alias("kind"), F.col("board_token").alias("board")
    )
    return urls.unionByName(tokens)


# C: joins


@query
def department_lookup(spark, sf):
    slots = unify.department_slots(_staged(spark, sf, "greenhouse"))
    dims = _staged(spark, sf, "greenhouse_departments").select(
        "source", "department_id", "run_id", "department_category", "department_name"
    )
    looked_up = joins.left_lookup(slots, dims, ["source", "department_id", "run_id"])
    return looked_up.withColumn("_place", F.col("_place").cast("bigint")).withColumnRenamed(
        "_place", "place"
    )


@query
def hierarchy_path(spark, sf):
    items = E.ashby_openings(spark, sf, None).select("id", "department_id")
    return joins.hierarchy_path(items, E.ashby_departments(spark, sf, None), ["updated_at", "id"])


@query
def location_text(spark, sf):
    locations = _staged(spark, sf, "ashby_locations")
    placed = unify.ashby_locations(_staged(spark, sf, "ashby"), locations)
    return placed.select("id", "opening_id", "location")


@query
def department_paths(spark, sf):
    teams = _staged(spark, sf, "ashby_departments")
    placed = unify.ashby_departments(_staged(spark, sf, "ashby"), teams)
    return placed.select("id", "opening_id", "primary_department", "secondary_department")


@query
def with_group_values(spark, sf):
    raw = E.lever_openings(spark, sf, None).select("id", "source", "run_id")
    grouped = aggregates.count_by(raw, ["source"], "board_rows")
    return joins.with_group_values(raw, grouped, "source")


@query
def combined_on_id(spark, sf):
    raw = E.ashby_openings(spark, sf, None)
    return joins.combine_on_id(
        raw.select("id", "opening_id"),
        raw.where("compensation_tier IS NOT NULL").select("id", "compensation_tier"),
        raw.where("department_id <> 'missing'").select("id", "department_id"),
    )


@query
def board_postings(spark, sf):
    return joins.join_boards(
        E.lever_openings(spark, sf, None).select("id", "source"), E.boards(spark, sf)
    )


@query
def explode_list(spark, sf):
    raw = E.greenhouse_openings(spark, sf, None).select("id", "department_ids")
    return reshape.explode_list(raw, "department_ids", V.LIST_SEPARATOR, "department_id")


@query
def explode_path_ordinal(spark, sf):
    raw = E.lever_openings(spark, sf, None).select("id", "department_names")
    return reshape.explode_list(
        raw, "department_names", V.PATH_SEPARATOR, "department_name", "department_level"
    ).withColumn("department_name", F.trim("department_name"))


# D: aggregations


@query
def lifespan(spark, sf):
    raw = E.rippling_openings(spark, sf, None)
    days = raw.select("id", "url", C.day_of(F.col("created_at")).alias("seen_on"))
    spanned = joins.with_lifespan(days, "url", "seen_on")
    return spanned.withColumn(
        "days_active",
        C.days_active(F.col("earliest_opening_date"), F.col("latest_opening_date")),
    )


@query
def child_concat(spark, sf):
    """Locations of a posting and run, each sighting of a place once."""
    _, stage = marts.STAGED["ashby_locations"]
    return reshape.concat_children(
        stage(E.ashby_locations(spark, sf, None)),
        ["opening_id", "run_id"],
        "secondary_location_name",
        "id",
        "secondary_locations",
    )


@query
def concat_all_but_one(spark, sf):
    """Labels of a posting and run, each label once, as first listed."""
    rows = P.flat_rows(spark, sf).select(
        "job_id", "title", "run_id", "label", (F.col("id") * 10 + F.col("place")).alias("row")
    )
    listed = dedupe.first_seen(rows, ["job_id", "run_id", "label"], ["row"])
    return reshape.concat_all_but_one(listed, "label", "row")


@query
def pivot_by_level(spark, sf):
    return reshape.pivot_by_value(
        E.greenhouse_departments(spark, sf, None),
        ["source", "run_id"],
        "department_category",
        "department_name",
        V.DEPARTMENT_LEVELS,
        V.DEPARTMENT_COLUMNS,
    )


@query
def pivot_by_ordinal(spark, sf):
    steps = reshape.explode_list(
        E.lever_openings(spark, sf, None).select("id", "department_names"),
        "department_names",
        V.PATH_SEPARATOR,
        "step",
        "place",
    )
    trimmed = steps.withColumn("step", F.trim("step"))
    return reshape.pivot_by_ordinal(trimmed, ["id"], "place", "step", V.DEPARTMENT_COLUMNS)


@query
def run_counts(spark, sf):
    raw = E.raw_tables(spark, sf)
    rows = {}
    for name in ("greenhouse", "lever", "ashby"):
        openings = raw[f"{name}_openings"].withColumnRenamed("board_source", "source")
        rows[name] = aggregates.count_by(openings, ["run_id", "source"], "num_rows")
    links = checks.raw_link_counts(raw)
    return setops.union_counts(**rows).join(links, ["run_id", "source", "job_board"])


@query
def distinct_postings(spark, sf):
    return aggregates.distinct_rows(
        E.lever_openings(spark, sf, None), ["source", "company_name", "opening_link", "opening_title"]
    )


# E: windows


@query
def first_seen(spark, sf):
    kept = dedupe.first_seen(E.lever_openings(spark, sf, None), ["record_id"], ["updated_at", "id"])
    return kept.select("id", "record_id", "updated_at")


@query
def first_seen_per_day(spark, sf):
    raw = E.ashby_openings(spark, sf, None).withColumn("day", C.day_of(C.epoch_to_utc(F.col("updated_at"))))
    kept = dedupe.first_seen_per_day(raw, "record_id", "opening_link", "day", ["updated_at", "id"])
    return kept.select("id", "record_id", "opening_link", "day")


@query
def first_seen_two_keys(spark, sf):
    kept = dedupe.first_seen_two_keys(
        E.greenhouse_departments(spark, sf, None),
        ["record_id"],
        ["department_id", "run_id"],
        ["updated_at", "id"],
    )
    return kept.select("id", "record_id", "department_id", "run_id")


@query
def latest_name(spark, sf):
    kept = dedupe.latest(E.ashby_departments(spark, sf, None), ["department_id"], ["updated_at", "id"])
    return kept.select("id", "department_id", "department_name", "updated_at")


@query
def first_daily(spark, sf):
    days = E.rippling_openings(spark, sf, None).withColumn("day", C.day_of(F.col("created_at")))
    return dedupe.first_daily(days, "url", "day", "id").select("id", "url", "day")


@query
def header_fill(spark, sf):
    """User ids shown with events of some value only, carried on within the event type."""
    shown = F.when(F.col("value") > 40, F.col("user_id"))
    rows = E.table(spark, sf, "events").select("event_id", "event_type", shown.alias("header"))
    return dedupe.fill_forward(rows, ["event_type"], "event_id", "header")


@query
def keyed_ids(spark, sf):
    known = F.when(F.col("value") > 40, F.col("event_type"))
    key = C.keyed_id(F.lit("posting"), F.col("event_id"), F.col("user_id"), known)
    return E.table(spark, sf, "events").select("event_id", key.alias("record_id"))


# K: checks


@query
def check_not_null(spark, sf):
    return checks.not_null(E.lever_openings(spark, sf, None), "department_names").select("id", "record_id")


@query
def check_unique(spark, sf):
    return checks.unique(E.ashby_departments(spark, sf, None), "record_id")


@query
def check_unique_where(spark, sf):
    return checks.unique(
        E.greenhouse_departments(spark, sf, None), "record_id", "department_category != 'level-2'"
    )


@query
def check_accepted(spark, sf):
    """The selected boards' providers against all postings: those of the fourth one are wrong."""
    return checks.accepted(_unified(spark, sf), "job_board", V.ACCEPTED["selected_job_board"])


@query
def check_columns(spark, sf):
    expected = {f.name for f in RAW["lever_openings"]}
    shape = checks.columns_match(E.greenhouse_openings(spark, sf), sorted(expected))
    full = checks.columns_match(_unified(spark, sf), MART_COLUMNS)
    tag = [shape.withColumn("dataset", F.lit("raw")), full.withColumn("dataset", F.lit("unified"))]
    return tag[0].unionByName(tag[1])


@query
def check_freshness(spark, sf):
    """The age of each table at two times, from its newest row."""
    frames = []
    for name in LOADED_AT:
        column = F.max(LOADED_AT[name])
        latest = column if name == "rippling_openings" else C.epoch_to_utc(column)
        newest = E.TABLES[name](spark, sf).agg(latest.alias("latest"))
        times = {f"{name} today": AS_OF_TIME, f"{name} later": datetime(2024, 2, 1, 10)}
        ages = [
            F.struct(
                F.lit(label).alias("table_name"),
                checks.age_seconds(F.col("latest"), at).alias("age_seconds"),
                checks.age_verdict(checks.age_seconds(F.col("latest"), at)).alias("verdict"),
            )
            for label, at in times.items()
        ]
        frames.append(newest.select("latest", F.inline(F.array(*ages))))
    return setops.union_all(*frames)


@query
def reconcile_boards(spark, sf):
    active = marts.active_postings(_mart(spark, sf))
    return checks.reconcile(E.boards(spark, sf), active)


@query
def reconcile_boards_excluding(spark, sf):
    active = marts.active_postings(_mart(spark, sf))
    return checks.reconcile(E.boards(spark, sf), active, ["https://jobs.lever.co/quiet0"])


@query
def returning_postings(spark, sf):
    return checks.returning(_mart(spark, sf))


@query
def returning_postings_by_days(spark, sf):
    """Distorts the days of remote rows first, as the check cannot fail otherwise."""
    mart = stored(_mart(spark, sf), "mart")
    bent = F.when(F.col("is_remote"), F.col("days_active") + 1)
    distorted = mart.withColumn("days_active", F.coalesce(bent, F.col("days_active")))
    return checks.returning_by_days(distorted).select(
        "id", "full_opening_link", "days_active", "expected_days_active"
    )


@query
def active_count_match(spark, sf):
    raw = E.raw_tables(spark, sf)
    return checks.active_count_match(marts.active_postings(_mart(spark, sf)), raw)


@query
def check_verdicts(spark, sf):
    """Checks of several tables: one pass over each for all that needs no grouping, the mart's too."""
    raw = E.raw_tables(spark, sf)
    mart = stored(_mart(spark, sf), "mart")

    def accepted(column, values, **limits):
        return checks.fold_accepted(column, V.ACCEPTED[values], **limits)

    of_lever = {
        "lever department_names not null": checks.fold_not_null("department_names"),
        "lever department_names not null, warn only": checks.fold_not_null("department_names", severity="warn"),
    }
    of_mart = {
        "mart id not null": checks.fold_not_null("id"),
        "mart length category accepted": accepted("posting_length_category", "posting_length_category"),
        "mart opening category accepted": accepted("opening_category", "opening_category"),
        "mart job board accepted": accepted("job_board", "selected_job_board"),
    }
    of_departments = {
        "department category accepted": accepted("department_category", "department_category", severity="warn")
    }
    limits = {"warn_at": V.RECONCILE_WARN_AT, "error_at": V.RECONCILE_ERROR_AT}
    boards_off = checks.reconcile(raw["boards"], marts.active_postings(mart))
    grouped = {
        "mart id unique": checks.verdict(checks.unique(mart, "id")),
        "boards reconciled": checks.verdict(boards_off, **limits),
    }
    return setops.union_all(
        checks.judged(raw["lever_openings"], of_lever),
        checks.judged(mart, of_mart),
        checks.judged(raw["greenhouse_departments"], of_departments),
        checks.verdicts(grouped),
    )


@query
def declared_checks_raw(spark, sf):
    raw = {name: stored(df, name) for name, df in E.raw_tables(spark, sf).items()}
    return declared.run_all(raw, declared.RAW_CHECKS, AS_OF_TIME)


@query
def checks_across(spark, sf):
    """Boards, returning postings, days open and active counts, as the daily job runs them."""
    mart = stored(_mart(spark, sf), "mart")
    return declared.run_across(E.raw_tables(spark, sf), mart, marts.active_postings(mart))


@query
def declared_checks_staged(spark, sf):
    staged = {
        name: stored(_staged(spark, sf, name), f"staged_{name}") for name in declared.STAGED_CHECKS
    }
    return declared.run_all(staged, declared.STAGED_CHECKS)


@query
def declared_checks_marts(spark, sf):
    mart, boards = stored(_mart(spark, sf), "mart"), E.boards(spark, sf)
    frames = {
        "all_postings": mart,
        "active_postings": marts.active_postings(mart),
        "active_selected": marts.active_selected(mart, boards),
        "active_prospect": marts.active_prospect(mart, boards),
    }
    return declared.run_all(frames, declared.MART_CHECKS)


# L: datasets


def _dataset(name, make):
    make.__name__ = name
    query(make)


for _name in marts.STAGED:
    _dataset(f"staged_{_name}", lambda spark, sf, name=_name: _staged(spark, sf, name))

for _name in marts.UNIFIED:
    _dataset(f"unified_{_name}", lambda spark, sf, name=_name: _unify(spark, sf, name))


@query
def all_postings(spark, sf):
    return _mart(spark, sf)


@query
def active_postings(spark, sf):
    return marts.active_postings(_mart(spark, sf))


@query
def active_selected(spark, sf):
    return marts.active_selected(_mart(spark, sf), E.boards(spark, sf))


@query
def active_prospect(spark, sf):
    return marts.active_prospect(_mart(spark, sf), E.boards(spark, sf))
