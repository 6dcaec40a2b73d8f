"""Stored pages and board responses rendered from the event-based raw tables.

A page or response holds what one crawl of one board saw within ``PAGE_EVENTS`` successive events,
so its size is bounded however large a board is; page numbers, and with them record ids, depend on
this parameter, and no row does. A page's file is named after it; those of every third run number
are files of the day before.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.sources import event_boards as E

PAGE_EVENTS = 1000


def _page(row_id: str, per_event: int = 1) -> Column:
    return F.floor(F.col(row_id) / (PAGE_EVENTS * per_event)).cast("bigint")


def _html(*parts) -> Column:
    """Concatenated markup; a part that is NULL is left out."""
    texts = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(*[F.coalesce(t.cast("string"), F.lit("")) for t in texts])


def _joined(snippet: str, order: str) -> Column:
    return F.expr(f"listagg({snippet}, '') within group (order by {order})")


def _pages(snippets: DataFrame, order: str) -> DataFrame:
    body = _joined("snippet", order)
    pages = snippets.groupBy("source", "page_number", "run_id").agg(
        F.max("seen_at").alias("fetched_at"),
        F.concat(F.lit("<html><body><br>"), body, F.lit("</body></html>")).alias("html"),
    )
    older = F.col("fetched_at") % 3 == 0
    return pages.select(
        "source",
        "page_number",
        "run_id",
        "fetched_at",
        "html",
        F.concat_ws("/", "run_id", "source", "page_number").alias("raw_file"),
        older.alias("existing_used"),
        (F.col("fetched_at") - F.when(older, 86400).otherwise(0)).alias("first_seen_at"),
    )


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all styles, and one of an unknown board for each page of grouped ones."""
    grouped = grouped_pages(spark, sf_dir)
    board = F.replace(F.col("source"), F.lit("jobs.lever.co"), F.lit("careers.unknown.org"))
    return (
        classic_opening_pages(spark, sf_dir)
        .unionByName(classic_department_pages(spark, sf_dir))
        .unionByName(paged_pages(spark, sf_dir))
        .unionByName(grouped)
        .unionByName(grouped.withColumn("source", board))
    )


def damaged_flat_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat responses of which those of one run in seven are cut off, and of one in seven empty."""
    day = F.dayofyear(F.to_date("run_id")) % 7
    body = F.col("body")
    damaged = F.when(day == 0, F.left(body, F.length(body) - 5)).when(day == 1, "[]").otherwise(body)
    return flat_responses(spark, sf_dir).withColumn("body", damaged)


def _is_paged() -> Column:
    return F.col("source").startswith("https://job-boards.")


def classic_opening_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Openings of the older host as blocks with attributes, an anchor and a location."""
    raw = E.greenhouse_openings(spark, sf_dir).where(~_is_paged())
    departments = _html(' department_id="', F.col("department_ids"), '"')
    snippet = _html(
        '<div class="opening"',
        F.when(F.col("department_ids").isNotNull(), departments),
        ' office_id="',
        F.col("office_ids"),
        '"><a href="',
        F.col("opening_link"),
        '">',
        F.col("opening_title"),
        "</a><br>",
        _html("<span>", F.col("location"), "</span>"),
        "</div>",
    )
    return _pages(
        raw.select(
            "source",
            "run_id",
            "id",
            _page("id").alias("page_number"),
            F.col("updated_at").alias("seen_at"),
            snippet.alias("snippet"),
        ),
        "id",
    )


def classic_department_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departments of the older host as sections with a heading."""
    raw = E.greenhouse_departments(spark, sf_dir).where(~_is_paged())
    snippet = _html(
        '<section class="level ',
        F.col("department_category"),
        '"><h2 id="',
        F.col("department_id"),
        '">',
        F.col("department_name"),
        "</h2><p>open</section>",
    )
    return _pages(
        raw.select(
            "source",
            "run_id",
            "id",
            _page("id", 10).alias("page_number"),
            F.col("created_at").alias("seen_at"),
            snippet.alias("snippet"),
        ),
        "id",
    )


def paged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boards of the newer host: a table per office, headed by it, with an opening per cell."""
    raw = E.greenhouse_openings(spark, sf_dir).where(_is_paged())
    cell = _html(
        '<tr class="job-post"><td class="cell"><a href="',
        F.col("opening_link"),
        '"><p class="body body--medium">',
        F.col("opening_title"),
        "</p>",
        _html('<p class="body body__secondary body--metadata">', F.col("location"), "</p>"),
        "</a></td></tr>",
    )
    cells = raw.select(
        "source",
        "run_id",
        "id",
        _page("id").alias("page_number"),
        F.col("updated_at").alias("seen_at"),
        F.col("office_ids").alias("heading"),
        cell.alias("cell"),
    )
    tables = cells.groupBy("source", "run_id", "page_number", "heading").agg(
        F.max("seen_at").alias("seen_at"), _joined("cell", "id").alias("cells")
    )
    opened = '<div class="job-posts"><div class="job-posts--table--department"><h3 class="section-header">'
    snippet = _html(opened, F.col("heading"), "</h3><table>", F.col("cells"), "</table></div></div>")
    return _pages(tables.withColumn("snippet", snippet), "heading")


def grouped_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = E.lever_openings(spark, sf_dir).drop("department_names")
    names = E.sightings(spark, sf_dir, 1).select(
        F.col("event_id").alias("id"), F.col("event_type").alias("header"), F.col("n_name").alias("label")
    )
    return raw.join(names, "id").withColumn("page_number", _page("id"))


def grouped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped boards: a group per event type and nation. A type is shown with its first group only,
    and not at all on the boards of companies 5 and 13."""
    group = ["source", "run_id", "page_number", "header", "label"]
    anchor = _html(
        '<div class="posting"><a class="posting-title" href="',
        F.col("opening_link"),
        '"><h5>',
        F.col("opening_title"),
        "</h5>",
        F.when(
            F.col("workplace_type").isNotNull(),
            _html('<span class="small workplaceTypes">', F.col("workplace_type"), " —</span>"),
        ),
        _html('<span class="small location">', F.col("location"), "</span>"),
        "</a></div>",
    )
    listed = grouped_sightings(spark, sf_dir).withColumn("anchor", anchor)
    groups = listed.groupBy(*group).agg(
        F.max("updated_at").alias("seen_at"), _joined("anchor", "id").alias("anchors")
    )
    firsts = groups.groupBy("source", "run_id", "page_number", "header").agg(
        F.min("label").alias("first_label")
    )
    headed = (F.col("label") == F.col("first_label")) & ~F.col("company").isin(
        "company5", "company13"
    )
    company = F.split_part(F.col("source"), F.lit("/"), F.lit(-1))
    shown = _html(
        '<div class="large-category-header">', F.col("header"), "</div>"
    )
    snippet = _html(
        '<div class="postings-group">',
        F.when(headed, shown),
        '<div class="large-category-label">',
        F.col("label"),
        "</div>",
        F.col("anchors"),
        "</div>",
    )
    placed = groups.join(firsts, ["source", "run_id", "page_number", "header"])
    return _pages(
        placed.withColumn("company", company).withColumn("snippet", snippet), "header, label"
    )


def _responses(rows: DataFrame, board: str, body: Column) -> DataFrame:
    return rows.select(F.col(board).alias("board"), "run_id", "fetched_at", body.alias("body"))


def _in_order(entries: str) -> Column:
    """Collected (id, entry) pairs as entries in the order of the ids."""
    return F.transform(F.sort_array(entries), lambda e: e["entry"])


def nested_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested board responses: postings with their further locations, and the teams."""
    keys = ["board_source", "run_id", "page"]
    further = E.ashby_locations(spark, sf_dir).withColumn("opening_row", F.floor(F.col("id") / 10))
    secondary = further.groupBy("opening_row").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "id",
                    F.struct(
                        F.col("secondary_location_id").alias("locationId"),
                        F.col("secondary_location_name").alias("locationName"),
                    ).alias("entry"),
                )
            )
        ).alias("secondary")
    )
    openings = E.ashby_openings(spark, sf_dir).withColumn("page", _page("id"))
    posting = F.struct(
        F.col("opening_id").alias("id"),
        F.col("opening_name").alias("title"),
        F.col("department_id").alias("teamId"),
        F.col("location_id").alias("locationId"),
        F.col("location_name").alias("locationName"),
        F.col("employment_type").alias("employmentType"),
        F.coalesce("compensation_tier", F.lit("")).alias("compensationTierSummary"),
        F.transform("secondary", lambda s: s["entry"]).alias("secondaryLocations"),
    )
    joined = openings.join(secondary, openings["id"] == secondary["opening_row"], "left")
    postings = joined.groupBy(*keys).agg(
        F.max("updated_at").alias("fetched_at"),
        F.collect_list(F.struct("id", posting.alias("entry"))).alias("postings"),
    )
    team = F.struct(
        F.col("department_id").alias("id"),
        F.col("department_name").alias("name"),
        F.col("parent_department_id").alias("parentTeamId"),
    )
    teams = (
        E.ashby_departments(spark, sf_dir)
        .withColumn("page", _page("id", 10))
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("id", team.alias("entry"))).alias("teams"))
    )
    board = F.struct(
        _in_order("teams").alias("teams"), _in_order("postings").alias("jobPostings")
    )
    body = F.to_json(F.struct(F.struct(board.alias("jobBoard")).alias("data")))
    return _responses(postings.join(teams, keys, "left"), "board_source", body)


def damaged_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested responses of which some are cut off, lack the board, its postings or a title."""
    kind = F.col("fetched_at") % 7
    body = F.col("body")
    damaged = (
        F.when(kind == 0, F.left(body, F.length(body) - 5))
        .when(kind == 1, '{"data":{"jobBoard":null}}')
        .when(kind == 2, '{"data":{"jobBoard":{"teams":[],"jobPostings":[]}}}')
        .when(kind == 3, F.replace(body, F.lit('"title":"'), F.lit('"caption":"')))
        .otherwise(body)
    )
    return nested_responses(spark, sf_dir).withColumn("body", damaged)


def flat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat board rows; a posting is listed once per location, under up to three of them."""
    raw = E.rippling_openings(spark, sf_dir).withColumn("page", _page("id"))
    places = F.sequence(F.lit(0), (F.col("id") % 3).cast("int"))
    listed = raw.withColumn("place", F.explode(places))
    return listed.withColumn("label", _html(F.col("location"), "/", F.col("place")))


def flat_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses that are a plain array of postings."""
    entry = F.struct(
        F.concat("job_id", F.lit("#"), "id").alias("uuid"),
        F.col("title").alias("name"),
        F.struct(F.lit("d").alias("id"), F.col("department").alias("label")).alias("department"),
        "url",
        F.struct(F.lit("w").alias("id"), "label").alias("workLocation"),
    )
    pages = (
        flat_rows(spark, sf_dir)
        .groupBy("api_endpoint", "run_id", "page")
        .agg(
            F.lit(0).cast("bigint").alias("fetched_at"),
            F.collect_list(F.struct("id", "place", entry.alias("entry"))).alias("entries"),
        )
    )
    return _responses(pages, "api_endpoint", F.to_json(_in_order("entries")))
