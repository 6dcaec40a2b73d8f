"""The landing job: stored pages and board responses of a run to the raw tables."""

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide import files
from jobtide.functions import normalise_url, provider_of, utc_literal, utc_time
from jobtide.operators.setops import union_all
from jobtide.schemas import RAW
from jobtide.sinks.scratch import stored
from jobtide.sinks.storage import append_numbered, append_rejected
from jobtide.plans import side_by_side
from jobtide.sources import html_boards, json_boards
from jobtide.sources.landings import all_landings, key_of, latest


#: Columns of what could not be read: a page no style fits, or a response that is of no use.
REJECTED = ["kind", "source", "run_id", "fetched_at", "reason"]


def _styles(pages: DataFrame) -> DataFrame:
    """Pages with the style their board URL tells; NULL where it tells none."""
    provider, newer = provider_of(F.col("source")), F.col("source").contains("//job-boards.")
    style = (
        F.when((provider == "greenhouse") & newer, "paged")
        .when(provider == "greenhouse", "classic")
        .when(provider == "lever", "grouped")
    )
    return pages.withColumn("source", normalise_url(F.col("source"))).withColumn("_style", style)


def page_rows(pages: DataFrame) -> dict[str, DataFrame]:
    """Raw rows of stored pages, each read in the style its board URL tells, and ``rejected`` ones.

    Each page is parsed once: the element lists are stored, and every extraction reads those.
    """
    styled = _styles(pages)
    known = styled.where(F.col("_style").isNotNull())
    parsed = stored(html_boards.with_elements(known), "page-elements")
    classic, paged, grouped = (
        parsed.where(F.col("_style") == style) for style in ("classic", "paged", "grouped")
    )
    return {
        "greenhouse_departments": union_all(
            html_boards.extract_departments(classic), html_boards.extract_paged_departments(paged)
        ),
        "greenhouse_openings": union_all(
            html_boards.extract_openings(classic), html_boards.extract_paged_openings(paged)
        ),
        "lever_openings": html_boards.extract_grouped(grouped),
        "rejected": _rejected(styled.where(F.col("_style").isNull()), "page", "source", "unknown_board"),
    }


def _rejected(rows: DataFrame, kind: str, source: str, reason: str | None = None) -> DataFrame:
    why = F.col("reason") if reason is None else F.lit(reason).alias("reason")
    return rows.select(
        F.lit(kind).alias("kind"), F.col(source).alias("source"), "run_id", "fetched_at", why
    )


def response_rows(nested: DataFrame, flat: DataFrame) -> dict[str, DataFrame]:
    """Raw rows of board responses, and the ``rejected`` ones; each body is parsed once and stored."""
    judged = stored(json_boards.parsed(nested).drop("body"), "responses")
    judged_flat = stored(json_boards.parsed_flat(flat).drop("body"), "flat-responses")
    bad, bad_flat = (
        df.where(F.col("_reason").isNotNull()).withColumn("reason", F.col("_reason"))
        for df in (judged, judged_flat)
    )
    return {
        "ashby_openings": json_boards.decode_postings(judged),
        "ashby_departments": json_boards.decode_teams(judged),
        "ashby_locations": json_boards.decode_locations(judged),
        "rippling_openings": json_boards.decode_flat_board(judged_flat),
        "rejected": union_all(
            _rejected(bad, "nested response", "board"), _rejected(bad_flat, "flat response", "board")
        ),
    }


def all_rows(pages: DataFrame, nested: DataFrame, flat: DataFrame) -> dict[str, DataFrame]:
    """Raw rows of everything a run fetched, and all that was rejected."""
    both = {"pages": lambda: page_rows(pages), "responses": lambda: response_rows(nested, flat)}
    of_pages, of_responses = side_by_side(both).values()
    rejected = union_all(of_pages["rejected"], of_responses["rejected"])
    return {**of_pages, **of_responses, "rejected": rejected}


def _landed_at(spark: SparkSession, base: str, landing: str, at: datetime) -> datetime:
    """When a landing came first, as on record."""
    record, now = f"{base}/_landed/{key_of(landing)}", utc_time(at).isoformat()
    files.create(spark, record, now)
    return datetime.fromisoformat(files.read(spark, record) or now)


def land(
    rows: dict[str, DataFrame], base: str, landing: str, landed_at: datetime, fmt: str = "parquet"
) -> None:
    """Add the rows of a landing to the raw tables under ``base``, and what was rejected to ``rejected``.

    ``landing`` names what is landed: a run, or a part of one where several processes land their own
    boards under one run. Parts add up; a landing that is repeated, also on another day or after it
    failed half way, replaces itself in each table. A table whose rows carry no time of their own is
    dated by when the landing came first: ``landed_at``, in UTC unless it has a zone. Tables are
    written side by side.
    """
    spark = next(iter(rows.values())).sparkSession
    at = utc_literal(_landed_at(spark, base, landing, landed_at))

    def write(name: str, df: DataFrame) -> None:
        if name == "rejected":
            append_rejected(df.withColumn("landed_at", at), f"{base}/{name}", fmt, landing)
            return
        dated = df if "created_at" in df.columns else df.withColumn("created_at", at)
        columns = [c for c in RAW[name].names if c != "id"]
        append_numbered(dated.select(*columns), f"{base}/{name}", fmt, landing)

    side_by_side({name: partial(write, name, df) for name, df in rows.items()})


def read_rejected(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """What was rejected, of the landings that count."""
    schema = T.StructType.fromDDL("kind string, source string, run_id string, fetched_at long, reason string, landed_at timestamp_ntz")
    path = f"{base}/rejected"
    folders = [f"{path}/{each.folder}" for each in latest(all_landings(spark, path))]
    if not any(files.children(spark, folder) != ["_SUCCESS"] for folder in folders):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).option("basePath", path).load(folders).select(*schema.names)
