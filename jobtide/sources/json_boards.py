"""Board responses in JSON to raw rows, with typed decoding and set-based flattening.

A response row is (board, run_id, fetched_at, body); ``board`` is the board URL.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.fixed_values import NAME_SEPARATOR
from jobtide.functions import blank_to_null, keyed_id, skipping_concat, token_company
from jobtide.operators.in_row import grouped
from jobtide.operators.reshape import entries
from jobtide.schemas import FLAT_BOARD, NESTED_BOARD
from jobtide.sources.runs import stamp_run

_REQUIRED = ["id", "title", "teamId", "locationId", "locationName", "employmentType"]
_RESPONSE = ["board", "run_id", "fetched_at"]
_HEADER = [
    "record_id",
    "created_at",
    "updated_at",
    "company_name",
    "board_source",
    "run_id",
    "raw_file",
    "existing_used",
]


def _with_decoded(responses: DataFrame, schema: T.DataType, **options) -> DataFrame:
    """Responses with their decoded body, parsed once per row.

    Filters on the decoded body would be pushed down as copies of the parsing; they stop at the
    one-entry list that is unfolded here.
    """
    decoded = F.array(F.from_json("body", schema, options))
    return responses.select("*", F.explode_outer(decoded).alias("_decoded"))


def parsed(responses: DataFrame) -> DataFrame:
    """Nested responses with their board and the reason why it cannot be used, if there is one.

    Responses that have these stay: store them where several things are decoded from the same ones.
    """
    if "_reason" in responses.columns:
        return responses
    decoded = _with_decoded(
        responses, NESTED_BOARD, mode="PERMISSIVE", columnNameOfCorruptRecord="broken"
    )
    boards = decoded.select(
        *responses.columns,
        F.col("_decoded.broken").alias("_broken"),
        F.col("_decoded.data.jobBoard").alias("_board"),
    )
    return boards.withColumn("_reason", _reject_reason())


def _incomplete(posting: Column) -> Column:
    missing = posting[_REQUIRED[0]].isNull()
    for field in _REQUIRED[1:]:
        missing = missing | posting[field].isNull()
    return missing


def _reject_reason() -> Column:
    postings = F.col("_board.jobPostings")
    return (
        F.when(F.col("_broken").isNotNull() | F.col("body").isNull(), "decode_error")
        .when(F.col("_board").isNull(), "no_board")
        .when(postings.isNull(), "decode_error")
        .when(F.exists(postings, _incomplete), "decode_error")
        .when(F.size(postings) == 0, "no_postings")
    )


def _split(judged: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    good = judged.where(F.col("_reason").isNull()).select(*columns)
    rejected = judged.where(F.col("_reason").isNotNull()).select(
        *columns, F.col("_reason").alias("reason")
    )
    return good, rejected


def split_valid(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested responses worth decoding, and the others with the reason they are left out."""
    return _split(parsed(responses), responses.columns)


def parsed_flat(responses: DataFrame) -> DataFrame:
    """The same for responses that are one array of postings: the array and the reason."""
    if "_reason" in responses.columns:
        return responses
    reason = F.when(F.col("_decoded").isNull(), "decode_error").when(
        F.size("_decoded") == 0, "no_postings"
    )
    return _with_decoded(responses, FLAT_BOARD).withColumn("_reason", reason)


def split_valid_flat(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flat responses worth decoding, and the others with the reason they are left out."""
    return _split(parsed_flat(responses), responses.columns)


def _stamped(rows: DataFrame) -> DataFrame:
    return stamp_run(
        rows,
        F.col("fetched_at"),
        F.col("run_id"),
        token_company(F.col("board")),
        F.col("board"),
        "board_source",
    )


def _postings(responses: DataFrame) -> DataFrame:
    good = parsed(responses).where(F.col("_reason").isNull())
    return entries(good, "_board.jobPostings", "_row", "_p", *_RESPONSE)


def decode_postings(responses: DataFrame) -> DataFrame:
    """One raw opening per posting of every valid nested response."""
    opening_link = skipping_concat(F.col("board"), F.lit("/"), F.col("_p.id"))
    key = keyed_id(F.lit("posting"), *_row_key(), F.col("_row"))
    return _stamped(_postings(responses).withColumn("record_id", key)).select(
        *_HEADER,
        F.col("_p.id").alias("opening_id"),
        F.col("_p.title").alias("opening_name"),
        F.col("_p.teamId").alias("department_id"),
        F.col("_p.locationId").alias("location_id"),
        F.col("_p.locationName").alias("location_name"),
        F.col("_p.employmentType").alias("employment_type"),
        blank_to_null(F.col("_p.compensationTierSummary")).alias("compensation_tier"),
        opening_link.alias("opening_link"),
    )


def _row_key() -> list[Column]:
    return [F.col(c) for c in _RESPONSE]


def decode_locations(responses: DataFrame) -> DataFrame:
    """One row per secondary location of a posting; a posting without any gives none."""
    listed = _postings(responses).withColumn("opening_id", F.col("_p.id"))
    children = entries(
        listed, "_p.secondaryLocations", "_child", "_l", *_RESPONSE, "_row", "opening_id"
    )
    key = keyed_id(F.lit("location"), *_row_key(), F.col("_row"), F.col("_child"))
    return _stamped(children.withColumn("record_id", key)).select(
        *_HEADER,
        "opening_id",
        F.col("_l.locationId").alias("secondary_location_id"),
        F.col("_l.locationName").alias("secondary_location_name"),
    )


def decode_teams(responses: DataFrame) -> DataFrame:
    """One row per team with its parent, also for boards that have no posting just now."""
    usable = parsed(responses).where(
        F.coalesce("_reason", F.lit("no_postings")) == "no_postings"
    )
    teams = entries(usable, "_board.teams", "_row", "_t", *_RESPONSE)
    key = keyed_id(F.lit("team"), *_row_key(), F.col("_row"))
    return _stamped(teams.withColumn("record_id", key)).select(
        *_HEADER,
        F.col("_t.id").alias("department_id"),
        F.col("_t.name").alias("department_name"),
        F.col("_t.parentTeamId").alias("parent_department_id"),
    )


_FLAT = ["uuid", "name", "url"]


def decode_flat_board(responses: DataFrame) -> DataFrame:
    """Postings of flat responses; one listed under several locations becomes a single row.

    A posting's entries are in one response, so they are brought together within the row, sorted by
    posting once. Postings come as first listed, and so do the locations of each.
    """

    def key(entry: Column) -> Column:
        return F.struct(*[entry[f].alias(f) for f in _FLAT], entry["department"]["label"].alias("department"))

    def posting(group: Column) -> Column:
        listed = F.transform(group, lambda entry: entry["workLocation"]["label"])
        found = F.filter(listed, lambda label: label.isNotNull())
        location = F.when(F.size(found) > 0, F.array_join(found, NAME_SEPARATOR))
        return F.struct(key(group[0]).alias("p"), location.alias("location"))

    listed = F.transform(grouped(F.col("_decoded"), key), posting)
    collapsed = parsed_flat(responses).withColumn("_postings", listed)
    rows = entries(collapsed, "_postings", "_row", "_p", "board", "run_id")
    return rows.select(
        F.col("_p.p.uuid").alias("job_id"),
        F.col("_p.p.name").alias("title"),
        F.col("_p.p.url").alias("url"),
        F.col("_p.location").alias("location"),
        F.split_part(F.col("board"), F.lit("/"), F.lit(-2)).alias("board_token"),
        F.col("_p.p.department").alias("department"),
        "run_id",
        F.col("board").alias("api_endpoint"),
    )
