"""Declared schemas: raw tables, board responses, the unified posting and the mart."""

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "text": T.StringType(),
    "int": T.IntegerType(),
    "number": T.DoubleType(),
    "flag": T.BooleanType(),
    "day": T.DateType(),
    "time": T.TimestampNTZType(),
}


def _struct(**columns: T.DataType | str) -> T.StructType:
    """A struct of nullable fields, their types given by short name or as such."""
    given = {name: _TYPES[t] if isinstance(t, str) else t for name, t in columns.items()}
    return T.StructType([T.StructField(name, t) for name, t in given.items()])


def _texts(names: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), "text")


_BEGIN = {"id": "long", "record_id": "text", "created_at": "long", "updated_at": "long"}
_END = {"run_id": "text", "raw_file": "text", "existing_used": "flag"}
_HTML_HEADER = {**_BEGIN, "source": "text", **_END}
_JSON_HEADER = {**_BEGIN, **_texts("company_name board_source"), **_END}

RAW = {
    "greenhouse_openings": _struct(
        **_HTML_HEADER,
        **_texts("department_ids location office_ids opening_link opening_title"),
    ),
    "greenhouse_departments": _struct(
        **_HTML_HEADER,
        **_texts("company_name department_category department_id department_name"),
    ),
    "lever_openings": _struct(
        **_HTML_HEADER,
        **_texts(
            "company_name department_names location opening_link opening_title workplace_type"
        ),
    ),
    "ashby_openings": _struct(
        **_JSON_HEADER,
        **_texts(
            "opening_id opening_name department_id location_id location_name employment_type"
            " compensation_tier opening_link"
        ),
    ),
    "ashby_departments": _struct(
        **_JSON_HEADER, **_texts("department_id department_name parent_department_id")
    ),
    "ashby_locations": _struct(
        **_JSON_HEADER, **_texts("opening_id secondary_location_id secondary_location_name")
    ),
    "rippling_openings": _struct(
        id="long",
        job_id="text",
        created_at="time",
        **_texts("title url location board_token department run_id api_endpoint"),
    ),
    "boards": _struct(
        id="long",
        url="text",
        is_enabled="flag",
        is_prospect="flag",
        is_web_scraped="flag",
        **_texts("job_board_provider board_token"),
    ),
}

# Column that dates a raw row: epoch seconds everywhere but for the one timestamp-typed table.
LOADED_AT = {name: "updated_at" for name in RAW if name not in ("boards", "rippling_openings")}
LOADED_AT["rippling_openings"] = "created_at"

PAGES = _struct(source="text", page_number="long", run_id="text", fetched_at="long", html="text")
RESPONSES = _struct(board="text", run_id="text", fetched_at="long", body="text")

_TEAM = _struct(**_texts("id name parentTeamId"))
_SECONDARY = _struct(**_texts("locationId locationName"))
_POSTING = _struct(
    **_texts(
        "id title teamId locationId locationName employmentType compensationTierSummary"
    ),
    secondaryLocations=T.ArrayType(_SECONDARY),
)
_BOARD = _struct(teams=T.ArrayType(_TEAM), jobPostings=T.ArrayType(_POSTING))
NESTED_BOARD = _struct(data=_struct(jobBoard=_BOARD), broken="text")

_LABELLED = _struct(**_texts("id label"))
FLAT_BOARD = T.ArrayType(
    _struct(
        **_texts("uuid name"), department=_LABELLED, url="text", workLocation=_LABELLED
    )
)

UNIFIED_COLUMNS = [
    "id",
    "record_id",
    "created_date_utc",
    "updated_date_utc",
    "source",
    "company_name",
    "uses_existing",
    "location",
    "full_opening_link",
    "opening_title",
    "is_remote",
    "primary_department",
    "secondary_department",
    "tertiary_department",
    "quaternary_department",
    "run_id",
    "job_board",
]
MART_COLUMNS = UNIFIED_COLUMNS + [
    "is_active",
    "earliest_opening_date",
    "latest_opening_date",
    "days_active",
    "posting_length_category",
    "opening_category",
]
_UNTEXTUAL = {
    "created_date_utc": "day",
    "updated_date_utc": "day",
    "uses_existing": "flag",
    "is_remote": "flag",
}
UNIFIED = _struct(**{name: _UNTEXTUAL.get(name, "text") for name in UNIFIED_COLUMNS})

# Given tables that queries read.
GIVEN = {
    "events": _struct(
        event_id="long", ts="time", user_id="long", event_type="text", value="number", props="text"
    ),
    "pages": _struct(page_id="long", url="text", html="text"),
    "documents": _struct(doc_id="long", text="text", lang="text", source="text", n_chars="long"),
    "nation": _struct(n_nationkey="int", n_name="text", n_regionkey="int"),
    "region": _struct(r_regionkey="int", r_name="text"),
}
