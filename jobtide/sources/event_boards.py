"""Raw board tables made from the event data, for trying the engine on the given tables.

An event is one sighting of the posting (user, event type) by the crawl of a day. Days are spread
backwards from ``AS_OF`` so that postings of all ages occur (those of every tenth user into the last
six days), and a few events get missing, empty or unknown departments and locations. Every event is
a sighting of one provider; an adapter without a provider takes the events of all. Work grows with
the events; nation and region name things.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.schemas import GIVEN, RAW

AS_OF = date(2024, 1, 30)
AS_OF_EPOCH = 1706572800

_DAY = "datediff(to_date(ts), DATE'2024-01-01')"
_TITLE = """CASE event_type WHEN 'signup' THEN 'Data Engineer' WHEN 'error' THEN 'Software Engineer'
    WHEN 'view' THEN 'Product Manager' WHEN 'click' THEN 'Accounting Analyst'
    WHEN 'purchase' THEN 'Senior Account Executive' END"""
_LOCATION = """CASE WHEN event_id % 19 = 0 THEN NULL
    WHEN event_id % 6 = 0 THEN 'Remote - ' || n_name ELSE n_name END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table with its declared schema, so that no job runs to find it out."""
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def sightings(spark: SparkSession, sf_dir: str, provider: int | None = None) -> DataFrame:
    """Events of one provider's companies, or of all, as sightings with the names of their place."""
    events = table(spark, sf_dir, "events")
    if provider is not None:
        events = events.where(F.col("user_id") % 4 == provider)
    seen = events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "user_id % 20 AS company",
        "CAST(user_id % 25 AS INT) AS n_nationkey",
        "user_id || '-' || event_type AS posting",
        f"if(user_id % 10 = 1, (29 - {_DAY}) % 6, (29 - {_DAY}) * (1 + user_id % 5)) AS days_back",
        "CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS seconds",
        "hour(ts) div 12 AS half",
        f"{_TITLE} AS title",
    ).selectExpr(
        "*",
        f"{AS_OF_EPOCH} - days_back * 86400 + seconds AS seen_at",
        f"CAST(date_sub(DATE'{AS_OF}', CAST(days_back AS INT)) AS STRING) AS run_id",
    )
    places = (
        table(spark, sf_dir, "nation")
        .withColumnRenamed("n_regionkey", "r_regionkey")
        .join(table(spark, sf_dir, "region"), "r_regionkey")
    )
    named = seen.selectExpr("*", "posting || '-' || run_id || '-' || half AS record_id")
    return named.join(places, "n_nationkey")


def _raw(df: DataFrame, name: str, **columns: str) -> DataFrame:
    """A raw table's columns, each from its expression or else the column of that name."""
    known = {"raw_file": "NULL", "existing_used": "event_id % 3 = 0", **columns}
    return df.selectExpr(
        *[
            f"CAST({known.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in RAW[name]
        ]
    )


_SEEN = {"id": "event_id", "created_at": "seen_at", "updated_at": "seen_at"}

# greenhouse: companies 0, 4, 8, 12 and 16; 4 and 12 on the newer host, 16 embedded

_GREENHOUSE_SOURCE = """CASE
    WHEN company % 8 = 4 THEN 'https://job-boards.greenhouse.io/company' || company
    WHEN company = 16 THEN 'https://boards.greenhouse.io/embed/job_board?for=company' || company
    ELSE 'https://boards.greenhouse.io/company' || company END"""
_REGION_DEPARTMENT = "(company * 100 + r_regionkey)"
_NEXT_REGION_DEPARTMENT = "(company * 100 + (r_regionkey + 1) % 5)"
_NATION_DEPARTMENT = "(company * 100 + 50 + n_nationkey)"
_TYPE_DEPARTMENT = """(company * 100 + 80
    + array_position(array('click', 'error', 'purchase', 'signup', 'view'), event_type))"""
_BOTH_DEPARTMENTS = f"{_REGION_DEPARTMENT} || ',' || {_NATION_DEPARTMENT}"


def greenhouse_openings(spark: SparkSession, sf_dir: str, provider: int | None = 0) -> DataFrame:
    return _raw(
        sightings(spark, sf_dir, provider),
        "greenhouse_openings",
        **_SEEN,
        source=_GREENHOUSE_SOURCE,
        department_ids=f"""CASE WHEN event_id % 11 = 0 THEN NULL
            WHEN event_id % 17 = 0 THEN ''
            WHEN event_id % 13 = 0 THEN {_BOTH_DEPARTMENTS} || ',999999'
            WHEN event_id % 7 = 0 THEN {_BOTH_DEPARTMENTS} || ',' || {_NEXT_REGION_DEPARTMENT}
            WHEN event_id % 5 = 0 THEN {_BOTH_DEPARTMENTS} || ',' || {_TYPE_DEPARTMENT}
            ELSE {_BOTH_DEPARTMENTS} END""",
        location=_LOCATION,
        office_ids="'o' || n_nationkey",
        opening_link="""if(company IN (0, 8), '', 'https://job-boards.greenhouse.io')
            || '/company' || company || '/jobs/' || posting""",
        opening_title="title",
    )


def greenhouse_departments(spark: SparkSession, sf_dir: str, provider: int | None = 0) -> DataFrame:
    """Departments a crawl's postings refer to; some are listed twice, some much too early."""
    named = sightings(spark, sf_dir, provider).selectExpr(
        "event_id",
        "seen_at",
        "run_id",
        "'company' || company AS company_name",
        f"{_GREENHOUSE_SOURCE} AS source",
        f"""stack(3, 0, {_REGION_DEPARTMENT}, r_name, 1, {_NATION_DEPARTMENT}, n_name,
            2, {_TYPE_DEPARTMENT}, event_type) AS (level, number, department_name)""",
    )
    once = _first_listed(
        named, "run_id", "company_name", "source", "level", "number", "department_name"
    )
    listed = once.selectExpr("*", "explode(if(number % 3 = 0, array(0, 1), array(0))) AS copy")
    return _raw(
        listed,
        "greenhouse_departments",
        id="event_id * 10 + level + copy * 5",
        record_id="run_id || '-' || number || if(copy = 1 AND number % 9 <> 0, '-again', '')",
        created_at="seen_at",
        updated_at="if(copy = 1 AND number % 8 = 7, 1684500000, seen_at + copy * 60)",
        department_category="'level-' || level",
        department_id="number",
    )


def _first_listed(named: DataFrame, *keys: str) -> DataFrame:
    return named.groupBy(*keys).agg({"event_id": "min", "seen_at": "min"}).selectExpr(
        *keys, "`min(event_id)` AS event_id", "`min(seen_at)` AS seen_at"
    )


# lever: companies 1, 5, 9, 13 and 17


def lever_openings(spark: SparkSession, sf_dir: str, provider: int | None = 1) -> DataFrame:
    return _raw(
        sightings(spark, sf_dir, provider),
        "lever_openings",
        **_SEEN,
        source="'https://jobs.lever.co/company' || company",
        company_name="'company' || company",
        department_names="""CASE WHEN event_id % 11 = 0 THEN NULL
            WHEN event_id % 17 = 0 THEN ''
            WHEN event_id % 13 = 0 THEN r_name
            WHEN event_id % 7 = 0
                THEN concat_ws(' – ', r_name, n_name, event_type, 'Team-' || (user_id % 3), 'Extra')
            WHEN event_id % 5 = 0 THEN concat_ws(' – ', r_name, n_name, event_type)
            ELSE concat_ws(' – ', r_name, n_name) END""",
        location=_LOCATION,
        opening_link="'https://jobs.lever.co/company' || company || '/' || posting",
        opening_title="title",
        workplace_type="""if(event_id % 19 = 0, NULL,
            get(array('Remote', 'On-site', 'Hybrid'), CAST(event_id % 3 AS INT)))""",
    )


# ashby: companies 2, 6, 10, 14 and 18; some names hold a space

_ASHBY_COMPANY = "if(company % 8 = 2, 'company ', 'company') || company"
_ASHBY_SOURCE = "'https://jobs.ashbyhq.com/company' || if(company % 8 = 2, '%20', '') || company"
_REGION_TEAM = "'c' || company || '-r' || r_regionkey"
_NATION_TEAM = "'c' || company || '-n' || n_nationkey"


def ashby_openings(spark: SparkSession, sf_dir: str, provider: int | None = 2) -> DataFrame:
    return _raw(
        sightings(spark, sf_dir, provider),
        "ashby_openings",
        **_SEEN,
        company_name=_ASHBY_COMPANY,
        board_source=_ASHBY_SOURCE,
        opening_id="posting",
        opening_name="title",
        department_id=f"""CASE WHEN event_id % 13 = 0 THEN 'missing'
            WHEN event_id % 7 = 0 THEN {_REGION_TEAM} ELSE {_NATION_TEAM} END""",
        location_id="'n' || n_nationkey",
        location_name="n_name",
        employment_type="""get(array('FullTime', 'PartTime', 'Intern', 'Contract', 'Temporary'),
            CAST(event_id % 5 AS INT))""",
        compensation_tier="if(event_id % 4 = 0, NULL, '$' || (50 + event_id % 100) || 'K')",
        opening_link=f"{_ASHBY_SOURCE} || '/' || posting",
    )


def ashby_departments(spark: SparkSession, sf_dir: str, provider: int | None = 2) -> DataFrame:
    """Teams a crawl's postings refer to; nations are renamed from the middle of the month on."""
    named = sightings(spark, sf_dir, provider).selectExpr(
        "event_id",
        "seen_at",
        "run_id",
        f"{_ASHBY_COMPANY} AS company_name",
        f"{_ASHBY_SOURCE} AS board_source",
        f"""stack(2, 0, {_REGION_TEAM}, r_name, NULL,
            1, {_NATION_TEAM}, n_name || if(run_id >= '2024-01-15', ' Team', ''), {_REGION_TEAM})
            AS (kind, department_id, department_name, parent_department_id)""",
    )
    keys = [c for c in named.columns if c not in ("event_id", "seen_at")]
    listed = _first_listed(named, *keys).selectExpr(
        "*", "explode(if(event_id % 3 = 0, array(0, 1), array(0))) AS copy"
    )
    return _raw(
        listed,
        "ashby_departments",
        id="event_id * 10 + kind + copy * 5",
        record_id="run_id || '-' || department_id",
        created_at="seen_at",
        updated_at="seen_at + copy * 60",
    )


def ashby_locations(spark: SparkSession, sf_dir: str, provider: int | None = 2) -> DataFrame:
    """No, one or two further locations per sighting."""
    places = "explode(sequence(1, CAST(event_id % 3 AS INT))) AS place"
    seen = sightings(spark, sf_dir, provider).where("event_id % 3 > 0").drop("n_name")
    further = seen.selectExpr("*", places).selectExpr("*", "(n_nationkey + place) % 25 AS further")
    names = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS further", "n_name")
    return _raw(
        further.join(names, "further"),
        "ashby_locations",
        **{**_SEEN, "id": "event_id * 10 + place"},
        record_id="record_id || '-' || place",
        company_name=_ASHBY_COMPANY,
        board_source=_ASHBY_SOURCE,
        opening_id="posting",
        secondary_location_id="'n' || further",
        secondary_location_name="if(place = 1 AND event_id % 8 = 0, 'Remote - ', '') || n_name",
    )


# rippling: companies 3, 7, 11, 15 and 19

_RIPPLING_SOURCE = "'https://api.rippling.com/boards/company' || company || '/jobs'"


def rippling_openings(spark: SparkSession, sf_dir: str, provider: int | None = 3) -> DataFrame:
    return _raw(
        sightings(spark, sf_dir, provider),
        "rippling_openings",
        id="event_id",
        job_id="posting",
        created_at="timestampadd(SECOND, seen_at, TIMESTAMP_NTZ'1970-01-01 00:00:00')",
        url="'https://ats.rippling.com/company' || company || '/jobs/' || posting",
        location=_LOCATION,
        board_token="'company' || company",
        department="r_name",
        api_endpoint=_RIPPLING_SOURCE,
    )


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A board per company but for one, plus two boards without postings, one of them disabled."""
    companies = table(spark, sf_dir, "events").selectExpr("user_id % 20 AS company").distinct()
    known = _raw(
        companies.where("company <> 19"),
        "boards",
        id="company * 2 + 1",
        url=f"""CASE company % 4 WHEN 0 THEN {_GREENHOUSE_SOURCE}
            WHEN 1 THEN 'https://jobs.lever.co/company' || company
            WHEN 2 THEN {_ASHBY_SOURCE} ELSE {_RIPPLING_SOURCE} END
            || if(company % 6 = 1, '/', '')""",
        is_enabled="company <> 7",
        is_prospect="company % 2 = 0",
        is_web_scraped="company % 4 < 2",
        job_board_provider="""get(array('greenhouse', 'lever', 'ashby', 'rippling'),
            CAST(company % 4 AS INT))""",
        board_token="'company' || company",
    )
    quiet = _raw(
        table(spark, sf_dir, "region").where("r_regionkey < 2"),
        "boards",
        id="100 + r_regionkey",
        url="'https://jobs.lever.co/quiet' || r_regionkey",
        is_enabled="r_regionkey = 0",
        is_prospect="false",
        is_web_scraped="true",
        job_board_provider="'lever'",
        board_token="'quiet' || r_regionkey",
    )
    return known.unionByName(quiet)


TABLES = {
    "greenhouse_openings": greenhouse_openings,
    "greenhouse_departments": greenhouse_departments,
    "lever_openings": lever_openings,
    "ashby_openings": ashby_openings,
    "ashby_departments": ashby_departments,
    "ashby_locations": ashby_locations,
    "rippling_openings": rippling_openings,
    "boards": boards,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: make(spark, sf_dir) for name, make in TABLES.items()}
