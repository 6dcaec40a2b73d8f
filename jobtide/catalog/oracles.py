"""The SQL each registered query is checked against, written for DuckDB.

``CTES`` names the shared steps; ``_sql`` puts those a statement mentions, directly or through
others, in front of it. The tables of the data folder are views of the same name.
"""

import re

CTES = {}
ORACLES = {}

# Raw tables made from the events.

CTES["places"] = """
SELECT n.n_nationkey, n.n_name, r.r_regionkey, r.r_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""

CTES["dated_events"] = """
SELECT event_id, user_id, event_type, user_id % 4 AS provider, user_id % 20 AS company,
       user_id || '-' || event_type AS posting,
       CASE WHEN user_id % 10 = 1 THEN (29 - date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))) % 6
            ELSE (29 - date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))) * (1 + user_id % 5) END AS days_back,
       CAST(extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60 + extract(second FROM ts) AS BIGINT) AS seconds,
       CAST(extract(hour FROM ts) AS BIGINT) // 12 AS half
FROM events
"""

CTES["sightings"] = """
SELECT d.*, p.*,
       1706572800 - days_back * 86400 + seconds AS seen_at,
       CAST(DATE '2024-01-30' - CAST(days_back AS INTEGER) AS VARCHAR) AS run_id,
       posting || '-' || CAST(DATE '2024-01-30' - CAST(days_back AS INTEGER) AS VARCHAR) || '-' || half AS record_id,
       CASE event_type WHEN 'signup' THEN 'Data Engineer' WHEN 'error' THEN 'Software Engineer'
            WHEN 'view' THEN 'Product Manager' WHEN 'click' THEN 'Accounting Analyst'
            WHEN 'purchase' THEN 'Senior Account Executive' END AS title,
       CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 6 = 0 THEN 'Remote - ' || n_name ELSE n_name END AS place,
       event_id % 3 = 0 AS existing_used
FROM dated_events d JOIN places p ON d.user_id % 25 = p.n_nationkey
"""

CTES["greenhouse_sightings"] = """
SELECT *, CASE WHEN company % 8 = 4 THEN 'https://job-boards.greenhouse.io/company' || company
               WHEN company = 16 THEN 'https://boards.greenhouse.io/embed/job_board?for=company16'
               ELSE 'https://boards.greenhouse.io/company' || company END AS source,
       company * 100 + r_regionkey AS region_department,
       company * 100 + 50 + n_nationkey AS nation_department,
       company * 100 + 80 + CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
                                            WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS type_department
FROM sightings WHERE provider = 0
"""

CTES["greenhouse_openings"] = """
SELECT event_id AS id, record_id, seen_at AS created_at, seen_at AS updated_at, source, run_id,
       CAST(NULL AS VARCHAR) AS raw_file, existing_used,
       CASE WHEN event_id % 11 = 0 THEN NULL
            WHEN event_id % 17 = 0 THEN ''
            WHEN event_id % 13 = 0 THEN region_department || ',' || nation_department || ',999999'
            WHEN event_id % 7 = 0 THEN region_department || ',' || nation_department || ',' || (company * 100 + (r_regionkey + 1) % 5)
            WHEN event_id % 5 = 0 THEN region_department || ',' || nation_department || ',' || type_department
            ELSE region_department || ',' || nation_department END AS department_ids,
       place AS location, 'o' || n_nationkey AS office_ids,
       CASE WHEN company IN (0, 8) THEN '' ELSE 'https://job-boards.greenhouse.io' END
           || '/company' || company || '/jobs/' || posting AS opening_link,
       title AS opening_title
FROM greenhouse_sightings
"""

CTES["greenhouse_listed"] = """
SELECT run_id, 'company' || company AS company_name, source, 0 AS level, region_department AS number, r_name AS department_name, event_id, seen_at FROM greenhouse_sightings
UNION ALL
SELECT run_id, 'company' || company, source, 1, nation_department, n_name, event_id, seen_at FROM greenhouse_sightings
UNION ALL
SELECT run_id, 'company' || company, source, 2, type_department, event_type, event_id, seen_at FROM greenhouse_sightings
"""

CTES["greenhouse_departments"] = """
SELECT event_id * 10 + level + copy * 5 AS id,
       run_id || '-' || number || CASE WHEN copy = 1 AND number % 9 <> 0 THEN '-again' ELSE '' END AS record_id,
       seen_at AS created_at,
       CASE WHEN copy = 1 AND number % 8 = 7 THEN 1684500000 ELSE seen_at + copy * 60 END AS updated_at,
       source, run_id, CAST(NULL AS VARCHAR) AS raw_file, event_id % 3 = 0 AS existing_used, company_name,
       'level-' || level AS department_category, CAST(number AS VARCHAR) AS department_id, department_name
FROM (SELECT run_id, company_name, source, level, number, department_name,
             min(event_id) AS event_id, min(seen_at) AS seen_at
      FROM greenhouse_listed GROUP BY ALL) g
JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR number % 3 = 0
"""

CTES["lever_openings"] = """
SELECT event_id AS id, record_id, seen_at AS created_at, seen_at AS updated_at,
       'https://jobs.lever.co/company' || company AS source, run_id, CAST(NULL AS VARCHAR) AS raw_file, existing_used,
       'company' || company AS company_name,
       CASE WHEN event_id % 11 = 0 THEN NULL
            WHEN event_id % 17 = 0 THEN ''
            WHEN event_id % 13 = 0 THEN r_name
            WHEN event_id % 7 = 0 THEN r_name || ' – ' || n_name || ' – ' || event_type || ' – Team-' || (user_id % 3) || ' – Extra'
            WHEN event_id % 5 = 0 THEN r_name || ' – ' || n_name || ' – ' || event_type
            ELSE r_name || ' – ' || n_name END AS department_names,
       place AS location, 'https://jobs.lever.co/company' || company || '/' || posting AS opening_link, title AS opening_title,
       CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'Remote' WHEN event_id % 3 = 1 THEN 'On-site' ELSE 'Hybrid' END AS workplace_type
FROM sightings WHERE provider = 1
"""

CTES["ashby_sightings"] = """
SELECT *, CASE WHEN company % 8 = 2 THEN 'company ' || company ELSE 'company' || company END AS company_name,
       'https://jobs.ashbyhq.com/company' || CASE WHEN company % 8 = 2 THEN '%20' ELSE '' END || company AS board_source,
       'c' || company || '-r' || r_regionkey AS region_team, 'c' || company || '-n' || n_nationkey AS nation_team
FROM sightings WHERE provider = 2
"""

CTES["ashby_openings"] = """
SELECT event_id AS id, record_id, seen_at AS created_at, seen_at AS updated_at, company_name, board_source, run_id,
       CAST(NULL AS VARCHAR) AS raw_file, existing_used, posting AS opening_id, title AS opening_name,
       CASE WHEN event_id % 13 = 0 THEN 'missing' WHEN event_id % 7 = 0 THEN region_team ELSE nation_team END AS department_id,
       'n' || n_nationkey AS location_id, n_name AS location_name,
       CASE event_id % 5 WHEN 0 THEN 'FullTime' WHEN 1 THEN 'PartTime' WHEN 2 THEN 'Intern' WHEN 3 THEN 'Contract' ELSE 'Temporary' END AS employment_type,
       CASE WHEN event_id % 4 <> 0 THEN '$' || (50 + event_id % 100) || 'K' END AS compensation_tier,
       board_source || '/' || posting AS opening_link
FROM ashby_sightings
"""

CTES["ashby_teams"] = """
SELECT run_id, company_name, board_source, 0 AS kind, region_team AS department_id, r_name AS department_name,
       CAST(NULL AS VARCHAR) AS parent_department_id, event_id, seen_at FROM ashby_sightings
UNION ALL
SELECT run_id, company_name, board_source, 1, nation_team, n_name || CASE WHEN run_id >= '2024-01-15' THEN ' Team' ELSE '' END,
       region_team, event_id, seen_at FROM ashby_sightings
"""

CTES["ashby_departments"] = """
SELECT event_id * 10 + kind + copy * 5 AS id, run_id || '-' || department_id AS record_id, seen_at AS created_at,
       seen_at + copy * 60 AS updated_at, company_name, board_source, run_id, CAST(NULL AS VARCHAR) AS raw_file,
       event_id % 3 = 0 AS existing_used, department_id, department_name, parent_department_id
FROM (SELECT run_id, company_name, board_source, kind, department_id, department_name, parent_department_id,
             min(event_id) AS event_id, min(seen_at) AS seen_at
      FROM ashby_teams GROUP BY ALL) g
JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR event_id % 3 = 0
"""

CTES["ashby_locations"] = """
SELECT event_id * 10 + i AS id, record_id || '-' || i AS record_id, seen_at AS created_at, seen_at AS updated_at,
       company_name, board_source, run_id, CAST(NULL AS VARCHAR) AS raw_file, existing_used, posting AS opening_id,
       'n' || n.n_nationkey AS secondary_location_id,
       CASE WHEN i = 1 AND event_id % 8 = 0 THEN 'Remote - ' ELSE '' END || n.n_name AS secondary_location_name
FROM ashby_sightings s JOIN (VALUES (1), (2)) c(i) ON i <= event_id % 3
JOIN nation n ON n.n_nationkey = (s.n_nationkey + i) % 25
"""

CTES["rippling_openings"] = """
SELECT event_id AS id, posting AS job_id, make_timestamp(seen_at * 1000000) AS created_at, title,
       'https://ats.rippling.com/company' || company || '/jobs/' || posting AS url, place AS location,
       'company' || company AS board_token, r_name AS department, run_id,
       'https://api.rippling.com/boards/company' || company || '/jobs' AS api_endpoint
FROM sightings WHERE provider = 3
"""

CTES["boards"] = """
SELECT company * 2 + 1 AS id,
       CASE WHEN company % 8 = 4 THEN 'https://job-boards.greenhouse.io/company' || company
            WHEN company = 16 THEN 'https://boards.greenhouse.io/embed/job_board?for=company16'
            WHEN company % 4 = 0 THEN 'https://boards.greenhouse.io/company' || company
            WHEN company % 4 = 1 THEN 'https://jobs.lever.co/company' || company
            WHEN company % 8 = 2 THEN 'https://jobs.ashbyhq.com/company%20' || company
            WHEN company % 4 = 2 THEN 'https://jobs.ashbyhq.com/company' || company
            ELSE 'https://api.rippling.com/boards/company' || company || '/jobs' END
         || CASE WHEN company % 6 = 1 THEN '/' ELSE '' END AS url,
       company <> 7 AS is_enabled, company % 2 = 0 AS is_prospect, company % 4 < 2 AS is_web_scraped,
       CASE company % 4 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' WHEN 2 THEN 'ashby' ELSE 'rippling' END AS job_board_provider,
       'company' || company AS board_token
FROM (SELECT DISTINCT user_id % 20 AS company FROM events) WHERE company <> 19
UNION ALL
SELECT CAST(100 + r_regionkey AS BIGINT), 'https://jobs.lever.co/quiet' || r_regionkey, r_regionkey = 0, false, true, 'lever', 'quiet' || r_regionkey
FROM region WHERE r_regionkey < 2
"""

# The same tables from the sightings of all providers.

for _name in [n for n in CTES if n.startswith(("greenhouse_", "lever_", "ashby_", "rippling_"))]:
    _text = re.sub(r"\b(FROM|JOIN) ((?:greenhouse|ashby)_\w+)", r"\1 all_\2", CTES[_name])
    CTES[f"all_{_name}"] = re.sub(r"FROM sightings WHERE provider = \d", "FROM sightings", _text)

# Staged tables.

_TIMES = """
       make_timestamp(created_at * 1000000) AS created_at_utc, make_timestamp(updated_at * 1000000) AS updated_at_utc,
       CAST(make_timestamp(created_at * 1000000) AS DATE) AS created_date_utc,
       CAST(make_timestamp(updated_at * 1000000) AS DATE) AS updated_date_utc
"""


def _first_openings(raw):
    return f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY opening_link, updated_date_utc ORDER BY updated_at, id) AS link_row
  FROM (SELECT *, {_TIMES}, row_number() OVER (PARTITION BY record_id ORDER BY updated_at, id) AS record_row FROM {raw})
  WHERE record_row = 1)
WHERE link_row = 1
"""


_COMMON = "record_id, created_at_utc, updated_at_utc, created_date_utc, updated_date_utc"

CTES["staged_greenhouse_departments"] = f"""
SELECT id, {_COMMON}, source, existing_used AS uses_existing, raw_file, run_id, company_name, department_id,
       department_category, department_name, split_part(source, '.', 2) AS job_board
FROM (SELECT *, {_TIMES}, row_number() OVER (PARTITION BY record_id ORDER BY updated_at, id) AS by_record,
             row_number() OVER (PARTITION BY department_id, run_id ORDER BY updated_at, id) AS by_department
      FROM greenhouse_departments WHERE updated_at > 1684600000)
WHERE by_record = 1 AND by_department = 1
"""

CTES["greenhouse_first"] = _first_openings("greenhouse_openings")

_FULL_LINK = "(split_part(source, '/', 4) = 'embed' OR split_part(split_part(source, '/', 3), '.', 1) = 'job-boards')"
_GREENHOUSE_LINK = f"""CASE WHEN {_FULL_LINK} THEN opening_link
            ELSE source || '/' || split_part(opening_link, '/', 3) || '/' || split_part(opening_link, '/', 4) END"""
_GREENHOUSE_COMPANY = """CASE WHEN split_part(source, '/', 4) = 'embed' THEN split_part(source, '=', -1)
            ELSE split_part(split_part(source, '/', -1), '?', 1) END"""

CTES["staged_greenhouse"] = f"""
SELECT split_part(source, '.', 2) || '_' || id AS id, {_COMMON}, source, existing_used AS uses_existing, raw_file, run_id,
       {_GREENHOUSE_COMPANY} AS company_name, coalesce(department_ids, 'No Dept') AS department_ids, location, office_ids,
       {_GREENHOUSE_LINK} AS full_opening_link, opening_title, split_part(source, '.', 2) AS job_board
FROM greenhouse_first
"""

CTES["lever_first"] = _first_openings("lever_openings")

CTES["staged_lever"] = f"""
SELECT split_part(source, '.', 2) || '_' || id AS id, {_COMMON}, source, existing_used AS uses_existing, raw_file, run_id,
       department_names, location, workplace_type, opening_link AS full_opening_link, opening_title, company_name,
       split_part(source, '.', 2) AS job_board
FROM lever_first
"""

CTES["ashby_first"] = _first_openings("ashby_openings")

CTES["staged_ashby"] = f"""
SELECT 'ashby_' || id AS id, {_COMMON}, board_source AS source, existing_used AS uses_existing, raw_file, run_id, company_name,
       opening_id, opening_name AS opening_title, department_id, location_id, location_name, employment_type,
       compensation_tier, opening_link AS full_opening_link, 'ashby' AS job_board
FROM ashby_first
"""

for _name, _columns in {
    "ashby_departments": "department_id, department_name, parent_department_id",
    "ashby_locations": "opening_id, secondary_location_id, secondary_location_name",
}.items():
    CTES[f"staged_{_name}"] = f"""
SELECT id, {_COMMON}, board_source AS source, existing_used AS uses_existing, raw_file, run_id, company_name, {_columns},
       'ashby' AS job_board
FROM (SELECT *, {_TIMES}, row_number() OVER (PARTITION BY record_id ORDER BY updated_at, id) AS record_row FROM {_name})
WHERE record_row = 1
"""

CTES["staged_rippling"] = """
SELECT 'rippling_' || id AS id, job_id AS record_id, CAST(created_at AS DATE) AS created_date_utc,
       CAST(created_at AS DATE) AS updated_date_utc, api_endpoint AS source, board_token AS company_name,
       false AS uses_existing, location, url AS full_opening_link, title AS opening_title,
       lower(location) LIKE '%remote%' AS is_remote, department AS primary_department,
       CAST(NULL AS VARCHAR) AS secondary_department, CAST(NULL AS VARCHAR) AS tertiary_department,
       CAST(NULL AS VARCHAR) AS quaternary_department, run_id, 'rippling' AS job_board
FROM rippling_openings
"""

# Unified postings.

_UNIFIED = "id, record_id, created_date_utc, updated_date_utc, source, company_name, uses_existing"
_REST = "full_opening_link, opening_title"
_DEPARTMENTS = "primary_department, secondary_department, tertiary_department, quaternary_department"

CTES["greenhouse_slots"] = """
SELECT id, source, run_id, department_id, place - 1 AS place
FROM (SELECT id, source, run_id, unnest(string_split(department_ids, ',')) AS department_id,
             generate_subscripts(string_split(department_ids, ','), 1) AS place
      FROM staged_greenhouse WHERE department_ids <> '')
"""

CTES["greenhouse_lookup"] = """
SELECT s.*, d.department_category, d.department_name
FROM greenhouse_slots s LEFT JOIN staged_greenhouse_departments d USING (source, department_id, run_id)
"""

CTES["greenhouse_levels"] = """
SELECT id,
       max(CASE WHEN department_category = 'level-0' THEN department_name WHEN department_id = 'No Dept' THEN 'No Department' END) AS primary_department,
       max(CASE WHEN department_category = 'level-1' THEN department_name END) AS secondary_department,
       max(CASE WHEN department_category = 'level-2' THEN department_name END) AS tertiary_department,
       max(CASE WHEN department_category = 'level-3' THEN department_name END) AS quaternary_department
FROM greenhouse_lookup GROUP BY id
"""

CTES["unified_greenhouse"] = f"""
SELECT {_UNIFIED}, location, {_REST}, lower(location) LIKE '%remote%' AS is_remote, {_DEPARTMENTS}, run_id, job_board
FROM staged_greenhouse JOIN greenhouse_levels USING (id)
"""

CTES["lever_steps"] = """
SELECT id, trim(unnest(string_split(department_names, '–'))) AS step,
       generate_subscripts(string_split(department_names, '–'), 1) AS place
FROM staged_lever WHERE department_names <> ''
"""

CTES["lever_levels"] = """
SELECT id, max(CASE WHEN place = 1 THEN step END) AS primary_department, max(CASE WHEN place = 2 THEN step END) AS secondary_department,
       max(CASE WHEN place = 3 THEN step END) AS tertiary_department, max(CASE WHEN place = 4 THEN step END) AS quaternary_department
FROM lever_steps GROUP BY id
"""

CTES["unified_lever"] = f"""
SELECT {_UNIFIED}, location, {_REST}, workplace_type = 'Remote' AS is_remote, {_DEPARTMENTS}, run_id, job_board
FROM staged_lever JOIN lever_levels USING (id)
"""

CTES["latest_teams"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY department_id ORDER BY updated_at_utc DESC, id) AS team_row
               FROM staged_ashby_departments) WHERE team_row = 1
"""

CTES["ashby_paths"] = """
SELECT o.id, o.opening_id, coalesce(p.department_name, d.department_name) AS primary_department,
       CASE WHEN p.department_name IS NOT NULL THEN d.department_name END AS secondary_department
FROM staged_ashby o LEFT JOIN latest_teams d ON o.department_id = d.department_id
LEFT JOIN latest_teams p ON d.parent_department_id = p.department_id
"""

CTES["ashby_places"] = """
SELECT o.id, o.opening_id,
       CASE WHEN s.names IS NULL THEN o.location_name ELSE concat(o.location_name, ', ', s.names) END AS location
FROM staged_ashby o
LEFT JOIN (SELECT opening_id, run_id, string_agg(secondary_location_name, ', ' ORDER BY id) AS names
           FROM staged_ashby_locations GROUP BY ALL) s USING (opening_id, run_id)
"""

CTES["unified_ashby"] = f"""
SELECT o.id, record_id, created_date_utc, updated_date_utc, source, company_name, uses_existing, l.location, {_REST},
       lower(l.location) LIKE '%remote%' AS is_remote, d.primary_department, d.secondary_department,
       CAST(NULL AS VARCHAR) AS tertiary_department, CAST(NULL AS VARCHAR) AS quaternary_department, run_id, job_board
FROM staged_ashby o JOIN ashby_places l USING (id) JOIN ashby_paths d USING (id)
"""

CTES["unified_rippling"] = "SELECT * FROM staged_rippling"

# Marts.

CTES["unified"] = """
SELECT * FROM unified_greenhouse UNION ALL BY NAME SELECT * FROM unified_lever
UNION ALL BY NAME SELECT * FROM unified_ashby UNION ALL BY NAME SELECT * FROM unified_rippling
"""

CTES["spans"] = """
SELECT full_opening_link, min(created_date_utc) AS earliest_opening_date, max(created_date_utc) AS latest_opening_date
FROM unified GROUP BY full_opening_link
"""

CTES["lasting"] = """
SELECT u.*, created_date_utc = DATE '2024-01-30' AS is_active, earliest_opening_date, latest_opening_date,
       CAST(latest_opening_date - earliest_opening_date + 1 AS BIGINT) AS days_active
FROM unified u JOIN spans USING (full_opening_link)
"""

_BUCKET = """CASE WHEN NOT is_active THEN 'Inactive' WHEN days_active > 90 THEN 'Stale' WHEN days_active > 60 THEN 'Old'
            WHEN days_active > 30 THEN 'Medium' WHEN days_active > 7 THEN 'Recent' ELSE 'New' END"""


def _category(first, second, title):
    def found(*words):
        return " OR ".join(f"lower({c}) LIKE '%{w}%'" for w in words for c in (first, second, title))

    return f"""CASE WHEN {found('data', 'analytics')} THEN 'Data' WHEN {found('engineer')} THEN 'Software Engineering'
            WHEN {found('sales')} OR lower({title}) LIKE '%account executive' THEN 'Sales'
            WHEN {found('finance', 'accounting')} THEN 'Finance & Accounting'
            WHEN {found('operations')} THEN 'Operations' WHEN {found('product')} THEN 'Product' ELSE 'Other' END"""


CTES["mart"] = f"""
SELECT *, {_BUCKET} AS posting_length_category,
       {_category('primary_department', 'secondary_department', 'opening_title')} AS opening_category
FROM lasting
"""

CTES["active"] = "SELECT * FROM mart WHERE is_active"

CTES["selected"] = """
SELECT a.* FROM active a JOIN boards b ON a.source = regexp_replace(b.url, '/$', '') WHERE b.id <= 22
"""

CTES["prospect"] = """
SELECT a.* FROM active a JOIN boards b ON a.source = regexp_replace(b.url, '/$', '') WHERE b.is_prospect
"""


def _sql(statement):
    needed = {}

    def visit(text):
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed[name] = None
                visit(CTES[name])

    visit(statement)
    ordered = [name for name in CTES if name in needed]
    if not ordered:
        return statement
    steps = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in ordered)
    return f"WITH {steps}\n{statement.strip()}"


def oracle(name, statement):
    ORACLES[name] = _sql(statement)


# A: sources, extraction, sinks

_RAW_COLUMNS = {
    "greenhouse_openings": "id record_id created_at updated_at source run_id raw_file existing_used department_ids location office_ids opening_link opening_title",
    "greenhouse_departments": "id record_id created_at updated_at source run_id raw_file existing_used company_name department_category department_id department_name",
    "lever_openings": "id record_id created_at updated_at source run_id raw_file existing_used company_name department_names location opening_link opening_title workplace_type",
    "ashby_openings": "id record_id created_at updated_at company_name board_source run_id raw_file existing_used opening_id opening_name department_id location_id location_name employment_type compensation_tier opening_link",
    "ashby_departments": "id record_id created_at updated_at company_name board_source run_id raw_file existing_used department_id department_name parent_department_id",
    "ashby_locations": "id record_id created_at updated_at company_name board_source run_id raw_file existing_used opening_id secondary_location_id secondary_location_name",
    "rippling_openings": "id job_id created_at title url location board_token department run_id api_endpoint",
    "boards": "id url is_enabled is_prospect is_web_scraped job_board_provider board_token",
}


def _whole_rows(names, more=""):
    parts = []
    for name in names:
        values = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in sorted(_RAW_COLUMNS[name].split()))
        parts.append(f"SELECT '{name}' AS table_name, id, concat_ws('|', {values}) AS row_text{more} FROM {name}")
    return " UNION ALL ".join(parts)


oracle("typed_scan", _whole_rows(_RAW_COLUMNS))

oracle(
    "page_links",
    r"""
SELECT page_id, CAST(place - 1 AS BIGINT) AS link_index, href, link_text
FROM (SELECT page_id, generate_subscripts(tags, 1) AS place,
             unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href,
             nullif(unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)), '') AS link_text
      FROM (SELECT *, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>') AS tags FROM pages))
""",
)

def _html_key(kind, *places):
    parts = [f"'{kind}'", "source", "run_id", "fetched_at", "page_number", *places]
    return f"sha256(concat_ws('|', {', '.join(parts)}))"


CTES["classic_openings"] = """
SELECT *, id // 1000 AS page_number, max(updated_at) OVER page AS fetched_at, row_number() OVER (page ORDER BY id) - 1 AS place
FROM greenhouse_openings WHERE source NOT LIKE 'https://job-boards.%'
WINDOW page AS (PARTITION BY source, run_id, id // 1000)
"""

_FIRST_SEEN = "fetched_at - CASE WHEN fetched_at % 3 = 0 THEN 86400 ELSE 0 END"
_FILE = "run_id || '/' || source || '/' || page_number AS raw_file, fetched_at % 3 = 0 AS existing_used"
_STAMP = f"{_FIRST_SEEN} AS created_at, fetched_at AS updated_at, source, run_id, {_FILE}"

oracle(
    "extract_openings",
    f"""
SELECT {_html_key('opening', 'place')} AS record_id, {_STAMP}, nullif(department_ids, '') AS department_ids, location,
       office_ids, opening_link, opening_title
FROM classic_openings
""",
)

CTES["classic_departments"] = """
SELECT *, id // 10000 AS page_number, max(created_at) OVER page AS fetched_at, row_number() OVER (page ORDER BY id) - 1 AS place
FROM greenhouse_departments WHERE source NOT LIKE 'https://job-boards.%'
WINDOW page AS (PARTITION BY source, run_id, id // 10000)
"""

oracle(
    "extract_departments",
    f"""
SELECT {_html_key('department', 'place')} AS record_id,
       {_STAMP},
       company_name, department_category, department_id, department_name
FROM classic_departments
""",
)

CTES["paged_openings"] = """
SELECT *, split_part(source, '/', -1) AS company_name, id // 1000 AS page_number,
       max(updated_at) OVER page AS fetched_at, dense_rank() OVER (page ORDER BY office_ids) - 1 AS group_place,
       row_number() OVER (PARTITION BY source, run_id, id // 1000, office_ids ORDER BY id) - 1 AS place
FROM greenhouse_openings WHERE source LIKE 'https://job-boards.%'
WINDOW page AS (PARTITION BY source, run_id, id // 1000)
"""

oracle(
    "extract_paged",
    f"""
SELECT {_html_key('paged opening', 'group_place', 'place')} AS record_id, {_STAMP},
       company_name || '_' || office_ids AS department_ids, location, CAST(NULL AS VARCHAR) AS office_ids,
       opening_link, opening_title
FROM paged_openings
""",
)

oracle(
    "extract_paged_departments",
    f"""
SELECT DISTINCT {_html_key('paged department', 'group_place')} AS record_id, {_STAMP}, company_name,
       'level-0' AS department_category, company_name || '_' || office_ids AS department_id, office_ids AS department_name
FROM paged_openings
""",
)

CTES["grouped_openings"] = """
SELECT l.*, s.event_type AS header, s.n_name AS label, id // 1000 AS page_number,
       max(updated_at) OVER page AS fetched_at,
       dense_rank() OVER (page ORDER BY s.event_type, s.n_name) - 1 AS group_place,
       row_number() OVER (PARTITION BY l.source, l.run_id, id // 1000, s.event_type, s.n_name ORDER BY id) - 1 AS place
FROM lever_openings l JOIN sightings s ON l.id = s.event_id
WINDOW page AS (PARTITION BY l.source, l.run_id, id // 1000)
"""

oracle(
    "extract_grouped",
    f"""
SELECT {_html_key('grouped opening', 'group_place', 'place')} AS record_id, {_STAMP}, company_name,
       CASE WHEN company_name IN ('company5', 'company13') THEN label ELSE header || ' – ' || label END AS department_names,
       location, opening_link, opening_title, workplace_type
FROM grouped_openings
""",
)

oracle(
    "decode_props",
    r"SELECT event_id, CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS BIGINT) AS k FROM events",
)

CTES["response_postings"] = """
SELECT *, max(updated_at) OVER page AS fetched_at, row_number() OVER (page ORDER BY id) - 1 AS place
FROM ashby_openings WINDOW page AS (PARTITION BY board_source, run_id, id // 1000)
"""

CTES["response_pages"] = """
SELECT board_source, run_id, id // 1000 AS page_number, max(updated_at) AS fetched_at FROM ashby_openings GROUP BY ALL
"""

_JSON_STAMP = "fetched_at AS created_at, fetched_at AS updated_at, company_name, board_source, run_id, raw_file, false AS existing_used"


def _json_key(kind, *places):
    return f"sha256(concat_ws('|', {', '.join([repr(kind), 'board_source', 'run_id', 'fetched_at', *places])}))"


oracle(
    "decode_postings",
    f"""
SELECT {_json_key('posting', 'place')} AS record_id, {_JSON_STAMP}, opening_id, opening_name, department_id, location_id,
       location_name, employment_type, compensation_tier, opening_link
FROM response_postings
""",
)

oracle(
    "decode_locations",
    f"""
SELECT {_json_key('location', 'place', 'child')} AS record_id, {_JSON_STAMP}, opening_id, secondary_location_id, secondary_location_name
FROM (SELECT p.company_name, p.board_source, p.run_id, p.raw_file, p.fetched_at, p.place, p.opening_id, l.secondary_location_id,
             l.secondary_location_name, row_number() OVER (PARTITION BY p.id ORDER BY l.id) - 1 AS child
      FROM response_postings p JOIN ashby_locations l ON p.id = l.id // 10)
""",
)

oracle(
    "decode_teams",
    f"""
SELECT {_json_key('team', 'place')} AS record_id, {_JSON_STAMP}, department_id, department_name, parent_department_id
FROM (SELECT d.*, r.fetched_at, row_number() OVER (PARTITION BY d.board_source, d.run_id, d.id // 10000 ORDER BY d.id) - 1 AS place
      FROM ashby_departments d JOIN response_pages r
        ON d.board_source = r.board_source AND d.run_id = r.run_id AND d.id // 10000 = r.page_number)
""",
)

CTES["flat_rows"] = """
SELECT r.*, i, concat(location, '/', i) AS label FROM rippling_openings r JOIN (VALUES (0), (1), (2)) c(i) ON i <= id % 3
"""

oracle(
    "decode_flat_board",
    """
SELECT job_id || '#' || id AS job_id, title, url, string_agg(label, ', ' ORDER BY i) AS location,
       board_token, department, run_id, api_endpoint
FROM flat_rows GROUP BY id, job_id, title, url, board_token, department, run_id, api_endpoint
""",
)

oracle(
    "reject_split",
    """
SELECT board_source AS board, run_id, fetched_at,
       CASE fetched_at % 7 WHEN 0 THEN 'decode_error' WHEN 1 THEN 'no_board' WHEN 2 THEN 'no_postings' WHEN 3 THEN 'decode_error' END AS reason
FROM response_pages
""",
)

CTES["flat_pages"] = """
SELECT DISTINCT api_endpoint AS board, run_id, id // 1000 AS page,
       CASE dayofyear(CAST(run_id AS DATE)) % 7 WHEN 0 THEN 'decode_error' WHEN 1 THEN 'no_postings' END AS reason
FROM rippling_openings
"""

oracle("reject_split_flat", "SELECT board, run_id, CAST(0 AS BIGINT) AS fetched_at, reason FROM flat_pages")

oracle(
    "stamp_run",
    """
SELECT event_id, user_id, event_type, CAST(1706572800 AS BIGINT) AS created_at, CAST(1706572800 AS BIGINT) AS updated_at,
       'company' || (user_id % 20) AS company_name, 'https://jobs.lever.co/company' || (user_id % 20) AS source,
       '2024-01-30' AS run_id, CAST(NULL AS VARCHAR) AS raw_file, false AS existing_used
FROM events
""",
)

oracle(
    "first_and_last_words",
    r"""
SELECT doc_id, regexp_extract(text, '[^ \t\n\r\f\v]+') AS first_word,
       regexp_extract(text, '([^ \t\n\r\f\v]+)[ \t\n\r\f\v]*$', 1) AS last_word,
       regexp_extract(text, '[^\n]+') AS first_line
FROM documents
""",
)

_LOADED = [name for name in _RAW_COLUMNS if name != "boards"]
oracle(
    "append_runs",
    _whole_rows(_LOADED, ", 'parquet' AS stored_as") + " UNION ALL " + _whole_rows(_LOADED, ", 'json' AS stored_as"),
)

_EPOCH_TABLES = [
    "greenhouse_openings",
    "greenhouse_departments",
    "lever_openings",
    "ashby_openings",
    "ashby_departments",
    "ashby_locations",
]


def _by_load_time(sign):
    parts = [
        f"SELECT '{t}' AS table_name, id FROM {t} WHERE updated_at {sign} 1705968000" for t in _EPOCH_TABLES
    ]
    parts.append(
        f"SELECT 'rippling_openings', id FROM rippling_openings WHERE created_at {sign} TIMESTAMP '2024-01-23 00:00:00'"
    )
    return " UNION ALL ".join(parts)


oracle("archive_roundtrip", _by_load_time("<"))
oracle("retained_rows", _by_load_time(">="))
oracle("landed_in_parts", _whole_rows(_LOADED))
oracle("late_rows", f"{_by_load_time('>=')} UNION ALL SELECT * FROM ({_by_load_time('<')}) WHERE id % 2 = 1")
oracle(
    "archive_repeated",
    f"SELECT *, 'archive' AS place FROM ({_by_load_time('<')}) UNION ALL SELECT *, 'table' FROM ({_by_load_time('>=')})",
)

oracle(
    "published_layers",
    """
SELECT *, 'all_postings' AS mart FROM mart UNION ALL SELECT *, 'active_postings' FROM active
UNION ALL SELECT *, 'active_selected' FROM selected UNION ALL SELECT *, 'active_prospect' FROM prospect
""",
)

_GOOD = "fetched_at % 7 > 3"


def _landed(name, columns, rows):
    values = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns.split())
    return f"SELECT '{name}' AS table_name, concat_ws('|', {values}) AS row_text FROM ({rows})"


_PAGE_ROW = "record_id run_id created_at updated_at raw_file existing_used"
CTES["response_locations"] = """
SELECT p.*, row_number() OVER (PARTITION BY p.id ORDER BY l.id) - 1 AS child FROM response_postings p JOIN ashby_locations l ON p.id = l.id // 10
"""
CTES["response_teams"] = """
SELECT d.* EXCLUDE (created_at, updated_at), r.fetched_at,
       row_number() OVER (PARTITION BY d.board_source, d.run_id, d.id // 10000 ORDER BY d.id) - 1 AS place
FROM ashby_departments d JOIN response_pages r ON d.board_source = r.board_source AND d.run_id = r.run_id AND d.id // 10000 = r.page_number
"""
CTES["unknown_pages"] = """
SELECT DISTINCT replace(source, 'jobs.lever.co', 'careers.unknown.org') AS source, run_id, page_number, fetched_at FROM grouped_openings
"""


def _response_row(key):
    return f"SELECT {key} AS record_id, run_id, fetched_at AS created_at, fetched_at AS updated_at, NULL AS raw_file, false AS existing_used"


oracle(
    "landed_rows",
    " UNION ALL ".join(
        [
            _landed("greenhouse_openings", _PAGE_ROW, f"SELECT {_html_key('opening', 'place')} AS record_id, {_STAMP} FROM classic_openings"),
            _landed("greenhouse_openings", _PAGE_ROW, f"SELECT {_html_key('paged opening', 'group_place', 'place')} AS record_id, {_STAMP} FROM paged_openings"),
            _landed("greenhouse_departments", _PAGE_ROW, f"SELECT {_html_key('department', 'place')} AS record_id, {_STAMP} FROM classic_departments"),
            _landed("greenhouse_departments", _PAGE_ROW, f"SELECT DISTINCT {_html_key('paged department', 'group_place')} AS record_id, {_STAMP} FROM paged_openings"),
            _landed("lever_openings", _PAGE_ROW, f"SELECT {_html_key('grouped opening', 'group_place', 'place')} AS record_id, {_STAMP} FROM grouped_openings"),
            _landed("ashby_openings", _PAGE_ROW, f"{_response_row(_json_key('posting', 'place'))} FROM response_postings WHERE {_GOOD}"),
            _landed("ashby_locations", _PAGE_ROW, f"{_response_row(_json_key('location', 'place', 'child'))} FROM response_locations WHERE {_GOOD}"),
            _landed("ashby_departments", _PAGE_ROW, f"{_response_row(_json_key('team', 'place'))} FROM response_teams WHERE {_GOOD}"),
            _landed("rippling_openings", "job_id run_id created_at", "SELECT job_id || '#' || id AS job_id, run_id, TIMESTAMP '2024-01-30 12:00:00' AS created_at FROM rippling_openings WHERE dayofyear(CAST(run_id AS DATE)) % 7 > 1"),
            _landed("rejected", "kind source run_id fetched_at reason", "SELECT 'page' AS kind, source, run_id, fetched_at, 'unknown_board' AS reason FROM unknown_pages"),
            _landed("rejected", "kind source run_id fetched_at reason", "SELECT 'flat response' AS kind, board AS source, run_id, 0 AS fetched_at, reason FROM flat_pages WHERE reason IS NOT NULL"),
            _landed(
                "rejected",
                "kind source run_id fetched_at reason",
                "SELECT 'nested response' AS kind, board_source AS source, run_id, fetched_at, CASE fetched_at % 7 WHEN 1 THEN 'no_board' WHEN 2 THEN 'no_postings' ELSE 'decode_error' END AS reason FROM response_pages WHERE fetched_at % 7 <= 3",
            ),
        ]
    ),
)

# B: projections, filters, derived columns

oracle(
    "epoch_dates",
    """
SELECT id, make_timestamp(updated_at * 1000000) AS updated_at_utc,
       CAST(make_timestamp(updated_at * 1000000) AS DATE) AS updated_date_utc
FROM all_lever_openings
""",
)

oracle(
    "link_parts",
    f"""
SELECT id, split_part(source, '.', 2) AS provider, {_FULL_LINK} AS is_full_link, {_GREENHOUSE_LINK} AS full_opening_link,
       {_GREENHOUSE_COMPANY} AS company_name,
       CASE WHEN source LIKE '%for=%' THEN split_part(source, 'for=', -1) ELSE split_part(split_part(source, '/', -1), '?', 1) END AS page_company,
       source AS board_url, split_part(source, '.', 2) || '_' || id AS public_id, department_ids || '_' || id AS strict_id
FROM all_greenhouse_openings
""",
)

oracle(
    "token_companies",
    """
SELECT id, replace(split_part(board_source, '/', -1), '%20', ' ') AS company_name, board_source || '/' || opening_id AS opening_link
FROM all_ashby_openings
""",
)

oracle(
    "defaults_and_blanks",
    """
SELECT id, coalesce(department_ids, 'No Dept') AS department_ids, nullif(department_ids, '') AS listed_ids,
       CASE WHEN department_ids IS NULL THEN 'No Department' END AS shown_as, existing_used AS uses_existing
FROM all_greenhouse_openings
""",
)

oracle(
    "remote_flag",
    """
SELECT id, lower(location) LIKE '%remote%' AS is_remote FROM all_greenhouse_openings
UNION ALL SELECT id, workplace_type = 'Remote' FROM all_lever_openings
""",
)

oracle("since_cutoff", "SELECT id, record_id, updated_at FROM all_greenhouse_departments WHERE updated_at > 1684600000")

CTES["rippling_days"] = "SELECT id, url, CAST(created_at AS DATE) AS day FROM all_rippling_openings"

CTES["rippling_spans"] = "SELECT url, min(day) AS first_day, max(day) AS last_day FROM rippling_days GROUP BY url"

oracle(
    "length_bucket",
    f"""
SELECT *, {_BUCKET} AS posting_length_category
FROM (SELECT id, day = DATE '2024-01-30' AS is_active, CAST(last_day - first_day + 1 AS BIGINT) AS days_active
      FROM rippling_days JOIN rippling_spans USING (url))
""",
)

oracle("opening_category", f"SELECT doc_id, {_category('source', 'lang', 'text')} AS opening_category FROM documents")

oracle(
    "enabled_boards",
    """
SELECT DISTINCT 'url' AS kind, url AS board FROM boards WHERE is_enabled
UNION ALL SELECT DISTINCT 'token', board_token FROM boards WHERE is_enabled AND job_board_provider = 'rippling'
""",
)

# C: joins

oracle("department_lookup", "SELECT * FROM greenhouse_lookup")

oracle(
    "hierarchy_path",
    """
SELECT o.id, o.department_id, coalesce(p.department_name, d.department_name) AS primary_department,
       CASE WHEN p.department_name IS NOT NULL THEN d.department_name END AS secondary_department
FROM all_ashby_openings o
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY department_id ORDER BY updated_at DESC, id) AS n FROM all_ashby_departments) WHERE n = 1) d
       ON o.department_id = d.department_id
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY department_id ORDER BY updated_at DESC, id) AS n FROM all_ashby_departments) WHERE n = 1) p
       ON d.parent_department_id = p.department_id
""",
)

oracle("location_text", "SELECT id, opening_id, location FROM ashby_places")
oracle("department_paths", "SELECT id, opening_id, primary_department, secondary_department FROM ashby_paths")

oracle(
    "with_group_values",
    "SELECT id, source, run_id, count(*) OVER (PARTITION BY source) AS board_rows FROM all_lever_openings",
)

oracle(
    "combined_on_id",
    "SELECT id, opening_id, compensation_tier, department_id FROM all_ashby_openings WHERE compensation_tier IS NOT NULL AND department_id <> 'missing'",
)

oracle(
    "board_postings",
    """
SELECT l.id, l.source, b.id AS board_id, b.url AS board_url, b.is_enabled AS board_is_enabled, b.is_prospect AS board_is_prospect,
       b.is_web_scraped AS board_is_web_scraped, b.job_board_provider AS board_job_board_provider, b.board_token AS board_board_token
FROM all_lever_openings l JOIN boards b ON l.source = regexp_replace(b.url, '/$', '')
""",
)

oracle(
    "explode_list",
    "SELECT id, department_ids, unnest(string_split(department_ids, ',')) AS department_id FROM all_greenhouse_openings WHERE department_ids <> ''",
)

oracle(
    "explode_path_ordinal",
    """
SELECT id, department_names, trim(unnest(string_split(department_names, '–'))) AS department_name,
       generate_subscripts(string_split(department_names, '–'), 1) AS department_level
FROM all_lever_openings WHERE department_names <> ''
""",
)

# D: aggregations

oracle(
    "lifespan",
    """
SELECT id, url, seen_on, min(seen_on) OVER link AS earliest_opening_date, max(seen_on) OVER link AS latest_opening_date,
       CAST(max(seen_on) OVER link - min(seen_on) OVER link + 1 AS BIGINT) AS days_active
FROM (SELECT id, url, CAST(created_at AS DATE) AS seen_on FROM all_rippling_openings)
WINDOW link AS (PARTITION BY url)
""",
)

oracle(
    "child_concat",
    """
SELECT opening_id, run_id, string_agg(secondary_location_name, ', ' ORDER BY id) AS secondary_locations
FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY updated_at, id) AS n FROM all_ashby_locations)
WHERE n = 1 GROUP BY opening_id, run_id
""",
)

oracle(
    "concat_all_but_one",
    """
SELECT job_id, title, run_id, string_agg(label, ', ' ORDER BY id, i) AS label
FROM (SELECT * FROM flat_rows QUALIFY row_number() OVER (PARTITION BY job_id, run_id, label ORDER BY id, i) = 1)
GROUP BY job_id, title, run_id
""",
)

oracle(
    "pivot_by_level",
    """
SELECT source, run_id, max(CASE WHEN department_category = 'level-0' THEN department_name END) AS primary_department,
       max(CASE WHEN department_category = 'level-1' THEN department_name END) AS secondary_department,
       max(CASE WHEN department_category = 'level-2' THEN department_name END) AS tertiary_department,
       max(CASE WHEN department_category = 'level-3' THEN department_name END) AS quaternary_department
FROM all_greenhouse_departments GROUP BY source, run_id
""",
)

oracle(
    "pivot_by_ordinal",
    """
SELECT id, max(CASE WHEN place = 1 THEN step END) AS primary_department, max(CASE WHEN place = 2 THEN step END) AS secondary_department,
       max(CASE WHEN place = 3 THEN step END) AS tertiary_department, max(CASE WHEN place = 4 THEN step END) AS quaternary_department
FROM (SELECT id, trim(unnest(string_split(department_names, '–'))) AS step,
             generate_subscripts(string_split(department_names, '–'), 1) AS place
      FROM all_lever_openings WHERE department_names <> '')
GROUP BY id
""",
)

oracle(
    "run_counts",
    """
SELECT run_id, source, 'greenhouse' AS job_board, count(*) AS num_rows, count(DISTINCT opening_link) AS num_source_openings FROM greenhouse_openings GROUP BY run_id, source
UNION ALL SELECT run_id, source, 'lever', count(*), count(DISTINCT opening_link) FROM lever_openings GROUP BY run_id, source
UNION ALL SELECT run_id, board_source, 'ashby', count(*), count(DISTINCT opening_link) FROM ashby_openings GROUP BY run_id, board_source
""",
)

oracle("distinct_postings", "SELECT DISTINCT source, company_name, opening_link, opening_title FROM all_lever_openings")

# E: windows

oracle(
    "first_seen",
    """
SELECT id, record_id, updated_at FROM all_lever_openings
QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY updated_at, id) = 1
""",
)

CTES["all_ashby_first"] = _first_openings("all_ashby_openings")

oracle("first_seen_per_day", "SELECT id, record_id, opening_link, updated_date_utc AS day FROM all_ashby_first")

oracle(
    "first_seen_two_keys",
    """
SELECT id, record_id, department_id, run_id FROM all_greenhouse_departments
QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY updated_at, id) = 1
    AND row_number() OVER (PARTITION BY department_id, run_id ORDER BY updated_at, id) = 1
""",
)

oracle(
    "latest_name",
    """
SELECT id, department_id, department_name, updated_at FROM all_ashby_departments
QUALIFY row_number() OVER (PARTITION BY department_id ORDER BY updated_at DESC, id) = 1
""",
)

oracle(
    "first_daily",
    "SELECT id, url, day FROM rippling_days QUALIFY row_number() OVER (PARTITION BY url, day ORDER BY id) = 1",
)

oracle(
    "header_fill",
    """
SELECT event_id, event_type, last_value(CASE WHEN value > 40 THEN user_id END IGNORE NULLS) OVER (
         PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header
FROM events
""",
)

oracle(
    "keyed_ids",
    """
SELECT event_id, sha256(concat_ws('|', 'posting', event_id, user_id, CASE WHEN value > 40 THEN event_type ELSE '' END)) AS record_id
FROM events
""",
)

# K: checks

oracle("check_not_null", "SELECT id, record_id FROM all_lever_openings WHERE department_names IS NULL")

oracle(
    "check_unique",
    "SELECT record_id, count(*) AS occurrences FROM all_ashby_departments GROUP BY record_id HAVING count(*) > 1",
)

oracle(
    "check_unique_where",
    """
SELECT record_id, count(*) AS occurrences FROM all_greenhouse_departments WHERE department_category <> 'level-2'
GROUP BY record_id HAVING count(*) > 1
""",
)

oracle(
    "check_accepted",
    """
SELECT job_board, count(*) AS occurrences FROM unified
WHERE job_board NOT IN ('greenhouse', 'lever', 'ashby') GROUP BY job_board
""",
)

oracle(
    "check_columns",
    """
SELECT count(*) AS row_count, 'company_name,department_names,workplace_type' AS missing, 'department_ids,office_ids' AS unexpected, 'raw' AS dataset
FROM greenhouse_openings
UNION ALL
SELECT count(*), 'days_active,earliest_opening_date,is_active,latest_opening_date,opening_category,posting_length_category', '', 'unified' FROM unified
""",
)


def _freshness():
    parts = []
    for name in [*_EPOCH_TABLES, "rippling_openings"]:
        latest = "max(created_at)" if name == "rippling_openings" else "make_timestamp(max(updated_at) * 1000000)"
        for label, now in (("today", "2024-01-30 12:00:00"), ("later", "2024-02-01 10:00:00")):
            parts.append(
                f"SELECT '{name} {label}' AS table_name, {latest} AS latest, TIMESTAMP '{now}' AS now FROM {name}"
            )
    return f"""
SELECT table_name, latest, CAST(epoch(now) - epoch(latest) AS BIGINT) AS age_seconds,
       CASE WHEN latest IS NULL OR epoch(now) - epoch(latest) > 172800 THEN 'error'
            WHEN epoch(now) - epoch(latest) > 86400 THEN 'warn' ELSE 'pass' END AS verdict
FROM ({' UNION ALL '.join(parts)})
"""


oracle("check_freshness", _freshness())

CTES["expected_sources"] = "SELECT DISTINCT regexp_replace(url, '/$', '') AS expected_source FROM boards WHERE is_enabled"

CTES["actual_sources"] = "SELECT DISTINCT source AS actual_source FROM active"

CTES["unreconciled"] = """
SELECT * FROM expected_sources FULL JOIN actual_sources ON expected_source = actual_source
WHERE expected_source IS NULL OR actual_source IS NULL
"""

oracle("reconcile_boards", "SELECT * FROM unreconciled")

oracle(
    "reconcile_boards_excluding",
    "SELECT * FROM unreconciled WHERE expected_source IS DISTINCT FROM 'https://jobs.lever.co/quiet0'",
)

oracle(
    "returning_postings",
    """
SELECT full_opening_link, count(DISTINCT created_date_utc) AS days_seen, max(days_active) AS days_active FROM mart
GROUP BY full_opening_link HAVING count(DISTINCT created_date_utc) <> max(days_active)
""",
)

CTES["distorted"] = """
SELECT * REPLACE (days_active + CASE WHEN is_remote THEN 1 ELSE 0 END AS days_active) FROM mart
"""

oracle(
    "returning_postings_by_days",
    """
SELECT id, full_opening_link, days_active, expected_days_active
FROM (SELECT *, row_number() OVER (PARTITION BY full_opening_link, created_date_utc ORDER BY id) AS daily_row FROM distorted)
JOIN (SELECT DISTINCT full_opening_link, days_active AS expected_days_active FROM distorted) USING (full_opening_link)
WHERE daily_row = 1 AND is_active AND expected_days_active <> days_active
""",
)

CTES["raw_links"] = """
SELECT run_id, source, 'greenhouse' AS raw_job_board, count(DISTINCT opening_link) AS num_source_openings FROM greenhouse_openings GROUP BY run_id, source
UNION ALL SELECT run_id, source, 'lever', count(DISTINCT opening_link) FROM lever_openings GROUP BY run_id, source
UNION ALL SELECT run_id, board_source, 'ashby', count(DISTINCT opening_link) FROM ashby_openings GROUP BY run_id, board_source
"""

oracle(
    "active_count_match",
    """
SELECT run_id, source, job_board, num_openings, raw_job_board, num_source_openings
FROM (SELECT run_id, source, job_board, count(*) AS num_openings FROM active GROUP BY run_id, source, job_board)
JOIN raw_links USING (run_id, source) WHERE num_openings <> num_source_openings
""",
)

_FAILURES = {
    "lever department_names not null": ("SELECT 1 FROM lever_openings WHERE department_names IS NULL", "error", 1),
    "lever department_names not null, warn only": ("SELECT 1 FROM lever_openings WHERE department_names IS NULL", "warn", 1),
    "mart id not null": ("SELECT 1 FROM mart WHERE id IS NULL", "error", 1),
    "mart id unique": ("SELECT id FROM mart GROUP BY id HAVING count(*) > 1", "error", 1),
    "mart length category accepted": (
        "SELECT DISTINCT posting_length_category FROM mart WHERE posting_length_category NOT IN ('Inactive', 'Stale', 'Old', 'Medium', 'Recent', 'New')",
        "error",
        1,
    ),
    "mart opening category accepted": (
        "SELECT DISTINCT opening_category FROM mart WHERE opening_category NOT IN ('Data', 'Software Engineering', 'Product', 'Sales', 'Finance & Accounting', 'Operations', 'Other')",
        "error",
        1,
    ),
    "mart job board accepted": (
        "SELECT DISTINCT job_board FROM mart WHERE job_board NOT IN ('greenhouse', 'lever', 'ashby')",
        "error",
        1,
    ),
    "department category accepted": (
        "SELECT DISTINCT department_category FROM greenhouse_departments WHERE department_category NOT IN ('level-0', 'level-1', 'level-2', 'level-3', 'level-4')",
        "warn",
        1,
    ),
    "boards reconciled": ("SELECT 1 FROM unreconciled", "error", 10),
}

oracle(
    "check_verdicts",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS check_name, count(*) AS failures,
       CASE WHEN '{severity}' = 'error' AND count(*) >= {error_at} THEN 'error' WHEN count(*) >= 1 THEN 'warn' ELSE 'pass' END AS verdict
FROM ({failing})"""
        for name, (failing, severity, error_at) in _FAILURES.items()
    ),
)

# What each dataset has to hold: filled, filled (warning), unique, unique where, accepted, accepted (warning), age.

_ROLES = ["Data", "Software Engineering", "Product", "Sales", "Finance & Accounting", "Operations", "Other"]
_LENGTHS = ["Inactive", "Stale", "Old", "Medium", "Recent", "New"]
_HTML = "id record_id created_at updated_at source"
_JSON = "id record_id created_at updated_at board_source company_name"
_DECLARED_RAW = {
    "greenhouse_departments": (f"{_HTML} company_name", "", "id", {}, {}, {"department_category": ["level-0", "level-1", "level-2", "level-3", "level-4"]}, "updated_at"),
    "greenhouse_openings": (f"{_HTML} opening_link opening_title", "location", "id", {}, {}, {}, "updated_at"),
    "lever_openings": (f"{_HTML} department_names opening_link opening_title", "location", "id", {}, {"workplace_type": ["On-site", "Remote", "Hybrid"]}, {}, "updated_at"),
    "ashby_departments": (_JSON, "", "id", {}, {}, {}, "updated_at"),
    "ashby_locations": (_JSON, "", "id", {}, {}, {}, "updated_at"),
    "ashby_openings": (f"{_JSON} opening_id opening_name location_id location_name", "", "id", {}, {"employment_type": ["Intern", "Contract", "PartTime", "FullTime", "Temporary"]}, {}, "updated_at"),
    "rippling_openings": ("id job_id created_at title url location board_token department run_id api_endpoint", "", "id", {}, {}, {}, "created_at"),
    "boards": ("id url", "", "id url", {}, {}, {}, None),
}
_DECLARED_STAGED = {n: ("", "", "", {}, {"job_board": [b]}, {}, None) for n, b in (("greenhouse_departments", "greenhouse"), ("greenhouse", "greenhouse"), ("lever", "lever"))}


def _mart_rules(boards, unique, where):
    return ("id record_id", "", unique, where, {"posting_length_category": _LENGTHS, "opening_category": _ROLES, "job_board": boards}, {}, None)


_DECLARED_MARTS = {
    "all_postings": _mart_rules(["greenhouse", "lever", "ashby", "rippling"], "id", {"record_id": "job_board <> 'rippling'"}),
    "active_postings": _mart_rules(["greenhouse", "lever", "ashby", "rippling"], "id record_id", {}),
    "active_selected": _mart_rules(["greenhouse", "lever", "ashby"], "id record_id", {}),
    "active_prospect": _mart_rules(["greenhouse", "lever", "ashby", "rippling"], "id record_id", {}),
}


def _declared(rules, tables):
    rows = []

    def row(name, check, column, failures, severity="error"):
        rows.append(
            f"""SELECT '{name}' AS dataset, '{check}' AS check_name, '{column}' AS column_name, failures,
       CASE WHEN failures > 0 THEN '{severity}' ELSE 'pass' END AS verdict FROM ({failures})"""
        )

    for name, (filled, filled_warn, unique, unique_where, accepted, accepted_warn, loaded_at) in rules.items():
        table = tables[name]
        row(name, "columns match", "", "SELECT CAST(0 AS BIGINT) AS failures")
        for severity, columns in (("error", filled), ("warn", filled_warn)):
            for column in columns.split():
                row(name, "not null", column, f"SELECT count(*) - count({column}) AS failures FROM {table}", severity)
        for column, where in {**dict.fromkeys(unique.split(), "true"), **unique_where}.items():
            repeated = f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL AND {where} GROUP BY 1 HAVING count(*) > 1"
            row(name, "unique", column, f"SELECT count(*) AS failures FROM ({repeated})")
        for severity, lists in (("error", accepted), ("warn", accepted_warn)):
            for column, values in lists.items():
                known = ", ".join(f"'{v}'" for v in values)
                other = f"SELECT count(DISTINCT {column}) AS failures FROM {table} WHERE {column} NOT IN ({known})"
                row(name, "accepted values", column, other, severity)
        if loaded_at:
            latest = "max(created_at)" if loaded_at == "created_at" else "make_timestamp(max(updated_at) * 1000000)"
            age = f"SELECT epoch(TIMESTAMP '2024-01-30 12:00:00') - epoch({latest}) AS age FROM {table}"
            rows.append(
                f"""SELECT '{name}', 'freshness', '{loaded_at}', CAST(CASE WHEN age IS NULL OR age > 86400 THEN 1 ELSE 0 END AS BIGINT),
       CASE WHEN age IS NULL OR age > 172800 THEN 'error' WHEN age > 86400 THEN 'warn' ELSE 'pass' END FROM ({age})"""
            )
    return " UNION ALL ".join(rows)


oracle("declared_checks_raw", _declared(_DECLARED_RAW, {name: name for name in _DECLARED_RAW}))
oracle("declared_checks_staged", _declared(_DECLARED_STAGED, {n: f"staged_{n}" for n in _DECLARED_STAGED}))
oracle(
    "declared_checks_marts",
    _declared(
        _DECLARED_MARTS,
        {"all_postings": "mart", "active_postings": "active", "active_selected": "selected", "active_prospect": "prospect"},
    ),
)

oracle(
    "checks_across",
    """
SELECT 'boards' AS dataset, 'boards reconciled' AS check_name, '' AS column_name, count(*) AS failures,
       CASE WHEN count(*) >= 10 THEN 'error' WHEN count(*) >= 1 THEN 'warn' ELSE 'pass' END AS verdict FROM unreconciled
UNION ALL
SELECT 'all_postings', 'no returning postings', '', count(*), CASE WHEN count(*) >= 1 THEN 'warn' ELSE 'pass' END
FROM (SELECT full_opening_link FROM mart GROUP BY full_opening_link HAVING count(DISTINCT created_date_utc) <> max(days_active))
UNION ALL
SELECT 'all_postings', 'days open agree', '', count(*), CASE WHEN count(*) >= 1 THEN 'error' ELSE 'pass' END
FROM (SELECT full_opening_link FROM mart GROUP BY full_opening_link HAVING count(DISTINCT days_active) > 1)
UNION ALL
SELECT 'active_postings', 'active count match', '', count(*), CASE WHEN count(*) >= 1 THEN 'warn' ELSE 'pass' END
FROM (SELECT run_id, source, job_board, count(*) AS num_openings FROM active GROUP BY run_id, source, job_board)
JOIN raw_links USING (run_id, source) WHERE num_openings <> num_source_openings
""",
)

# L: datasets

for _name in (
    "greenhouse_departments",
    "greenhouse",
    "lever",
    "ashby",
    "ashby_departments",
    "ashby_locations",
    "rippling",
):
    oracle(f"staged_{_name}", f"SELECT * FROM staged_{_name}")

for _name in ("greenhouse", "lever", "ashby", "rippling"):
    oracle(f"unified_{_name}", f"SELECT * FROM unified_{_name}")

oracle("all_postings", "SELECT * FROM mart")
oracle("active_postings", "SELECT * FROM active")
oracle("active_selected", "SELECT * FROM selected")
oracle("active_prospect", "SELECT * FROM prospect")
