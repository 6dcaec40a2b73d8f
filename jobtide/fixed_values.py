"""Fixed values of the job-posting domain.

Everything here has to equal the established vocabulary for results to be right: list defaults,
separators, cutoffs, thresholds, keyword rules and accepted values.
"""

# Placeholder list of a posting without departments, and the name it is shown under.
NO_GROUP_LIST = "No Dept"
NO_GROUP_NAME = "No Department"

# Separators inside stored text: department ids, department paths, concatenated names.
LIST_SEPARATOR = ","
PATH_SEPARATOR = "–"  # en dash, not the normal hyphen
NAME_SEPARATOR = ", "

# Department rows updated at or before this epoch second are ignored.
DEPARTMENT_EPOCH = 1684600000

DEPARTMENT_COLUMNS = [
    "primary_department",
    "secondary_department",
    "tertiary_department",
    "quaternary_department",
]
DEPARTMENT_LEVELS = ["level-0", "level-1", "level-2", "level-3"]

# A posting open for more than so many days falls into the bucket; the first that holds wins.
LENGTH_BUCKETS = [(90, "Stale"), (60, "Old"), (30, "Medium"), (7, "Recent")]
LENGTH_SHORTEST = "New"
LENGTH_INACTIVE = "Inactive"

# Category, words looked for in departments and title, endings looked for in the title only.
CATEGORY_RULES = [
    ("Data", ["data", "analytics"], []),
    ("Software Engineering", ["engineer"], []),
    ("Sales", ["sales"], ["account executive"]),
    ("Finance & Accounting", ["finance", "accounting"], []),
    ("Operations", ["operations"], []),
    ("Product", ["product"], []),
]
CATEGORY_DEFAULT = "Other"

# Dimension ids up to this one form the selected boards.
SELECTED_BOARD_MAX_ID = 22

# Freshness limits in days and verdict thresholds in failing rows.
FRESH_WARN_DAYS = 1
FRESH_ERROR_DAYS = 2
RECONCILE_WARN_AT = 1
RECONCILE_ERROR_AT = 10

RETENTION_DAYS = 7

# Accepted values per column.
ACCEPTED = {
    "job_board": ["greenhouse", "lever", "ashby", "rippling"],
    "selected_job_board": ["greenhouse", "lever", "ashby"],
    "department_category": ["level-0", "level-1", "level-2", "level-3", "level-4"],
    "workplace_type": ["On-site", "Remote", "Hybrid"],
    "employment_type": ["Intern", "Contract", "PartTime", "FullTime", "Temporary"],
    "posting_length_category": ["Inactive", "Stale", "Old", "Medium", "Recent", "New"],
    "opening_category": [
        "Data",
        "Software Engineering",
        "Product",
        "Sales",
        "Finance & Accounting",
        "Operations",
        "Other",
    ],
}
