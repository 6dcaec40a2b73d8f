"""Unified postings: every provider's departments and locations in the same 17 columns.

Staged ids are unique (a serial key, deduplicated), so a posting stays one row throughout and none
of the plans joins back on the id or needs a distinct.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.functions import is_remote, split_literal
from jobtide.operators.joins import attach_children, hierarchy_path, left_lookup
from jobtide.operators.reshape import concat_children, entries
from jobtide.schemas import UNIFIED

_LOOKUP = ["source", "department_id", "run_id"]


def conform(df: DataFrame) -> DataFrame:
    """The 17 columns by name, in order and type; a column the provider lacks is NULL."""
    known = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in known else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in UNIFIED
        ]
    )


def department_slots(openings: DataFrame) -> DataFrame:
    """One narrow row per listed department: the posting's id and what its department is looked up by."""
    own = ["id", "source", "run_id"]
    listed = openings.select(
        *own, split_literal(F.col("department_ids"), V.LIST_SEPARATOR).alias("_ids")
    )
    return entries(listed, "_ids", "_place", "department_id").drop("_ids")


def department_levels(slots: DataFrame, departments: DataFrame) -> DataFrame:
    """Of each posting (``id``) the greatest name per level among its departments in its own run."""
    dims = departments.select(*_LOOKUP, "department_category", "department_name")
    found = left_lookup(slots, dims, _LOOKUP)
    level, name = F.col("department_category"), F.col("department_name")
    first, *deeper = zip(V.DEPARTMENT_LEVELS, V.DEPARTMENT_COLUMNS, strict=True)
    none_listed = F.col("department_id") == V.NO_GROUP_LIST
    primary = F.when(level == first[0], name).when(none_listed, V.NO_GROUP_NAME)
    return found.groupBy("id").agg(
        F.max(primary).alias(first[1]),
        *[F.max(F.when(level == value, name)).alias(column) for value, column in deeper],
    )


def unify_greenhouse(openings: DataFrame, departments: DataFrame) -> DataFrame:
    """Postings with the departments looked up in their own run.

    The lookup and the levels are worked out on narrow rows; the posting itself is shuffled once, by
    its id, to where its levels are. A posting that lists no department drops out.
    """
    levels = department_levels(department_slots(openings), departments)
    carried = openings.select(*[c for c in UNIFIED.names if c in openings.columns])
    return conform(carried.join(levels, "id").withColumn("is_remote", is_remote(F.col("location"))))


def unify_lever(openings: DataFrame) -> DataFrame:
    """The first four steps of the department path; a posting without a path drops out.

    The path sits in the posting's own row, so its steps are picked there and nothing is shuffled.
    """
    path = split_literal(F.col("department_names"), V.PATH_SEPARATOR)
    steps = {
        name: F.trim(F.get(path, F.lit(place))) for place, name in enumerate(V.DEPARTMENT_COLUMNS)
    }
    listed = openings.where(F.col("department_names") != "")
    remote = F.col("workplace_type") == "Remote"
    return conform(listed.withColumns({**steps, "is_remote": remote}))


def ashby_departments(openings: DataFrame, departments: DataFrame) -> DataFrame:
    """Openings with the path of their team."""
    teams = departments.select(
        "id", "updated_at_utc", "department_id", "department_name", "parent_department_id"
    )
    return hierarchy_path(openings, teams, ["updated_at_utc", "id"])


def ashby_locations(openings: DataFrame, locations: DataFrame) -> DataFrame:
    """Openings with all their locations as one text, the primary one first."""
    keys = ["opening_id", "run_id"]
    children = concat_children(
        locations, keys, "secondary_location_name", "id", "_secondary_locations"
    )
    attached = attach_children(
        openings, children, keys, "location_name", "_secondary_locations", "location"
    )
    return attached.drop("_secondary_locations")


def unify_ashby(
    openings: DataFrame, locations: DataFrame, departments: DataFrame
) -> DataFrame:
    """Both added to the same opening rows, so the openings are read once."""
    placed = ashby_departments(ashby_locations(openings, locations), departments)
    return conform(placed.withColumn("is_remote", is_remote(F.col("location"))))
