"""The daily job: raw tables to published layers."""

from datetime import date

from pyspark.sql import DataFrame

from jobtide.plans import marts
from jobtide.sinks.scratch import shared_folder
from jobtide.sinks.storage import Build, publish, sweep


def build(
    raw: dict[str, DataFrame],
    base: str | None = None,
    as_of: date | None = None,
    schema: str | None = None,
) -> dict[str, DataFrame]:
    """Publish staging views, intermediate tables and marts; returns the marts by name.

    Intermediate tables are stored, so the mart's two reads of the union cost two scans instead of
    two runs of everything before. The mart is partitioned on activity: its active subsets read
    nothing else. The marts become visible together, when all of them are written.
    """
    staged = {
        name: publish(df, "staging", f"staged_{name}")
        for name, df in marts.staged_tables(raw).items()
    }
    unified = {
        name: publish(df, "intermediate", f"unified_{name}", base, schema=schema)
        for name, df in marts.unified_tables(staged).items()
    }
    build = Build(raw["boards"].sparkSession, base, schema)
    mart = build.add(
        marts.all_postings(marts.union_unified(unified), as_of), "all_postings", ("is_active",)
    )
    subsets = {
        "active_postings": marts.active_postings(mart),
        "active_selected": marts.active_selected(mart, raw["boards"]),
        "active_prospect": marts.active_prospect(mart, raw["boards"]),
    }
    published = {name: build.add(df, name) for name, df in subsets.items()}
    build.switch()
    for name in unified:
        sweep(build.spark, f"{base or shared_folder(build.spark)}/intermediate/unified_{name}")
    return {"all_postings": mart, **published}
