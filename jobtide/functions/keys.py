"""Surrogate keys and the two ways of concatenating with NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def skipping_concat(*parts: Column) -> Column:
    """Concatenate, treating NULL as nothing (Spark's own ``concat`` gives NULL instead)."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def namespaced_id(provider: Column, row_id: Column, skip_null: bool = True) -> Column:
    """``provider_id``; a NULL part is skipped, or makes the whole id NULL."""
    if skip_null:
        return skipping_concat(provider, F.lit("_"), row_id)
    return F.concat(provider, F.lit("_"), row_id.cast("string"))


def keyed_id(*parts: Column) -> Column:
    """Row id as a hash of separated parts, so (1, 11) and (11, 1) differ; NULL counts as empty."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)
