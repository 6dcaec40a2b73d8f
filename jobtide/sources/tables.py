"""Typed scans of the raw tables and of the board dimension."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.schemas import RAW
from jobtide.sources import landings


def read_raw(
    spark: SparkSession,
    base: str,
    name: str,
    fmt: str = "parquet",
    from_day: date | None = None,
    before_day: date | None = None,
    **options,
) -> DataFrame:
    """A raw table under ``base`` with its declared schema; nothing is inferred.

    Of a landed table only the landings that count are read, as they are at this moment. ``from_day``
    skips the folders of earlier load days, ``before_day`` those of that day and later ones, and rows
    of an unknown day with them. Any file format or ``jdbc`` will do; for the latter pass ``url`` and
    the like as options.
    """
    schema = RAW[name]
    if fmt == "jdbc":
        rows = spark.read.format("jdbc").options(dbtable=name, **options).load()
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    path, reader = f"{base}/{name}", spark.read.format(fmt).schema(schema).options(**options)
    landed = landings.latest(landings.all_landings(spark, path))
    if landed:
        folders = [
            folder
            for landing in landed
            for day, folder in landings.days_of(spark, path, landing).items()
            if _wanted(day, from_day, before_day)
        ]
        if not folders:
            return spark.createDataFrame([], schema)
        rows = reader.option("basePath", path).load(folders)
    else:
        rows = reader.load(path)
    if from_day is not None:
        rows = rows.where(F.col("run_date") >= F.lit(from_day))
    if before_day is not None:
        rows = rows.where(F.col("run_date") < F.lit(before_day))
    return rows.select(*schema.names)


def _wanted(day: date | None, from_day: date | None, before_day: date | None) -> bool:
    if day is None:
        return from_day is None and before_day is None
    return (from_day is None or day >= from_day) and (before_day is None or day < before_day)


def enabled_boards(boards: DataFrame, provider: str | None = None) -> DataFrame:
    """Boards to process: URLs of the enabled ones, or board tokens of one provider's."""
    enabled = boards.where("is_enabled")
    if provider is None:
        return enabled.select("url").distinct()
    return enabled.where(F.col("job_board_provider") == provider).select("board_token").distinct()


def since(df: DataFrame, epoch: int, col: str = "updated_at") -> DataFrame:
    return df.where(F.col(col) > epoch)
