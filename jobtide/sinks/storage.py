"""Append, archive, retain and publish.

Writes carry a ``rebalance`` hint: adaptive execution merges small output partitions and cuts hot
ones, so a run day holding a third of the rows becomes many files of even size.
"""

import hashlib
import json
from datetime import date, datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide import files
from jobtide.fixed_values import RETENTION_DAYS
from jobtide.functions import epoch_to_utc
from jobtide.schemas import RAW
from jobtide.sinks.scratch import shared_folder
from jobtide.sources import landings
from jobtide.sources.landings import Landing

LAYERS = {"staging": None, "intermediate": None, "marts": "core"}

#: Bits of an id for the row in a task and the task of a landing; the landing's number is before them.
_ROW_BITS, _TASK_BITS = 26, 16
#: Numbers whose records are kept below the greatest.
_KEPT_NUMBERS = 100


def cutoff_day(as_of: date, days: int = RETENTION_DAYS) -> date:
    """The first load day to keep, so many days ago; load days are in UTC."""
    return as_of - timedelta(days=days)


# landing


def _claimed(spark: SparkSession, path: str) -> int:
    """A number for a landing that no other landing of the table has or gets.

    The greatest one is on record as a file, so none of the table's rows is read. A landing that
    fails leaves a number unused.
    """
    folder = f"{path}/_landings"
    taken = [int(name) for name in files.children(spark, folder)]
    number = max(taken, default=-1) + 1
    while not files.create(spark, f"{folder}/{number:09d}"):
        number += 1
    for old in taken:
        if old < number - _KEPT_NUMBERS:
            files.delete(spark, f"{folder}/{old:09d}")
    return number


def _land(df: DataFrame, path: str, fmt: str, label: str | None, number: int, folders: list[str]) -> Landing:
    """Write the rows of a landing aside, rename their folder to its own, and remove those it replaces."""
    spark, key = df.sparkSession, landings.key_of(label or uuid4().hex)
    landing, aside = Landing(key, number), f"{path}/_aside-{uuid4().hex}"
    df.write.partitionBy(*folders).format(fmt).save(aside)
    files.rename(spark, aside, f"{path}/{landing.folder}")
    for other in landings.all_landings(spark, path):
        if other.key == key and other.number < number:
            files.delete(spark, f"{path}/{other.folder}")
    return landing


def _spread(df: DataFrame) -> DataFrame:
    """Rows with their load day, shuffled into even partitions by it."""
    by_epoch = "updated_at" in df.columns
    loaded = epoch_to_utc(F.col("updated_at")) if by_epoch else F.col("created_at")
    return df.withColumn("run_date", F.to_date(loaded)).hint("rebalance", "run_date")


def append_raw(df: DataFrame, path: str, fmt: str = "parquet", landing: str | None = None) -> None:
    """Add rows to a raw table, in a folder per load day; an empty frame adds no file.

    ``landing`` labels what is added, such as a run's part. Landings of different labels add up. One
    of the same label replaces the earlier, whatever days it has, so that an interrupted landing can
    be repeated; without a label each call adds. ``fmt`` may be any file format, such as parquet, json
    or csv.
    """
    number = _claimed(df.sparkSession, path)
    _land(_spread(df), path, fmt, landing, number, ["run_date"])


def append_numbered(df: DataFrame, path: str, fmt: str = "parquet", landing: str | None = None) -> None:
    """The same with ids: unique, and greater than those of earlier landings, with gaps.

    An id is made of the landing's number, the writing task's and the row's in it. Ids are given out
    behind the last shuffle: a lost executor then makes a task write again as a whole, and never mixes
    two numberings of the same rows. A table can have 2 million landings, each of 65,536 tasks with
    67 million rows each; beyond that the landing fails.
    """
    number = _claimed(df.sparkSession, path)
    counted = _spread(df).withColumn("_row", F.monotonically_increasing_id())
    task, row = F.shiftright("_row", 33), F.col("_row").bitwiseAND((1 << 33) - 1)
    fits = (task < 1 << _TASK_BITS) & (row < 1 << _ROW_BITS) & F.lit(number < 1 << 21)
    first = F.lit(number << (_TASK_BITS + _ROW_BITS))
    made = F.when(fits, first + F.shiftleft(task, _ROW_BITS) + row)
    made = made.otherwise(F.raise_error(F.lit("more rows than ids")).cast("bigint"))
    _land(counted.withColumn("id", made).drop("_row"), path, fmt, landing, number, ["run_date"])


def append_rejected(df: DataFrame, path: str, fmt: str = "parquet", landing: str | None = None) -> None:
    """Add what a landing rejected, in a folder per kind, with the same effect of a repetition."""
    number = _claimed(df.sparkSession, path)
    _land(df.hint("rebalance"), path, fmt, landing, number, ["kind"])


# archive and retention


def _exports(spark: SparkSession, to: str, name: str) -> dict[str, dict[str, list[str]]]:
    """Of each export of a table on record: the days it holds of each landing."""
    folder = f"{to}/{name}/_exports"
    return {each: json.loads(files.read(spark, f"{folder}/{each}")) for each in files.children(spark, folder)}


def _held(spark: SparkSession, to: str, name: str) -> set[tuple[str, str]]:
    """Landing and day of all that is exported."""
    exports = _exports(spark, to, name).values()
    return {(landing, day) for held in exports for landing, days in held.items() for day in days}


def _old_folders(spark: SparkSession, path: str, before: date) -> dict[tuple[str, str], str]:
    """Folders of the load days before the given one, by landing and day."""
    return {
        (landing.name, day.isoformat()): folder
        for landing in landings.latest(landings.all_landings(spark, path))
        for day, folder in landings.days_of(spark, path, landing).items()
        if day is not None and day < before
    }


_PLACE = [T.StructField("landing", T.StringType()), T.StructField("run_date", T.DateType())]


def archive(
    spark: SparkSession, base: str, name: str, before: date, to: str, as_of: date, fmt: str = "parquet"
) -> list[date]:
    """Export the load days before the given one of a raw table that no export holds yet; their days.

    Each call adds an export of its own, Parquet files under the day ``as_of``, and when these are
    written a record of the days it holds of each landing. Nothing exported is ever written again, so
    a repeated call, also after the days were dropped, changes nothing; an export without a record,
    of a call that failed, is never read. Only the folders of the days to export are read.
    """
    path, held = f"{base}/{name}", _held(spark, to, name)
    wanted = {place: folder for place, folder in _old_folders(spark, path, before).items() if place not in held}
    if not wanted:
        return []
    reader = spark.read.format(fmt).schema(RAW[name]).option("basePath", path)
    rows = reader.load(list(wanted.values())).select(*RAW[name].names, F.col("landing").cast("string"), "run_date")
    export, days = f"{as_of}-{uuid4().hex}", {}
    rows.hint("rebalance").write.parquet(f"{to}/{name}/export={export}")
    for landing, day in wanted:
        days.setdefault(landing, []).append(day)
    files.create(spark, f"{to}/{name}/_exports/{export}", json.dumps(days))
    return sorted({date.fromisoformat(day) for _, day in wanted})


def read_archive(spark: SparkSession, to: str, name: str) -> DataFrame:
    """All rows of a raw table that were exported, each once.

    Where a landing was repeated after its export and exported again, only the later rows count.
    """
    schema, exports = T.StructType([*RAW[name].fields, *_PLACE]), _exports(spark, to, name)
    if not exports:
        return spark.createDataFrame([], RAW[name])
    found = [Landing.of(f"landing={landing}") for held in exports.values() for landing in held]
    replaced = {each.name for each in found} - {each.name for each in landings.latest(found)}
    rows = spark.read.schema(schema).parquet(*[f"{to}/{name}/export={export}" for export in exports])
    if replaced:
        rows = rows.where(~F.col("landing").isin(sorted(replaced)))
    return rows.select(*RAW[name].names)


def drop_days(spark: SparkSession, base: str, name: str, before: date, to: str) -> list[date]:
    """Drop the folders of a raw table's load days before the given one that the archive holds; their days.

    Rows that landed after the last export are in a folder of their own and stay until the next one
    holds them. Nothing that stays is read or written, a repeated call drops what an interrupted one
    left, and rows of an unknown day are kept. Let readers name a ``from_day`` so that none is on a
    folder that goes.
    """
    path, held = f"{base}/{name}", _held(spark, to, name)
    gone = {place: folder for place, folder in _old_folders(spark, path, before).items() if place in held}
    for folder in gone.values():
        files.delete(spark, folder)
    emptied, found = {landing for landing, _ in gone}, landings.all_landings(spark, path)
    for landing in found:
        replaced = landing not in landings.latest(found)
        if replaced or (landing.name in emptied and not landings.days_of(spark, path, landing)):
            files.delete(spark, f"{path}/{landing.folder}")
    return sorted({date.fromisoformat(day) for _, day in gone})


# publication


def new_version() -> str:
    """A name for a version of a dataset; later ones sort after earlier ones."""
    return f"v{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}-{uuid4().hex[:8]}"


def _columns(df: DataFrame, partition_by: tuple[str, ...]) -> str:
    """Columns as a view selects them: what a folder's name says of one is text until it is cast."""
    return ", ".join(f"CAST(`{c}` AS {t}) AS `{c}`" if c in partition_by else f"`{c}`" for c, t in df.dtypes)


def _write(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> DataFrame:
    writer = df.hint("rebalance", *partition_by).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def publish(
    df: DataFrame,
    layer: str,
    name: str,
    base: str | None = None,
    partition_by: tuple[str, ...] = (),
    schema: str | None = None,
) -> DataFrame:
    """A staging dataset becomes a temporary view; the others are stored and named by a view.

    Each publication writes a folder of its own, ``<base>/<layer>/<name>/<version>``, and then points
    the view there. A run that fails leaves the last good version in place, and a reader of that
    version is not disturbed; ``sweep`` removes old ones. ``base`` is the shared folder unless given.
    Marts go to the schema ``core``, others to the current one, unless ``schema`` keeps the builds of
    one catalog apart. Datasets that belong together are published by ``Build``.
    """
    spark = df.sparkSession
    if layer == "staging":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    path = f"{base or shared_folder(spark)}/{layer}/{name}/{new_version()}"
    stored = _write(df, path, partition_by)
    schema = schema or LAYERS[layer]
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    full_name = f"{schema}.{name}" if schema else name
    spark.sql(f"CREATE OR REPLACE VIEW {full_name} AS SELECT {_columns(df, partition_by)} FROM parquet.`{path}`")
    return stored


class Build:
    """Datasets that become visible together.

    ``add`` stores a dataset in ``<base>/marts/<name>.<columns>/build=<version>``. The views over these
    folders read the build that the view ``current_build`` of their schema names, so ``switch``, which
    replaces that one view, turns all of them to this build at once. A build that fails before leaves
    everything as it was. Only where columns changed, or a dataset is new, are views made anew.
    """

    CURRENT = "current_build"

    def __init__(self, spark: SparkSession, base: str | None = None, schema: str | None = None):
        self.spark, self.schema = spark, schema or LAYERS["marts"]
        self.base, self.version = f"{base or shared_folder(spark)}/marts", new_version()
        self.views: dict[str, str] = {}
        self.folders: list[str] = []

    def add(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Store a dataset; what is returned reads this build, whichever is current."""
        shape = hashlib.md5(f"{df.schema.simpleString()} {partition_by}".encode()).hexdigest()[:8]
        folder = f"{self.base}/{name}.{shape}"
        stored = _write(df, f"{folder}/build={self.version}", partition_by)
        current = f"(SELECT build FROM {self.schema}.{self.CURRENT})"
        self.views[name] = f"SELECT {_columns(df, partition_by)} FROM parquet.`{folder}` WHERE build = {current}"
        self.folders.append(folder)
        return stored

    def _text(self, name: str) -> str | None:
        if not self.spark.catalog.tableExists(f"{self.schema}.{name}"):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.schema}.{name}").collect()
        return next((r["data_type"] for r in rows if r["col_name"] == "View Text"), None)

    def switch(self, keep: int = 3) -> None:
        """Make this build current, and remove older ones but for the last ``keep``."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.schema}.{self.CURRENT} AS SELECT '{self.version}' AS build")
        for name, text in self.views.items():
            if self._text(name) != text:
                self.spark.sql(f"CREATE OR REPLACE VIEW {self.schema}.{name} AS {text}")
        for folder in self.folders:
            sweep(self.spark, folder, keep)


def sweep(spark: SparkSession, folder: str, keep: int = 3) -> list[str]:
    """Remove versions of a dataset but for the last ``keep`` whole ones and what is newer; the names removed.

    A version that was not written to its end doesn't count. Run it after a publication, so the
    version in use is among the last; a reader of an older one must be done.
    """
    found = files.children(spark, folder)
    whole = [name for name in found if "_SUCCESS" in files.children(spark, f"{folder}/{name}")]
    gone = [name for name in found if len(whole) > keep and name < whole[-keep]]
    for name in gone:
        files.delete(spark, f"{folder}/{name}")
    return gone
