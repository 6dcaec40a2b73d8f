"""Where the rows of a raw table lie.

A landing is what one job adds to a table: a run, or a part of one. Its rows are in a folder
``landing=<key>-<number>`` with a folder ``run_date=<day>`` for each load day. Numbers rise with each
landing, so that of a key with the greatest number is the one that counts: a landing that is repeated
becomes visible, and the one it replaces invisible, in one step, by the renaming of a folder.
"""

import hashlib
import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession

from jobtide import files

#: The day of rows that have no time.
UNKNOWN_DAY = "__HIVE_DEFAULT_PARTITION__"
_NAME = re.compile(r"landing=(?P<key>.*)-(?P<number>\d{9})")


@dataclass(frozen=True)
class Landing:
    key: str
    number: int

    @property
    def name(self) -> str:
        return f"{self.key}-{self.number:09d}"

    @property
    def folder(self) -> str:
        return f"landing={self.name}"

    @classmethod
    def of(cls, folder: str) -> "Landing | None":
        found = _NAME.fullmatch(folder)
        return found and cls(found["key"], int(found["number"]))


def key_of(label: str) -> str:
    """A landing's label as a part of a folder's name; different labels never share one."""
    return f"{re.sub('[^A-Za-z0-9]+', '_', label)[:60]}.{hashlib.md5(label.encode()).hexdigest()}"


def all_landings(spark: SparkSession, path: str) -> list[Landing]:
    found = [Landing.of(name) for name in files.children(spark, path)]
    return [landing for landing in found if landing]


def latest(found: list[Landing]) -> list[Landing]:
    """Of each key the landing with the greatest number."""
    newest = {}
    for landing in sorted(found, key=lambda each: each.number):
        newest[landing.key] = landing
    return list(newest.values())


def days_of(spark: SparkSession, path: str, landing: Landing) -> dict[date | None, str]:
    """The load days of a landing with their folders."""
    days = {}
    for name in files.children(spark, f"{path}/{landing.folder}"):
        column, _, value = name.partition("=")
        if column == "run_date":
            day = None if value == UNKNOWN_DAY else date.fromisoformat(value)
            days[day] = f"{path}/{landing.folder}/{name}"
    return days
