"""Every registered query against its SQL, on the smallest data set."""

import threading
import time

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from jobtide.catalog.oracles import ORACLES
from jobtide.catalog.queries import QUERIES
from jobtide.schemas import RAW
from jobtide.sinks import storage
from jobtide.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_sightings_of_all_providers_are_all_events(spark):
    from jobtide.sources import event_boards

    counts = [event_boards.sightings(spark, SF, provider).count() for provider in (0, 1, 2, 3, None)]
    assert sum(counts[:4]) == counts[4] == spark.read.parquet(f"{SF}/events.parquet").count()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_append_runs_lands_tables_side_by_side(spark, monkeypatch):
    """Twenty-eight landings one after another leave cores idle at the end of each."""
    lock, active, most = threading.Lock(), 0, 0

    def landing(*_):
        nonlocal active, most
        with lock:
            active, most = active + 1, max(most, active + 1)
        time.sleep(0.5)
        with lock:
            active -= 1

    monkeypatch.setattr(storage, "append_raw", landing)
    monkeypatch.setattr(tables, "read_raw", lambda spark, path, name, fmt: spark.createDataFrame([], RAW[name]))
    queries()["append_runs"](spark, SF)
    assert most > 1
