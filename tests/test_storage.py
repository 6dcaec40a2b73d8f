from datetime import date, datetime, timedelta, timezone

import pytest

from jobtide.plans import retention
from jobtide.schemas import RAW
from jobtide.sinks import scratch, storage
from jobtide.sources import tables

DAY = storage.cutoff_day(date(2024, 1, 30))
CUTOFF = 1705968000  # the start of that day


def lever(n, at):
    return {"id": n, "record_id": f"r{n}", "created_at": at, "updated_at": at, "opening_title": "a,b \"q\""}


def test_retention_keeps_the_cutoff_itself(spark, raw, rows, tmp_path):
    df = raw("lever_openings", lever(1, CUTOFF - 1), lever(2, CUTOFF), lever(3, CUTOFF + 1), lever(4, None))
    where = spark, str(tmp_path), "lever_openings", DAY, f"{tmp_path}/archive"
    storage.append_raw(df, f"{tmp_path}/lever_openings")
    # what nobody archived is not dropped
    assert storage.drop_days(*where) == []
    assert storage.archive(*where, date(2024, 1, 30)) == [date(2024, 1, 22)]
    assert storage.drop_days(*where) == [date(2024, 1, 22)]
    assert rows(tables.read_raw(spark, str(tmp_path), "lever_openings"), "id") == [(2,), (3,), (4,)]
    assert storage.drop_days(*where) == []


def test_archive_of_a_timestamp_table(spark, raw, rows, tmp_path):
    df = raw(
        "rippling_openings",
        {"id": 1, "created_at": datetime(2024, 1, 22, 23, 59, 59)},
        {"id": 2, "created_at": datetime(2024, 1, 23)},
    )
    storage.append_raw(df, f"{tmp_path}/rippling_openings")
    assert rows(storage.read_archive(spark, f"{tmp_path}/archive", "rippling_openings")) == []
    days = storage.archive(spark, str(tmp_path), "rippling_openings", DAY, f"{tmp_path}/archive", date(2024, 1, 30))
    assert days == [date(2024, 1, 22)]
    assert rows(storage.read_archive(spark, f"{tmp_path}/archive", "rippling_openings"), "id") == [(1,)]


def test_the_archive_reads_its_days_only(spark, raw, tmp_path):
    storage.append_raw(raw("lever_openings", lever(1, CUTOFF - 5), lever(2, CUTOFF)), f"{tmp_path}/lever_openings")
    old = tables.read_raw(spark, str(tmp_path), "lever_openings", before_day=DAY)
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_append_adds_runs(spark, raw, rows, tmp_path, fmt):
    path = f"{tmp_path}/lever_openings"
    storage.append_raw(raw("lever_openings", lever(1, CUTOFF)), path, fmt)
    storage.append_raw(raw("lever_openings", lever(2, CUTOFF + 86400)), path, fmt)
    storage.append_raw(raw("lever_openings"), path, fmt)
    back = tables.read_raw(spark, str(tmp_path), "lever_openings", fmt)
    assert back.schema.names == RAW["lever_openings"].names
    assert rows(back, "id", "opening_title") == [(1, 'a,b "q"'), (2, 'a,b "q"')]
    later = tables.read_raw(spark, str(tmp_path), "lever_openings", fmt, from_day=date(2024, 1, 24))
    assert rows(later, "id") == [(2,)]


def test_a_landing_written_again_replaces_itself(spark, raw, rows, tmp_path):
    path = f"{tmp_path}/lever_openings"
    one, two = ({**lever(n, CUTOFF + n), "run_id": f"run{n}"} for n in (1, 2))
    for run in ([one], [two], [one], [two, {**two, "id": 3}]):
        storage.append_raw(raw("lever_openings", *run), path, landing=run[0]["run_id"])
    assert rows(tables.read_raw(spark, str(tmp_path), "lever_openings"), "id") == [(1,), (2,), (3,)]
    # also with fewer rows, on other days, or none
    storage.append_raw(raw("lever_openings", lever(9, CUTOFF - 90_000)), path, landing="run2")
    storage.append_raw(raw("lever_openings"), path, landing="run1")
    assert rows(tables.read_raw(spark, str(tmp_path), "lever_openings"), "id") == [(9,)]
    storage.append_raw(raw("lever_openings"), path, landing="run2")
    assert rows(tables.read_raw(spark, str(tmp_path), "lever_openings", from_day=DAY), "id") == []


def test_parts_of_a_run_add_up_over_midnight(spark, raw, rows, tmp_path):
    path, name, expected = f"{tmp_path}/rippling_openings", "rippling_openings", []
    for part in range(4):
        first, again = datetime(2024, 1, 29, 23, 58 + part % 2), datetime(2024, 1, 30, 0, part)
        for at in (first, again):
            seen = [{"id": part * 10 + n, "created_at": at, "run_id": "one run"} for n in range(3)]
            storage.append_raw(raw(name, *seen), path, landing=f"one run, part {part}")
        expected += [(r["id"], again) for r in seen]
    assert rows(tables.read_raw(spark, str(tmp_path), name), "id", "created_at") == expected


def test_a_landing_is_visible_whole_or_not_at_all(spark, raw, rows, tmp_path, monkeypatch):
    path, name = f"{tmp_path}/lever_openings", "lever_openings"
    storage.append_raw(raw(name, lever(1, CUTOFF)), path, landing="a")
    before = tables.read_raw(spark, str(tmp_path), name)

    def fails(*_):
        raise OSError("lost")

    # written, but not renamed
    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(storage.files, "rename", fails)
        storage.append_raw(raw(name, lever(2, CUTOFF)), path, landing="a")
    assert rows(tables.read_raw(spark, str(tmp_path), name), "id") == [(1,)] == rows(before, "id")
    # renamed, but the one before is still there
    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(storage.files, "delete", fails)
        storage.append_raw(raw(name, lever(3, CUTOFF)), path, landing="a")
    assert rows(tables.read_raw(spark, str(tmp_path), name), "id") == [(3,)]
    storage.append_raw(raw(name, lever(4, CUTOFF)), path, landing="a")
    assert rows(tables.read_raw(spark, str(tmp_path), name), "id") == [(4,)]
    assert len(list((tmp_path / name).glob("landing=*"))) == 1


def test_appended_ids_rise_and_stay_unique(spark, raw, tmp_path):
    path, name, ids = f"{tmp_path}/lever_openings", "lever_openings", []
    for number in range(3):
        seen = [{**lever(None, CUTOFF + n * 40_000), "run_id": f"run{number}"} for n in range(20)]
        for _ in range(2):
            storage.append_numbered(raw(name, *seen).drop("id"), path, landing=f"run{number}")
        found = tables.read_raw(spark, str(tmp_path), name).where(f"run_id = 'run{number}'")
        ids.append([r.id for r in found.collect()])
    assert all(len(each) == 20 for each in ids) and len({i for each in ids for i in each}) == 60
    assert max(ids[0]) < min(ids[1]) and max(ids[1]) < min(ids[2])


def test_a_landing_reads_nothing_of_the_table(spark, raw, tmp_path, monkeypatch):
    path, name = f"{tmp_path}/lever_openings", "lever_openings"
    storage.append_numbered(raw(name, lever(None, CUTOFF)).drop("id"), path)
    # a file that cannot be read doesn't matter to the next landing
    for file in (tmp_path / name).rglob("*.parquet"):
        file.write_bytes(b"broken")
        file.with_name(f".{file.name}.crc").unlink()
    storage.append_numbered(raw(name, lever(None, CUTOFF)).drop("id"), path)


def test_numbers_are_claimed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert [storage._claimed(spark, path) for _ in range(3)] == [0, 1, 2]
    # another process took the next one meanwhile
    (tmp_path / "t" / "_landings" / "000000003").write_text("")
    assert storage._claimed(spark, path) == 4
    (tmp_path / "t" / "_landings" / "000000500").write_text("")
    assert storage._claimed(spark, path) == 501
    assert storage._claimed(spark, path) == 502 and not (tmp_path / "t" / "_landings" / "000000004").exists()


def test_archive_and_retention_split_the_table(spark, raw, rows, tmp_path):
    path, name = str(tmp_path), "lever_openings"
    storage.append_raw(raw(name, lever(1, CUTOFF - 5), lever(2, CUTOFF)), f"{path}/{name}")
    where = spark, path, name, DAY, f"{path}/archive"
    for _ in range(3):
        storage.archive(*where, date(2024, 1, 30))
        storage.drop_days(*where)
    storage.append_raw(raw(name, lever(3, CUTOFF + 86400)), f"{path}/{name}")
    assert storage.archive(*where, date(2024, 1, 31)) == []
    assert rows(storage.read_archive(spark, f"{path}/archive", name), "id") == [(1,)]
    assert rows(tables.read_raw(spark, path, name), "id") == [(2,), (3,)]


def test_rows_that_land_between_archive_and_drop_stay(spark, raw, rows, tmp_path):
    path, name = str(tmp_path), "lever_openings"
    where = spark, path, name, DAY, f"{path}/archive"
    storage.append_raw(raw(name, lever(1, CUTOFF - 5), lever(2, CUTOFF)), f"{path}/{name}")
    storage.archive(*where, date(2024, 1, 30))
    storage.append_raw(raw(name, lever(3, CUTOFF - 5)), f"{path}/{name}")
    storage.drop_days(*where)
    assert rows(tables.read_raw(spark, path, name), "id") == [(2,), (3,)]
    storage.archive(*where, date(2024, 1, 30))
    storage.drop_days(*where)
    assert rows(tables.read_raw(spark, path, name), "id") == [(2,)]
    assert rows(storage.read_archive(spark, f"{path}/archive", name), "id") == [(1,), (3,)]


def test_an_export_that_failed_is_made_again(spark, raw, rows, tmp_path, monkeypatch):
    path, name = str(tmp_path), "lever_openings"
    where = spark, path, name, DAY, f"{path}/archive"
    storage.append_raw(raw(name, lever(1, CUTOFF - 5)), f"{path}/{name}")

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(storage.files, "create", fails)
        storage.archive(*where, date(2024, 1, 30))
    assert storage.drop_days(*where) == [] and rows(storage.read_archive(spark, f"{path}/archive", name)) == []
    storage.archive(*where, date(2024, 1, 30))
    assert rows(storage.read_archive(spark, f"{path}/archive", name), "id") == [(1,)]


def test_a_landing_repeated_after_its_export_is_in_the_archive_once(spark, raw, rows, tmp_path):
    path, name = str(tmp_path), "lever_openings"
    where = spark, path, name, DAY, f"{path}/archive"
    for ids in ((1, 2), (1, 2, 3)):
        storage.append_raw(raw(name, *[lever(n, CUTOFF - n) for n in ids], lever(9, CUTOFF)), f"{path}/{name}", landing="run")
        storage.archive(*where, date(2024, 1, 30))
        storage.drop_days(*where)
    assert rows(storage.read_archive(spark, f"{path}/archive", name), "id") == [(1,), (2,), (3,)]
    assert rows(tables.read_raw(spark, path, name), "id") == [(9,)]


def test_the_daily_job(spark, raw, rows, tmp_path):
    base, to = str(tmp_path / "raw"), str(tmp_path / "old")
    storage.append_raw(raw("lever_openings", lever(1, CUTOFF - 5), lever(2, CUTOFF)), f"{base}/lever_openings")
    # half past one in the morning at +05:00 is still the day before in UTC
    early = datetime(2024, 1, 30, 1, 30, tzinfo=timezone(timedelta(hours=5)))
    assert retention.retain(spark, base, to, early)["lever_openings"] == ([], [])
    day = [date(2024, 1, 22)]
    found = retention.retain(spark, base, to, datetime(2024, 1, 30, 1, 30))
    assert found["lever_openings"] == (day, day) and found["ashby_openings"] == ([], [])
    assert retention.retain(spark, base, to, datetime(2024, 1, 30, 2))["lever_openings"] == ([], [])
    assert rows(storage.read_archive(spark, to, "lever_openings"), "id") == [(1,)]


def test_publish_layers(spark, raw, rows, tmp_path):
    df = raw("lever_openings", lever(1, CUTOFF))
    assert rows(storage.publish(df, "staging", "published_view"), "id") == [(1,)]
    storage.publish(df, "intermediate", "published_table", str(tmp_path))
    storage.publish(df, "marts", "published_mart", str(tmp_path), ("existing_used",))
    assert spark.catalog.getTable("published_view").tableType == "TEMPORARY"
    assert spark.catalog.getTable("published_table").tableType == "VIEW"
    assert spark.catalog.getTable("core.published_mart").namespace == ["core"]


def test_publish_again_swaps_whole_versions(spark, raw, rows, tmp_path):
    first = storage.publish(raw("lever_openings", lever(1, CUTOFF)), "marts", "swapped", str(tmp_path))
    storage.publish(raw("lever_openings", lever(2, CUTOFF)), "marts", "swapped", str(tmp_path))
    assert rows(spark.table("core.swapped"), "id") == [(2,)]
    # who reads the version before goes on reading it, and a build that fails changes nothing
    assert rows(first, "id") == [(1,)]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|division"):
        broken = raw("lever_openings", lever(3, CUTOFF)).selectExpr("id", "1 / (id - 3) AS source")
        storage.publish(broken, "marts", "swapped", str(tmp_path))
    assert rows(spark.table("core.swapped"), "id") == [(2,)]


def test_a_build_becomes_visible_at_once(spark, raw, rows, tmp_path):
    def build(number, fails=False):
        made = storage.Build(spark, str(tmp_path), "at_once")
        first = made.add(raw("lever_openings", lever(number, CUTOFF)), "first", ("existing_used",))
        made.add(first.select("id", "source"), "second")
        made.add(first.selectExpr("id", f"1 / (id - {number if fails else 0}) AS part"), "third")
        made.switch(keep=2)

    def seen():
        return [rows(spark.table(f"at_once.{name}"), "id") for name in ("first", "second", "third")]

    build(1)
    assert seen() == [[(1,)]] * 3
    # the third dataset fails: all three are as before
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|division"):
        build(2, fails=True)
    assert seen() == [[(1,)]] * 3
    for number in (3, 4, 5):
        build(number)
        assert seen() == [[(number,)]] * 3
    # the last two builds stay, and the folder that failed is gone with the older ones
    for folder in (f for f in (tmp_path / "marts").iterdir()):
        assert len(list(folder.glob("build=*"))) == 2
    plan = spark.table("at_once.second")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(build" in plan


def test_a_build_may_change_columns(spark, rows, tmp_path):
    for columns in (["id"], ["id", "id * 2 AS twice"]):
        made = storage.Build(spark, str(tmp_path), "reshaped")
        made.add(spark.range(2).selectExpr(*columns), "numbers")
        made.switch()
    assert rows(spark.table("reshaped.numbers")) == [(0, 0), (1, 2)]


def test_old_versions_go_and_unfinished_ones_with_them(spark, tmp_path):
    for name, whole in (("v1", True), ("v2", False), ("v3", True), ("v4", True), ("v5", False)):
        (tmp_path / "x" / name).mkdir(parents=True)
        if whole:
            (tmp_path / "x" / name / "_SUCCESS").write_text("")
    assert storage.sweep(spark, str(tmp_path / "x"), keep=2) == ["v1", "v2"]
    assert storage.sweep(spark, str(tmp_path / "none")) == []


def test_two_builds_keep_apart_by_their_schema(spark, raw, rows, tmp_path):
    for number, schema in ((1, "mine"), (2, "yours")):
        storage.publish(raw("lever_openings", lever(number, CUTOFF)), "marts", "apart", f"{tmp_path}/{schema}", schema=schema)
    assert rows(spark.table("mine.apart"), "id") == [(1,)] and rows(spark.table("yours.apart"), "id") == [(2,)]


def test_scratch_uses_the_folder_the_session_names(spark, rows, checkpoint_dir):
    stored = scratch.stored(spark.range(3), "three")
    assert rows(stored) == [(0,), (1,), (2,)]
    assert len(list(checkpoint_dir.glob("three-*"))) == 1


def test_steps_go_but_for_what_is_kept(spark, rows, checkpoint_dir):
    with scratch.Steps(spark) as steps:
        first = steps.stored(spark.range(3), "going")
        second = steps.stored(first.where("id > 0"), "staying")
        steps.keep(second)
    assert rows(second) == [(1,), (2,)]
    assert not list(checkpoint_dir.glob("going-*")) and len(list(checkpoint_dir.glob("staying-*"))) == 1
    with pytest.raises(ZeroDivisionError), scratch.Steps(spark) as steps:
        steps.stored(spark.range(3), "going")
        1 / 0
    assert not list(checkpoint_dir.glob("going-*"))


def test_scratch_needs_a_named_folder():
    class Context:
        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        scratch.shared_folder(Session())
