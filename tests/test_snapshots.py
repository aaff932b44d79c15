"""The snapshot log: competing writers, runs that die at any step, damaged and cleaned tables."""

import json
import shutil
from pathlib import Path

import pytest

from daylog.schemas import SERIES
from daylog.sources import snapshots, store
from daylog.sources.snapshots import ConcurrentWrite, LostLog, Snapshot, begin, commit, drop_old_versions, newest, put_if_absent
from daylog.sources.store import merge_into, new_wins, read_flat, read_table, stored_wins, write_flat, write_partitions, write_table


def series(spark, *days):
    rows = [(1, d, "steps", v, 0, "") for d, v in days]
    text = "user_id bigint, date string, metric string, value string, seq bigint, source string"
    frame = spark.createDataFrame(rows, text)
    return frame.withColumn("date", frame.date.cast("date"))


def held(spark, path):
    return {r.date.isoformat(): r.value for r in read_table(spark, path, SERIES).collect()}


def test_put_if_absent_keeps_what_is_there(spark, tmp_path):
    target = str(tmp_path / "deep" / "entry.json")
    assert put_if_absent(spark, target, "first")
    assert not put_if_absent(spark, target, "second")
    assert Path(target).read_text() == "first"
    assert [p.name for p in (tmp_path / "deep").iterdir() if not p.name.endswith(".crc")] == ["entry.json"]


def test_newest_number_wins_and_entries_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    assert newest(spark, path) == Snapshot() and read_table(spark, path, SERIES).count() == 0
    for day in ("2025-01-01", "2025-02-01", "2025-03-01"):
        write_table(series(spark, (day, "1")), path)
    now = newest(spark, path)
    assert now.number == 3 and sorted(now.partitions) == ["2025-01", "2025-02", "2025-03"]
    log = sorted((tmp_path / "t" / "_snapshots").glob("*.json"))
    assert [len(json.loads(p.read_text())) for p in log] == [0, 1, 2, 3]


def test_of_two_writers_of_a_partition_one_loses_and_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(series(spark, ("2025-01-01", "old")), path)
    base = begin(spark, path)
    write_partitions(series(spark, ("2025-01-01", "fast")), path, base=base)
    with pytest.raises(ConcurrentWrite, match="2025-01"):
        write_partitions(series(spark, ("2025-01-01", "slow"), ("2025-02-01", "slow")), path, base=base)
    assert held(spark, path) == {"2025-01-01": "fast"}


def test_writers_of_other_partitions_both_succeed(spark, tmp_path):
    path = str(tmp_path / "t")
    base = begin(spark, path)
    write_partitions(series(spark, ("2025-01-01", "a")), path, base=base)
    write_partitions(series(spark, ("2025-02-01", "b")), path, base=base)
    assert held(spark, path) == {"2025-01-01": "a", "2025-02-01": "b"}


def test_a_number_taken_between_reading_and_putting_is_tried_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    base = begin(spark, path)
    put, rivals = snapshots.put_if_absent, []

    def late(spark, target, content):
        if not rivals:  # another writer takes this number first
            rivals.append(put(spark, target, '{"2025-09": "other"}'))
        return put(spark, target, content)

    monkeypatch.setattr(snapshots, "put_if_absent", late)
    made = commit(spark, path, base, {"2025-01": "mine"})
    assert made == Snapshot(2, {"2025-01": "mine", "2025-09": "other"}) and newest(spark, path) == made


@pytest.mark.parametrize("merge, value", [(new_wins, "batch"), (stored_wins, "rival")])
def test_a_merge_that_is_overtaken_starts_again_on_the_new_rows(spark, tmp_path, monkeypatch, merge, value):
    path = str(tmp_path / "t")
    write_table(series(spark, ("2025-01-01", "old")), path)
    first, done = store.read_table, []

    def overtaken(*args, **options):
        rows = first(*args, **options)
        if not done:
            done.append(True)
            write_table(series(spark, ("2025-01-01", "old"), ("2025-01-02", "rival")), path)
        return rows

    monkeypatch.setattr(store, "read_table", overtaken)
    merge_into(series(spark, ("2025-01-02", "batch")), path, SERIES, merge)
    monkeypatch.undo()
    assert held(spark, path) == {"2025-01-01": "old", "2025-01-02": value}


def test_a_merge_that_always_loses_gives_up(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = store.read_table

    def overtaken(*args, **options):
        rows = first(*args, **options)
        write_table(series(spark, ("2025-01-01", "rival")), path)
        return rows

    monkeypatch.setattr(store, "read_table", overtaken)
    with pytest.raises(ConcurrentWrite):
        merge_into(series(spark, ("2025-01-01", "batch")), path, SERIES, new_wins)
    monkeypatch.undo()
    assert held(spark, path) == {"2025-01-01": "rival"}
    assert not list((tmp_path / "t" / "_batches").glob("*"))


def test_data_without_a_log_is_an_error_not_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(series(spark, ("2025-01-01", "1")), path)
    shutil.move(tmp_path / "t" / "_snapshots", tmp_path / "elsewhere")
    for use in (lambda: read_table(spark, path, SERIES), lambda: write_table(series(spark, ("2025-02-01", "1")), path)):
        with pytest.raises(LostLog):
            use()
    shutil.move(tmp_path / "elsewhere", tmp_path / "t" / "_snapshots")
    assert held(spark, path) == {"2025-01-01": "1"}


def test_a_first_write_that_dies_leaves_an_empty_table_that_can_be_written(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def dies(*_):
        raise RuntimeError("the driver dies here")

    with monkeypatch.context() as patched:
        patched.setattr(store, "commit", dies)
        with pytest.raises(RuntimeError):
            write_table(series(spark, ("2025-01-01", "1")), path)
    assert list((tmp_path / "t").glob("version=*")) and held(spark, path) == {}
    write_table(series(spark, ("2025-01-01", "2")), path)
    assert held(spark, path) == {"2025-01-01": "2"}


def test_small_tables_are_replaced_in_one_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "flat")
    frame = spark.range(3)
    write_flat(frame, path)

    def dies(*_):
        raise RuntimeError("the driver dies here")

    with monkeypatch.context() as patched:
        patched.setattr(store, "commit", dies)
        with pytest.raises(RuntimeError):
            write_flat(spark.range(5), path)
    assert read_flat(spark, path).count() == 3
    reader = read_flat(spark, path)
    write_flat(spark.range(7), path)
    assert (reader.count(), read_flat(spark, path).count()) == (3, 7)
    assert read_flat(spark, str(tmp_path / "none"), "id bigint").count() == 0


def test_cleaning_keeps_what_kept_entries_name_and_what_is_young(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(series(spark, ("2025-01-01", "1"), ("2025-02-01", "1")), path)
    old = newest(spark, path)
    write_table(series(spark, ("2025-01-01", "2")), path)
    (tmp_path / "t" / "version=unnamed" / "month=2025-05").mkdir(parents=True)
    assert drop_old_versions(spark, path) == 0  # all folders are young
    assert newest(spark, path).number == 2
    assert drop_old_versions(spark, path, keep=2, hours=0) == 1  # the unnamed one
    assert read_table(spark, path, SERIES, snapshot=newest(spark, path)).count() == 2
    assert drop_old_versions(spark, path, hours=0) == 1 and held(spark, path) == {"2025-01-01": "2", "2025-02-01": "1"}
    assert old.number == 1


def test_months_without_input_are_emptied_by_a_whole_run(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(series(spark, ("2025-01-01", "1"), ("2025-02-01", "1")), path)
    write_partitions(series(spark, ("2025-02-01", "2")), path, replaced=None)
    assert held(spark, path) == {"2025-02-01": "2"}
