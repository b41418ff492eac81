from __future__ import annotations

import pytest
from helpers import rows_of

from tidemark import storage
from tidemark.plans.snapshots import ConcurrentChange, SnapshotTable


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"), ("month",))


def frame(spark, *rows):
    return spark.createDataFrame(rows, "id long, month string")


def test_commits_append_and_replace_and_old_snapshots_stay(spark, table):
    first = table.commit(frame(spark, (1, "01"), (2, "02"), (3, None)))
    table.commit(frame(spark, (4, "01")), "append")
    last = table.commit(frame(spark, (5, "02")), emptied=["month=01"])
    assert rows_of(table.read()) == rows_of(frame(spark, (3, None), (5, "02")))
    assert rows_of(table.read(first)) == rows_of(frame(spark, (1, "01"), (2, "02"), (3, None)))
    assert rows_of(table.read(last, ["month=02"])) == [(5, "02")]
    assert table.read(last, ["month=99"]).collect() == []
    table.commit(frame(spark, (6, "06")), "table")
    assert rows_of(table.read()) == [(6, "06")]


def test_a_reader_sees_the_old_or_the_new_rows_at_every_step(spark, table, monkeypatch):
    table.commit(frame(spark, (1, "01")))
    old, new, seen = [(1, "01")], [(2, "01")], []
    create, delete = storage.create_new, storage.delete

    def watched(do):
        def run(*arguments):
            seen.append(rows_of(table.read()))
            done = do(*arguments)
            seen.append(rows_of(table.read()))
            return done

        return run

    monkeypatch.setattr(storage, "create_new", watched(create))
    monkeypatch.setattr(storage, "delete", watched(delete))
    table.commit(frame(spark, (2, "01")))
    table.vacuum(1, 0)
    assert old in seen and new in seen and all(rows in (old, new) for rows in seen)


@pytest.mark.parametrize("steps", [0, 1])
def test_a_writer_lost_between_steps_changes_nothing_and_may_retry(spark, table, monkeypatch, steps):
    table.commit(frame(spark, (1, "01")))
    create, left = storage.create_new, [steps]

    def lost(*arguments):
        if not left[0]:
            raise OSError("lost")
        left[0] -= 1
        return create(*arguments)

    monkeypatch.setattr(storage, "create_new", lost)
    with pytest.raises(OSError):
        table.commit(frame(spark, (2, "01")))
    assert rows_of(table.read()) == [(1, "01")]
    monkeypatch.setattr(storage, "create_new", create)
    table.commit(frame(spark, (2, "01")))
    assert rows_of(table.read()) == [(2, "01")]


def test_an_unfinished_pointer_is_passed_over(spark, table):
    table.commit(frame(spark, (1, "01")))
    storage.create_new(spark, f"{table.root}/_pointers/{2:012d}", "")
    assert rows_of(table.read()) == [(1, "01")]
    assert table.commit(frame(spark, (2, "02"))).number == 3
    assert rows_of(table.read()) == [(1, "01"), (2, "02")]


def test_two_writers(spark, table):
    base = table.commit(frame(spark, (1, "01"), (2, "02")))
    table.commit(frame(spark, (3, "01")), base=base)
    table.commit(frame(spark, (4, "02")), base=base)  # another partition: both changes hold
    table.commit(frame(spark, (5, "01")), "append", base=base)
    assert rows_of(table.read()) == [(3, "01"), (4, "02"), (5, "01")]
    with pytest.raises(ConcurrentChange):
        table.commit(frame(spark, (6, "01")), base=base)
    with pytest.raises(ConcurrentChange):
        table.commit(frame(spark, (6, "03")), "table", base=base)
    assert rows_of(table.read()) == [(3, "01"), (4, "02"), (5, "01")]


def test_a_taken_number_is_no_loss(spark, table, monkeypatch):
    """The other writer gets the number between our look and our pointer."""
    table.commit(frame(spark, (1, "01")))
    other, publish, once = SnapshotTable(spark, table.root, ("month",)), SnapshotTable._publish, []

    def late(self, candidate):
        if self is table and not once:
            once.append(1)
            other.commit(frame(spark, (2, "01")), "append")
        return publish(self, candidate)

    monkeypatch.setattr(SnapshotTable, "_publish", late)
    assert table.commit(frame(spark, (3, "01")), "append").number == 3
    assert rows_of(table.read()) == [(1, "01"), (2, "01"), (3, "01")]


def test_a_tag_commits_once(spark, table):
    for _ in range(2):
        table.commit(frame(spark, (1, "01")), "append", tag=("batch", "1"))
    table.commit(frame(spark, (2, "01")), "append")
    assert rows_of(table.read()) == [(1, "01"), (2, "01")] and table.tagged("batch") == "1"


def test_columns_may_be_added_but_not_changed(spark, table):
    table.commit(frame(spark, (1, "01")))
    table.commit(spark.createDataFrame([(2, 0.5, "01")], "id long, tip double, month string"), "append")
    assert rows_of(table.read().select("id", "tip")) == [(1, None), (2, 0.5)]
    with pytest.raises(TypeError):
        table.commit(spark.createDataFrame([("x", "01")], "id string, month string"), "append")


def test_vacuum_keeps_what_snapshots_and_writers_need(spark, table):
    for i in range(4):
        table.commit(frame(spark, (i, "01")))
    table.stage(frame(spark, (9, "01")))
    assert table.vacuum(2) == []  # all folders are young
    assert len(table.vacuum(2, 0)) == 3
    assert rows_of(table.read()) == [(3, "01")] and rows_of(table.read(table.snapshot(3))) == [(2, "01")]
    assert table.snapshot(1) is None


def test_tables_without_partitions_and_rows(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "flat"))
    with pytest.raises(FileNotFoundError):
        table.read()
    with pytest.raises(ValueError):
        table.commit(frame(spark), "update")
    table.commit(frame(spark))
    assert table.read().collect() == []
    table.commit(frame(spark, (1, "01")))
    assert rows_of(table.read()) == [(1, "01")]
