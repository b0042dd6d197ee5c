from datetime import datetime, timedelta

import pytest

from tests.build import BOOKING, by_key, raw, same_rows
from tidemark.operators import changes as C
from tidemark.operators.latest import newest_changes
from tidemark.operators.typing import typed
from tidemark.state import table as state
from tidemark.state.table import VersionedTable


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "booking"), BOOKING.key, BOOKING.state_schema, buckets=3)


def newest(spark, run_ts, *rows):
    return newest_changes(typed(raw(spark, BOOKING, *rows), BOOKING, run_ts=run_ts), BOOKING)


def put(table, spark, run_ts, *rows, token=None):
    current = None if table.is_empty() else table.read()
    return table.commit(C.change_set(current, newest(spark, run_ts, *rows), BOOKING), token)


def channels(df):
    return {k: r.CHANNEL for k, r in by_key(df, "BOOKING_ID").items()}


def test_versions_stay_readable(spark, table, run_ts):
    assert table.read().isEmpty() and table.version() == 0
    put(table, spark, run_ts, {"id": "a", "CHANNEL": "1"}, {"id": "b", "CHANNEL": "1"})
    second = put(table, spark, run_ts, {"id": "b", "seq": "7", "CHANNEL": "2"}, {"id": "c", "seq": "7", "CHANNEL": "2"})
    third = put(table, spark, run_ts, {"id": "b", "seq": "8", "CHANNEL": "3"})
    assert second["counts"] == {"insert": 1, "update": 1, "delete": 0} and third["rows"] == 3
    assert channels(table.read(1)) == {"a": "1", "b": "1"}
    assert channels(table.read(2)) == {"a": "1", "b": "2", "c": "2"}
    assert channels(table.read()) == {"a": "1", "b": "3", "c": "2"}
    assert table.read(0).isEmpty()
    assert table.version_at(datetime.now()) == 3
    assert table.version_at(datetime.now() - timedelta(days=1)) == 0


def test_consumers_read_from_their_own_offset(spark, table, run_ts):
    for n in (1, 2, 3):
        put(table, spark, run_ts, {"id": f"k{n}", "seq": str(n)})
    assert {r.BOOKING_ID for r in table.changes(after=1).collect()} == {"k2", "k3"}
    assert {r.BOOKING_ID for r in table.changes(after=1, upto=2).collect()} == {"k2"}
    assert table.changes(after=3).isEmpty() and table.changed_rows(after=3) == 0
    put(table, spark, run_ts, {"id": "k2", "seq": "9", "CHANNEL": "x"})
    net = by_key(table.net_changes(after=1), "BOOKING_ID")
    assert {k: (r._change_type, r.CHANNEL) for k, r in net.items()} == {"k2": ("insert", "x"), "k3": ("insert", "WEB")}


def test_restore_is_an_ordinary_version(spark, table, run_ts):
    put(table, spark, run_ts, {"id": "a", "CHANNEL": "1"}, {"id": "b", "CHANNEL": "1"})
    put(table, spark, run_ts, {"id": "b", "seq": "7", "CHANNEL": "2"}, {"id": "c", "seq": "7"})
    put(table, spark, run_ts, {"id": "a", "seq": "8", "CHANNEL": "3"}, {"id": "c", "seq": "8", "CHANNEL": "3"})
    record = table.restore(1)
    assert record["counts"] == {"insert": 0, "update": 2, "delete": 1} and record["rows"] == 2
    assert same_rows(table.read(), table.read(1))
    assert channels(table.read(3)) == {"a": "3", "b": "2", "c": "3"}
    back = table.restore(3)
    assert back["counts"] == {"insert": 1, "update": 2, "delete": 0}
    assert same_rows(table.read(), table.read(3))


def test_restore_across_a_truncation(spark, table, run_ts):
    put(table, spark, run_ts, {"id": "a", "CHANNEL": "1"})
    table.truncate()
    assert table.is_empty() and table.read().isEmpty()
    put(table, spark, run_ts, {"id": "z", "CHANNEL": "2"})
    table.restore(1)
    assert channels(table.read()) == {"a": "1"}


def test_compaction_changes_files_not_rows(spark, table, run_ts):
    put(table, spark, run_ts, {"id": "a", "CHANNEL": "1"}, {"id": "b", "CHANNEL": "1"})
    put(table, spark, run_ts, {"id": "b", "seq": "7", "CHANNEL": "2"})
    put(table, spark, run_ts, {"id": "c", "seq": "8", "CHANNEL": "3"})
    before = channels(table.read())
    record = table.compact()
    assert record["change_sets"] == [] and record["rows"] == 3 and record["buckets"] == 3
    assert channels(table.read()) == before
    put(table, spark, run_ts, {"id": "a", "seq": "9", "CHANNEL": "4"})
    assert channels(table.read()) == {**before, "a": "4"}
    assert channels(table.read(3)) == before and channels(table.read(1)) == {"a": "1", "b": "1"}
    assert {r.BOOKING_ID for r in table.changes(after=2).collect()} == {"c", "a"}
    table.restore(2)
    assert channels(table.read()) == {"a": "1", "b": "2"}


def test_many_change_sets_are_folded_without_base_or_version(spark, table, run_ts, monkeypatch):
    monkeypatch.setattr(state, "FOLD_CHANGE_SETS", 3)
    for n in range(1, 10):
        put(table, spark, run_ts, {"id": f"k{n % 4}", "seq": str(n), "CHANNEL": str(n)})
        assert not table.needs_compaction() and len(table.record()["change_sets"]) <= 4
    assert table.versions() == list(range(1, 10)) and table.record()["base"] == table.record(1)["base"]
    assert channels(table.read()) == {"k0": "8", "k1": "9", "k2": "6", "k3": "7"}
    assert channels(table.read(6)) == {"k0": "4", "k1": "5", "k2": "6", "k3": "3"}
    assert table.changes(after=7).count() == 2
    table.restore(3)
    assert channels(table.read()) == {"k1": "1", "k2": "2", "k3": "3"}
    table.compact()
    assert table.version() == 10 and channels(table.read()) == {"k1": "1", "k2": "2", "k3": "3"}


def test_unpublished_files_are_ignored_and_written_again(spark, table, run_ts, monkeypatch):
    put(table, spark, run_ts, {"id": "a", "CHANNEL": "1"})

    def crash(*args, **kw):
        raise OSError("lost the driver")

    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_publish", crash)
        with pytest.raises(OSError):
            put(table, spark, run_ts, {"id": "a", "seq": "5", "CHANNEL": "half"}, token=("feed", 1))
    assert channels(table.read()) == {"a": "1"} and not table.seen(("feed", 1))
    put(table, spark, run_ts, {"id": "a", "seq": "5", "CHANNEL": "whole"}, token=("feed", 1))
    assert channels(table.read()) == {"a": "whole"} and table.version() == 2
    assert table.seen(("feed", 1)) and table.seen(("feed", 0)) and not table.seen(("feed", 2))


def test_a_version_is_published_once(spark, table, run_ts):
    put(table, spark, run_ts, {"id": "a"})
    with pytest.raises(FileExistsError):
        table._publish(1, rows=0)


def test_empty_change_set_adds_no_version(spark, table, run_ts):
    put(table, spark, run_ts, {"id": "a", "seq": "5"})
    put(table, spark, run_ts, {"id": "a", "seq": "4"})
    assert table.version() == 1


def test_another_session_finds_the_base(spark, table, run_ts):
    """A session that does not know the base's name registers it from the commit record."""
    put(table, spark, run_ts, {"id": "a", "CHANNEL": "1"}, {"id": "b"}, {"id": "c"})
    spark.sql(f"DROP TABLE {table._base_name(table.record()['base'])}")
    again = VersionedTable(spark, table.path, BOOKING.key, BOOKING.state_schema)
    assert set(channels(again.read())) == {"a", "b", "c"}


def test_shuffled_and_broadcast_reads_agree(spark, table, run_ts, monkeypatch):
    from tidemark import constants as K

    put(table, spark, run_ts, *[{"id": f"k{n}", "seq": "1"} for n in range(50)])
    put(table, spark, run_ts, *[{"id": f"k{n}", "seq": "2", "CHANNEL": "x"} for n in range(10, 30)])
    put(table, spark, run_ts, *[{"id": f"k{n}", "seq": "3", "CHANNEL": "y"} for n in range(20, 60)])
    few = table.read()
    monkeypatch.setattr(K, "BROADCAST_ROWS", 0)
    many = table.read()
    assert many.count() == 60 and same_rows(few, many)
    table.compact()
    assert same_rows(table.read(), few)
