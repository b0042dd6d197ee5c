"""Small stored files hold many rows: what is decided by checked sizes, not by the bytes of files."""

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.build import BOOKING, CLAIM, RESERVATION, raw, same_rows
from tests.test_plans import plan_of
from tidemark import constants as K
from tidemark.operators import changes as C
from tidemark.operators.latest import newest_changes
from tidemark.operators.typing import typed
from tidemark.plans import gold, quality
from tidemark.session import STORED_TABLES
from tidemark.specs import SAFE
from tidemark.state import table as table_module
from tidemark.state.table import VersionedTable
from tidemark.streaming.flow import Flow

RUN_TS = datetime(2026, 8, 21, 8)


@pytest.fixture
def stored(spark, tmp_path):
    """Silver as files far below the size up to which Spark would broadcast them."""
    tables = {}
    for spec in (BOOKING, RESERVATION, CLAIM):
        rows = raw(spark, spec, *({"id": f"{i}", "BOOKING_ID": f"{i}"} for i in range(20)))
        newest_changes(typed(rows, spec, SAFE, RUN_TS), spec).write.parquet(str(tmp_path / spec.name))
        tables[spec.name] = spark.read.parquet(str(tmp_path / spec.name))
    return tables


def test_checks_broadcast_no_stored_table(spark, tmp_path, stored):
    gold.booking_fact(stored["booking"], stored["reservation"], stored["claim"]).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    tables = {f"SILVER.{n.upper()}": df for n, df in stored.items()} | {quality.GOLD_FACT: fact}
    results = quality.run_rules(tables, quality.PIPELINE_RULES, RUN_TS)
    assert "Broadcast" not in plan_of(results)
    assert {r.FAIL_COUNT for r in results.collect()} == {0}


def test_facts_and_refreshes_by_many_keys_broadcast_nothing(stored):
    keys = stored["booking"].select("BOOKING_ID")
    for wanted in (None, keys):
        fact = gold.booking_fact(stored["booking"], stored["reservation"], stored["claim"], wanted)
        assert "Broadcast" not in plan_of(fact) and fact.count() == 20
    few = gold.booking_fact(stored["booking"], stored["reservation"], stored["claim"], keys, small_keys=True)
    assert "BroadcastHashJoin" in plan_of(few)


def test_look_up_and_reading_of_a_large_batch_broadcast_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "BROADCAST_ROWS", 0)
    table = VersionedTable(spark, str(tmp_path / "t"), BOOKING.key, BOOKING.state_schema)
    for seq in ("1", "2"):
        rows = raw(spark, BOOKING, *({"id": f"{i}", "seq": seq} for i in range(20)))
        batch = newest_changes(typed(rows, BOOKING, SAFE, RUN_TS), BOOKING)
        if table.is_empty():
            table.commit(C.change_set(None, batch, BOOKING), clustered=True)
        else:
            changes = C.change_set(table.read(), table.stage(batch)[0], BOOKING, lookup="pick")
            assert "Broadcast" not in plan_of(changes)
            table.commit(changes)
    assert "Broadcast" not in plan_of(table.read()) and table.read().count() == 20


@pytest.fixture
def unnamed(spark):
    """A session that names no settings of its own."""
    before = {key: spark.conf.get(key, None) for key in STORED_TABLES}
    for key in STORED_TABLES:
        spark.conf.unset(key)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_scans_are_bounded_where_the_session_does_not(spark, tmp_path, unnamed):
    bytes_of_a_task = "spark.sql.files.maxPartitionBytes"
    Flow(spark, str(tmp_path / "a"), "")
    assert spark.conf.get(bytes_of_a_task) == "16m"
    spark.conf.set(bytes_of_a_task, "64m")
    Flow(spark, str(tmp_path / "b"), "")
    assert spark.conf.get(bytes_of_a_task) == "64m"


def test_shuffled_and_staged_rows_leave_with_their_step(spark, tmp_path, unnamed, monkeypatch):
    monkeypatch.setattr(K, "LISTED_KEYS", 0)
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in (manager.getAllFiles().apply(i).getName() for i in range(manager.getAllFiles().size())) if f.startswith("shuffle_")}

    before = shuffled()
    flow = Flow(spark, str(tmp_path / "root"), "", run_ts=RUN_TS)
    for seq in ("1", "2"):
        flow.merge_batch(BOOKING, raw(spark, BOOKING, *({"id": f"{i}", "seq": seq} for i in range(20))))
    for _ in range(50):  # files are removed beside the next step
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert not [n for n in os.listdir(tmp_path / "root/silver/booking") if n.startswith("staging")]
    assert {r.CHANGE_SEQ for r in flow.silver["booking"].read().collect()} == {2}


def test_a_batch_in_the_buckets_of_the_base_is_joined_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(table_module, "BUCKET_BYTES", 1)
    table = VersionedTable(spark, str(tmp_path / "t"), BOOKING.key, BOOKING.state_schema)

    def batch(seq, ids):
        rows = raw(spark, BOOKING, *({"id": f"{i}", "seq": seq} for i in ids))
        return newest_changes(typed(rows, BOOKING, SAFE, RUN_TS), BOOKING)

    table.commit(C.change_set(None, batch("2", range(20)), BOOKING), clustered=True)
    staged, _ = table.stage(batch("3", range(10, 30)), clustered=True)
    changes = C.change_set(table.read(), staged, BOOKING, lookup="buckets")
    plan = plan_of(changes)
    assert plan.count("SortMergeJoin") == 1 and "Exchange" not in plan
    assert same_rows(changes, C.change_set(table.read(), staged, BOOKING, lookup="pick"))
    assert changes.count() == 20 and changes.filter(F.col(C.PRE).isNull()).count() == 10
