"""Physical plans: the stored base is not shuffled, columns and filters reach the files."""

import re

import pytest

from tidemark import constants as K
from tidemark.operators import changes as C
from tidemark.plans import gold
from tidemark.specs import BOOKING, CLAIM, RESERVATION
from tidemark.state.table import VersionedTable
from tidemark.workload import feeds

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def ancestors(plan: str, wanted: str) -> list[list[str]]:
    """For every line that holds `wanted`, the operators above it, nearest first."""
    lines = [l for l in plan.splitlines() if l.strip()]
    depth = [len(re.match(r"[\s:|+\-*()\d]*", l).group()) for l in lines]
    found = []
    for i, line in enumerate(lines):
        if wanted in line:
            chain, level = [], depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < level:
                    chain.append(lines[j].strip(" :+-*|"))
                    level = depth[j]
            found.append(chain)
    return found


def below_first_join(chain: list[str]) -> list[str]:
    above = []
    for operator in chain:
        if "Join" in operator:
            return above
        above.append(operator)
    return above


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    t = VersionedTable(spark, str(tmp_path_factory.mktemp("plan") / "t"), BOOKING.key, BOOKING.state_schema, buckets=4)
    t.commit(C.change_set(None, feeds.newest(spark, SF, BOOKING, feeds.FULL), BOOKING), clustered=True)
    for batch in (feeds.DELTA, feeds.LATE):
        staged, _ = t.stage(feeds.newest(spark, SF, BOOKING, batch))
        t.commit(C.change_set(t.read(), staged, BOOKING, guard=False, lookup="broadcast"))
    return t


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """As if no side were small enough to broadcast."""
    monkeypatch.setattr(K, "BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def base_chains(table, df):
    chains = ancestors(plan_of(df), table._base_name(table.record()["base"]))
    assert chains
    return [below_first_join(c) for c in chains]


def test_few_changes_are_broadcast(table):
    df = table.read()
    assert "BroadcastHashJoin" in plan_of(df)
    assert not any("Exchange" in op for chain in base_chains(table, df) for op in chain)


def test_many_changes_leave_the_base_in_place(table, no_broadcast):
    df = table.read()
    assert "SortMergeJoin" in plan_of(df)
    assert not any("Exchange" in op for chain in base_chains(table, df) for op in chain)


def test_large_batch_lookup_leaves_the_base_in_place(spark, table, no_broadcast):
    staged, _ = table.stage(feeds.newest(spark, SF, BOOKING, feeds.DELTA))
    df = C.change_set(table.read(), staged, BOOKING, lookup="pick")
    assert not any("Exchange" in op for chain in base_chains(table, df) for op in chain)


def test_large_key_set_reads_the_fact_in_place(spark, table, no_broadcast):
    """A refresh by many keys picks old rows of a stored table without moving its base."""
    keys = C.changed_keys({"booking": table.changes(after=1)})
    df = table.read().join(keys, "BOOKING_ID", "left_semi")
    assert not any("Exchange" in op for chain in base_chains(table, df) for op in chain)


def test_changed_keys_read_only_keys(spark, table):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(C.changed_keys({"booking": table.changes(after=1)}))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "ReadSchema: struct<BOOKING_ID:string,_pre:struct<BOOKING_ID:string>>" in plan


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    plan = plan_of(feeds.newest(spark, SF, CLAIM))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_rollup_aggregates_before_the_shuffle(spark):
    plan = plan_of(gold.claim_rollup(feeds.newest(spark, SF, CLAIM)))
    assert "partial_sum" in plan


def test_fact_needs_one_shuffle_per_input(spark, tmp_path, no_broadcast):
    """Over stored tables the fact shuffles bookings, reservations and claims once each, by booking."""
    stored = {}
    for spec in (BOOKING, RESERVATION, CLAIM):
        path = str(tmp_path / spec.name)
        feeds.newest(spark, SF, spec).write.parquet(path)
        stored[spec.name] = spark.read.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(gold.booking_fact(stored["booking"], stored["reservation"], stored["claim"]))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert plan.count("Exchange hashpartitioning") == 3
    claims = next(l for l in plan.splitlines() if "FileScan" in l and "CLAIM_STATUS" in l)
    assert "CLAIM_TYPE" not in claims and "FILED_TS" not in claims
    bookings = next(l for l in plan.splitlines() if "FileScan" in l and "FARE_AMOUNT" in l)
    assert "Not(EqualTo(BOOKING_STATUS,CANCELLED))" in bookings


def test_no_python_and_no_cross_join(spark):
    from tidemark.workload.queries import QUERIES

    for name in ("gold_rebuild", "gold_incremental_all", "dq_results", "changed_keys", "daily_route_summary"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan, name
