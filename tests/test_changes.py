from dataclasses import replace
from decimal import Decimal

import pytest

from tests.build import BOOKING, CLAIM, RESERVATION, by_key, raw, same_rows
from tidemark.operators import changes as C
from tidemark.operators.latest import DuplicateKeyError, newest_changes, require_unique
from tidemark.operators.typing import typed
from tidemark.plans import gold
from tidemark.specs import AS_DELIVERED, SAFE


def newest(spark, spec, *rows, policy=SAFE, run_ts=None):
    return newest_changes(typed(raw(spark, spec, *rows), spec, policy, run_ts), spec)


def test_highest_sequence_wins_as_a_number(spark):
    got = newest(spark, BOOKING, {"seq": "9", "CHANNEL": "old"}, {"seq": "10", "CHANNEL": "new"}).collect()
    assert [(r.CHANNEL, r.CHANGE_SEQ) for r in got] == [("new", 10)]


def test_unknown_sequence_wins_where_nothing_is_set_aside(spark):
    rows = [{"seq": "10", "CHANNEL": "known"}, {"seq": "x", "CHANNEL": "unknown"}]
    assert newest(spark, BOOKING, *rows, policy=AS_DELIVERED).first().CHANNEL == "unknown"
    assert newest(spark, BOOKING, *rows).first().CHANNEL == "known"


def test_equal_sequences_have_one_outcome(spark):
    rows = [
        {"seq": "5", "CHANNEL": "a", "CHANGE_TS": "2026-08-01 10:00:00"},
        {"seq": "5", "CHANNEL": "b", "CHANGE_TS": "2026-08-01 11:00:00"},
        {"seq": "5", "CHANNEL": "c", "CHANGE_TS": "2026-08-01 10:00:00"},
    ]
    assert newest(spark, BOOKING, *rows).first().CHANNEL == "b"
    assert newest(spark, BOOKING, *reversed(rows)).first().CHANNEL == "b"
    assert newest(spark, BOOKING, rows[0], rows[2]).first().CHANNEL == "c"


def test_merge_source_with_duplicates_fails(spark):
    rows = raw(spark, BOOKING, {"id": "a"}, {"id": "a"}, {"id": "b"})
    with pytest.raises(DuplicateKeyError):
        require_unique(rows, "BOOKING_ID")
    require_unique(newest_changes(typed(rows, BOOKING), BOOKING), "BOOKING_ID")


@pytest.fixture
def current(spark, run_ts):
    return newest(
        spark, BOOKING,
        {"id": "a", "seq": "10", "CHANNEL": "a0"}, {"id": "b", "seq": "10", "CHANNEL": "b0"},
        {"id": "c", "seq": "10", "CHANNEL": "c0"}, {"id": "d", "seq": "10", "op": "D"}, run_ts=run_ts,
    )


BATCH = [
    {"id": "a", "seq": "11", "CHANNEL": "a1"},  # newer
    {"id": "b", "seq": "9", "CHANNEL": "b1"},  # older
    {"id": "c", "seq": "12", "op": "D", "CHANNEL": "c1"},  # delete
    {"id": "d", "seq": "13", "op": "U", "CHANNEL": "d1"},  # back again
    {"id": "e", "seq": "1", "op": "D"},  # delete of a key never seen
    {"id": "f", "seq": "1", "op": "I", "CHANNEL": "f1"},  # new
]


@pytest.mark.parametrize("lookup", ["join", "pick", "broadcast"])
def test_guarded_change_set(spark, current, run_ts, lookup):
    batch = newest(spark, BOOKING, *BATCH, run_ts=run_ts)
    changes = C.change_set(current, batch, BOOKING, lookup=lookup)
    kinds = {r.BOOKING_ID: r._change_type for r in changes.collect()}
    assert kinds == {"a": "update", "c": "update", "d": "update", "e": "insert", "f": "insert"}
    after = by_key(C.apply_change_set(current, changes, "BOOKING_ID"), "BOOKING_ID")
    assert {k: (r.CHANNEL, r.IS_DELETED) for k, r in after.items()} == {
        "a": ("a1", False), "b": ("b0", False), "c": ("c1", True), "d": ("d1", False), "e": ("WEB", True),
        "f": ("f1", False),
    }
    assert same_rows(C.apply_change_set(current, changes, "BOOKING_ID"), C.upsert(current, batch, BOOKING))


def test_unguarded_change_set_regresses(spark, current, run_ts):
    batch = newest(spark, BOOKING, *BATCH, run_ts=run_ts)
    changes = C.change_set(current, batch, BOOKING, guard=False)
    after = C.apply_change_set(current, changes, "BOOKING_ID")
    assert by_key(after, "BOOKING_ID")["b"].CHANNEL == "b1"
    assert same_rows(after, C.upsert(current, batch, BOOKING, guard=False))


def test_same_batch_again_changes_nothing(spark, current, run_ts):
    batch = newest(spark, BOOKING, *BATCH, run_ts=run_ts)
    after = C.upsert(current, batch, BOOKING)
    assert C.change_set(after, batch, BOOKING).isEmpty()


def test_key_only_deletes_keep_the_row(spark, current, run_ts):
    spec = replace(BOOKING, delete_image="key_only")
    batch = newest(spark, spec, {"id": "a", "seq": "20", "op": "D", "CHANNEL": None, "FARE_AMOUNT": None}, run_ts=run_ts)
    after = C.apply_change_set(current, C.change_set(current, batch, spec), "BOOKING_ID")
    row = by_key(after, "BOOKING_ID")["a"]
    assert (row.CHANNEL, row.FARE_AMOUNT, row.IS_DELETED, row.CHANGE_SEQ) == ("a0", Decimal("100.00"), True, 20)
    assert same_rows(after, C.upsert(current, batch, spec))
    full = by_key(C.upsert(current, batch, BOOKING), "BOOKING_ID")["a"]
    assert full.CHANNEL is None and full.IS_DELETED


def test_images_add_up(spark, current, run_ts):
    """old - images before + images after = new"""
    changes = C.change_set(current, newest(spark, BOOKING, *BATCH, run_ts=run_ts), BOOKING)
    images = C.change_rows(changes)
    columns = BOOKING.state_columns
    before = images.filter("_change_type in ('update_preimage', 'delete')").select(columns)
    after = images.filter("_change_type in ('update_postimage', 'insert')").select(columns)
    rebuilt = current.select(columns).exceptAll(before).unionAll(after)
    assert same_rows(rebuilt, C.apply_change_set(current, changes, "BOOKING_ID"))


def test_claim_moved_to_another_booking_names_both(spark):
    before = newest(spark, CLAIM, {"seq": "1", "BOOKING_ID": "old"})
    changes = C.change_set(before, newest(spark, CLAIM, {"seq": "2", "BOOKING_ID": "new"}), CLAIM)
    nothing = C.change_set(None, newest(spark, BOOKING, {}).limit(0), BOOKING)
    sets = {"booking": nothing, "claim": changes}
    assert {r.BOOKING_ID for r in C.changed_keys(sets).collect()} == {"old", "new"}
    assert C.changed_keys(sets, all_sources=False).isEmpty()


def test_net_changes_fold_versions(spark, run_ts):
    from pyspark.sql import functions as F

    def version(n, *rows):
        return newest(spark, BOOKING, *rows, run_ts=run_ts), n

    start = newest(spark, BOOKING, {"id": "a", "seq": "1", "CHANNEL": "0"}, run_ts=run_ts)
    state, parts = start, []
    for batch, n in (
        version(1, {"id": "a", "seq": "2", "CHANNEL": "1"}, {"id": "n", "seq": "2", "CHANNEL": "1"}),
        version(2, {"id": "a", "seq": "3", "CHANNEL": "2"}, {"id": "n", "seq": "3", "CHANNEL": "2"}),
    ):
        changes = C.change_set(state, batch, BOOKING)
        parts.append(changes.withColumn(C.VERSION, F.lit(n).cast("long")))
        state = C.apply_change_set(state, changes, "BOOKING_ID")
    net = by_key(C.net_changes(parts[0].unionByName(parts[1]), "BOOKING_ID"), "BOOKING_ID")
    assert (net["a"]._change_type, net["a"]._pre.CHANNEL, net["a"].CHANNEL) == ("update", "0", "2")
    assert (net["n"]._change_type, net["n"]._pre, net["n"].CHANNEL) == ("insert", None, "2")


def fact_of(spark, bookings, reservations=(), claims=()):
    def rows(spec, given):
        return newest(spark, spec, *given) if given else newest(spark, spec, {}).limit(0)

    fact = gold.booking_fact(rows(BOOKING, bookings), rows(RESERVATION, reservations), rows(CLAIM, claims))
    return by_key(fact, "BOOKING_ID")


def test_fact_edges(spark):
    fact = fact_of(
        spark,
        [
            {"id": "plain"}, {"id": "nostatus", "BOOKING_STATUS": None}, {"id": "nofare", "FARE_AMOUNT": "x"},
            {"id": "gone", "op": "D"}, {"id": "off", "BOOKING_STATUS": "CANCELLED"}, {"id": "noroute", "ORIGIN": None},
            {"id": "high", "FARE_AMOUNT": "1200"}, {"id": "medium", "FARE_AMOUNT": "900"},
            {"id": "low", "FARE_AMOUNT": "899.99"},
        ],
        [
            {"id": "r1", "BOOKING_ID": "plain", "seq": "1", "CABIN_CLASS": "FIRST", "CHECKED_IN_FLAG": "Y"},
            {"id": "r2", "BOOKING_ID": "plain", "seq": "2", "CABIN_CLASS": "BUSINESS", "CHECKED_IN_FLAG": "Y"},
            {"id": "r3", "BOOKING_ID": "plain", "seq": "3", "op": "D"}, {"id": "r4", "BOOKING_ID": None, "seq": "4"},
        ],
        [
            {"id": "c1", "BOOKING_ID": "plain", "CLAIM_STATUS": "SETTLED", "CLAIM_AMOUNT": "130"},
            {"id": "c2", "BOOKING_ID": "plain", "CLAIM_STATUS": "REJECTED", "CLAIM_AMOUNT": "x"},
            {"id": "c3", "BOOKING_ID": "plain", "op": "D"}, {"id": "c4", "BOOKING_ID": None},
            {"id": "c5", "BOOKING_ID": "nofare", "CLAIM_STATUS": "SETTLED"},
        ],
    )
    assert set(fact) == {"plain", "nofare", "noroute", "high", "medium", "low"}
    plain = fact["plain"]
    assert (plain.CABIN_CLASS, plain.CHECKED_IN, plain.IS_AT_RISK) == ("BUSINESS", True, False)
    assert (plain.CLAIM_COUNT, plain.CLAIM_AMOUNT, plain.NET_REVENUE) == (2, Decimal("130.00"), Decimal("-30.00"))
    assert fact["nofare"].NET_REVENUE is None and fact["nofare"].REVENUE_BAND == "LOW"
    assert fact["noroute"].ROUTE is None and fact["noroute"].IS_AT_RISK and not fact["noroute"].CHECKED_IN
    assert [fact[k].REVENUE_BAND for k in ("high", "medium", "low")] == ["HIGH", "MEDIUM", "LOW"]


@pytest.mark.parametrize("small", [True, False])
def test_fact_for_some_keys(spark, small):
    booking = newest(spark, BOOKING, {"id": "x"}, {"id": "y"})
    reservation = newest(spark, RESERVATION, {"id": "r1", "BOOKING_ID": "x"}, {"id": "r2", "BOOKING_ID": "y"})
    claim = newest(spark, CLAIM, {"id": "c1", "BOOKING_ID": "x"}, {"id": "c2", "BOOKING_ID": "y"})
    keys = spark.createDataFrame([("x",)], "BOOKING_ID string")
    fact = by_key(gold.booking_fact(booking, reservation, claim, keys, small), "BOOKING_ID")
    assert set(fact) == {"x"} and fact["x"].CLAIM_COUNT == 1 and fact["x"].CABIN_CLASS == "ECONOMY"


def test_fact_change_sets_agree_with_the_merge(spark, run_ts):
    booking0 = newest(spark, BOOKING, {"id": "x"}, {"id": "y"}, {"id": "z"}, {"id": "w"}, run_ts=run_ts)
    none_r, none_c = newest(spark, RESERVATION, {}).limit(0), newest(spark, CLAIM, {}).limit(0)
    fact = gold.booking_fact(booking0, none_r, none_c, run_ts=run_ts)
    delta = newest(
        spark, BOOKING,
        {"id": "x", "seq": "99", "CHANNEL": "APP"}, {"id": "y", "seq": "99", "op": "D"},
        {"id": "z", "seq": "99", "BOOKING_STATUS": None}, {"id": "n", "seq": "99"}, run_ts=run_ts,
    )
    booking1 = C.upsert(booking0, delta, BOOKING)
    keys = delta.select("BOOKING_ID")
    live = gold.booking_fact(booking1, none_r, none_c, keys, run_ts=run_ts)

    changes = gold.fact_changes(fact, live, keys)
    kinds = {r.BOOKING_ID: r._change_type for r in changes.collect()}
    assert kinds == {"x": "update", "y": "delete", "z": "delete", "n": "insert"}
    assert same_rows(C.apply_change_set(fact, changes, "BOOKING_ID"), gold.merge_fact(fact, live, keys))

    plain = gold.fact_changes_as_delivered(fact, live, booking1)
    kinds = {r.BOOKING_ID: r._change_type for r in plain.collect()}
    assert kinds == {"x": "update", "y": "delete", "n": "insert"}  # the row without status stays behind
    merged = gold.merge_fact_as_delivered(fact, live, booking1)
    assert same_rows(C.apply_change_set(fact, plain, "BOOKING_ID"), merged)
