"""The sample feed end to end, against the expected results in FIXTURES.md."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests import sample_feed
from tidemark.operators.changes import change_rows
from tidemark.plans import gold, quality
from tidemark.specs import AS_DELIVERED, BOOKING, SAFE
from tidemark.streaming.flow import Flow

D = Decimal

REBUILT = {
    "BK1001": ("JFK-LHR", "2026-08-01", "WEB", "ECONOMY", False, D("842.50"), 0, D("0.00"), D("842.50"), "LOW", True),
    "BK1003": ("ATL-CDG", "2026-08-02", "AGENT", "BUSINESS", False, D("1120.75"), 1, D("320.00"), D("800.75"), "MEDIUM", True),
    "BK1004": ("ORD-FRA", "2026-08-03", "WEB", "ECONOMY", False, D("950.00"), 0, D("0.00"), D("950.00"), "MEDIUM", True),
    "BK1006": ("BOS-LHR", "2026-08-04", "MOBILE", "FIRST", False, D("1310.00"), 1, D("400.00"), D("1310.00"), "HIGH", True),
    "BK1008": ("ORD-FRA", "2026-08-06", "WEB", "ECONOMY", False, D("975.25"), 0, D("0.00"), D("975.25"), "MEDIUM", True),
    "BK1009": ("LAX-CDG", "2026-08-07", "PARTNER", "BUSINESS", True, D("1450.00"), 1, D("250.00"), D("1200.00"), "HIGH", False),
    "BK1010": ("BOS-LHR", "2026-08-08", "WEB", "PREMIUM", False, D("1290.00"), 0, D("0.00"), D("1290.00"), "HIGH", True),
    "BK1011": ("JFK-LHR", "2026-08-21", "MOBILE", "ECONOMY", True, D("910.00"), 1, D("150.00"), D("910.00"), "MEDIUM", True),
    "BK1012": ("LAX-CDG", "2026-08-21", "WEB", "BUSINESS", False, D("1499.99"), 0, D("0.00"), D("1499.99"), "HIGH", True),
}
# claims, claim amount, net revenue, at risk where only booking changes reach the fact
BOOKING_DRIVEN = {
    "BK1001": (1, D("180.00"), D("842.50"), True),
    "BK1003": (1, D("320.00"), D("1120.75"), True),
    "BK1009": (1, D("250.00"), D("1450.00"), True),
}


def fact_rows(fact):
    return {
        r.BOOKING_ID: (
            r.ROUTE, str(r.BOOKING_DATE), r.CHANNEL, r.CABIN_CLASS, r.CHECKED_IN, r.FARE_AMOUNT,
            r.CLAIM_COUNT, r.CLAIM_AMOUNT, r.NET_REVENUE, r.REVENUE_BAND, r.IS_AT_RISK,
        )
        for r in fact.collect()
    }


def totals(fact):
    row = fact.agg(
        F.count("*"), F.sum("FARE_AMOUNT"), F.sum("NET_REVENUE"), F.sum("CLAIM_AMOUNT"), F.count_if("IS_AT_RISK")
    ).first()
    return tuple(row)


@pytest.fixture(scope="module", params=["safe", "as_delivered"])
def loaded(request, spark, tmp_path_factory):
    """The flow after full load and after the hourly batch, with what it showed in between."""
    base = tmp_path_factory.mktemp(request.param)
    landing = base / "landing"
    sample_feed.land(landing, "fullload", sample_feed.FULL)
    sample_feed.land(landing, "cdc", sample_feed.CDC)
    policy = SAFE if request.param == "safe" else AS_DELIVERED
    flow = Flow(spark, str(base / "root"), str(landing), policy)
    seen = {}
    flow.load("fullload")
    seen["silver_full"] = {n: t.record() for n, t in flow.silver.items()}
    seen["gold_full"] = flow.refresh_gold()
    seen["totals_full"] = totals(flow.fact.read())
    flow.load("cdc")
    seen["silver_cdc"] = {n: t.record() for n, t in flow.silver.items()}
    seen["gold_cdc"] = flow.refresh_gold()
    return request.param, flow, seen


def test_row_counts(loaded):
    _, flow, seen = loaded
    assert [r["rows"] for r in seen["silver_full"].values()] == [10, 10, 5]
    assert [r["rows"] for r in seen["silver_cdc"].values()] == [12, 12, 6]
    assert [t.read().count() for t in flow.silver.values()] == [12, 12, 6]
    counts = {n: (r["counts"]["update"], r["counts"]["insert"]) for n, r in seen["silver_cdc"].items()}
    assert counts == {"booking": (4, 2), "reservation": (4, 2), "claim": (3, 1)}
    assert seen["gold_full"]["counts"]["insert"] == 9


def test_gold_counts(loaded):
    mode, flow, seen = loaded
    counts = seen["gold_cdc"]["counts"]
    merged = counts["insert"] + counts["update"]
    assert (merged, counts["delete"]) == ((7, 2) if mode == "safe" else (4, 2))
    assert flow.fact.read().count() == 9


def test_silver_states(loaded):
    _, flow, _ = loaded
    booking = {r.BOOKING_ID: r for r in flow.silver["booking"].read().collect()}
    assert booking["BK1011"].FARE_AMOUNT == D("910.00") and booking["BK1011"].CHANGE_SEQ == 1000000107
    assert booking["BK1005"].IS_DELETED and booking["BK1005"].BOOKING_STATUS == "CONFIRMED"
    assert booking["BK1002"].BOOKING_STATUS == "CANCELLED" and not booking["BK1002"].IS_DELETED
    assert booking["BK1004"].BOOKING_STATUS == "CONFIRMED"
    assert booking["BK1012"].FARE_AMOUNT == D("1499.99")
    reservation = {r.RESERVATION_ID: r for r in flow.silver["reservation"].read().collect()}
    assert reservation["RS9011"].CHECKED_IN and reservation["RS9011"].CHANGE_SEQ == 2000000107
    assert reservation["RS9005"].IS_DELETED and reservation["RS9010"].CABIN_CLASS == "PREMIUM"
    claim = {r.CLAIM_ID: r for r in flow.silver["claim"].read().collect()}
    assert claim["CL7001"].CLAIM_STATUS == "SETTLED" and claim["CL7004"].IS_DELETED
    assert claim["CL7006"].CLAIM_STATUS == "OPEN" and claim["CL7006"].SETTLED_TS is None


def test_fact_rows(loaded):
    mode, flow, _ = loaded
    expected = dict(REBUILT)
    if mode == "as_delivered":
        for key, (claims, amount, net, risk) in BOOKING_DRIVEN.items():
            old = expected[key]
            expected[key] = (*old[:6], claims, amount, net, old[9], risk)
    assert fact_rows(flow.fact.read()) == expected


def test_fact_totals(loaded):
    mode, flow, seen = loaded
    assert seen["totals_full"] == (9, D("9597.50"), D("9597.50"), D("1150.00"), 8)
    if mode == "safe":
        assert totals(flow.fact.read()) == (9, D("10348.49"), D("9778.49"), D("1120.00"), 8)
    else:
        assert totals(flow.fact.read()) == (9, D("10348.49"), D("10348.49"), D("1300.00"), 9)


def test_rebuild_agrees(loaded):
    _, flow, _ = loaded
    silver = [flow.silver[n].read() for n in ("booking", "reservation", "claim")]
    assert fact_rows(gold.booking_fact(*silver)) == REBUILT


def test_raw_is_empty_and_log_is_written(loaded):
    _, flow, _ = loaded
    assert flow.raw(BOOKING).count() == 0
    steps = {r.STEP for r in flow.run_log().collect()}
    assert steps >= {"RAW->SILVER", "SILVER->GOLD"}


def test_change_stream(loaded):
    _, flow, seen = loaded
    versions = seen["silver_full"]["booking"]["version"], seen["silver_cdc"]["booking"]["version"]
    rows = change_rows(flow.silver["booking"].changes(*versions))
    kinds = {r._change_type: r["count"] for r in rows.groupBy("_change_type").count().collect()}
    assert kinds == {"insert": 2, "update_preimage": 4, "update_postimage": 4}
    assert flow.silver["booking"].stream_rows(*versions) == 10


def test_daily_route(loaded):
    mode, flow, _ = loaded
    rows = gold.daily_route_summary(flow.fact.read()).collect()
    assert len(rows) == 9 and all(r.BOOKINGS == 1 for r in rows)
    share = {(r.ROUTE, str(r.BOOKING_DATE)): r.AT_RISK_PCT for r in rows}
    assert share.pop(("LAX-CDG", "2026-08-07")) == (0.0 if mode == "safe" else 100.0)
    assert set(share.values()) == {100.0}


def test_quality_passes(loaded):
    _, flow, _ = loaded
    results = flow.run_quality().collect()
    assert len(results) == 6
    assert {(r.FAIL_COUNT, r.STATUS) for r in results} == {(0, "PASS")}
    suite = flow.run_quality(quality.GOLD_RULES).collect()
    assert len(suite) == 6 and {(r.FAIL_COUNT, r.STATUS) for r in suite} == {(0, "PASS")}
    assert {r.STATUS for r in flow.freshness().collect()} == {"PASS"}


def test_inspection(loaded):
    """Sorted listings, key look-ups and the newest lines of the log."""
    _, flow, _ = loaded
    booking = flow.silver["booking"].read()
    assert [r.BOOKING_ID for r in booking.orderBy("BOOKING_ID").limit(2).collect()] == ["BK1001", "BK1002"]
    assert booking.filter(F.col("BOOKING_ID") == "BK1011").first().FARE_AMOUNT == D("910.00")
    fact = flow.fact.read()
    assert fact.filter(F.col("BOOKING_ID").isin("BK1002", "BK1005", "BK1007")).isEmpty()
    layers = booking.filter("BOOKING_ID = 'BK1005'").select(F.lit("silver").alias("lyr"), F.col("IS_DELETED").cast("string").alias("v"))
    layers = layers.unionByName(
        fact.filter("BOOKING_ID = 'BK1005'").agg(F.count("*").cast("string").alias("v")).select(F.lit("gold").alias("lyr"), "v")
    )
    assert {tuple(r) for r in layers.collect()} == {("silver", "true"), ("gold", "0")}
    assert len(flow.run_log().orderBy(F.desc("LOG_TS")).limit(3).collect()) == 3
