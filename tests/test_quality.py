from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.build import BOOKING, CLAIM, RESERVATION, raw
from tidemark.operators.latest import newest_changes
from tidemark.operators.typing import typed
from tidemark.plans import gold, quality


def silver(spark, spec, *rows, run_ts=None):
    return newest_changes(typed(raw(spark, spec, *rows), spec, run_ts=run_ts), spec)


def tables(spark, bookings, claims, stale=()):
    booking = silver(spark, BOOKING, *bookings)
    claim = silver(spark, CLAIM, *claims)
    reservation = silver(spark, RESERVATION, {})
    fact = gold.booking_fact(booking, reservation, claim)
    if stale:
        old = silver(spark, BOOKING, *stale)
        fact = fact.unionByName(gold.booking_fact(old, reservation, claim.limit(0)))
    return {
        "SILVER.BOOKING": booking, "SILVER.CLAIM": claim, "GOLD.BOOKING_FACT": fact,
        "GOLD.DAILY_ROUTE_SUMMARY": gold.daily_route_summary(fact),
    }


def results(given, rules, run_ts):
    return {(r.TARGET, r.TEST_NAME): (r.FAIL_COUNT, r.STATUS) for r in quality.run_rules(given, rules, run_ts).collect()}


def test_all_rules_pass_on_clean_data(spark, run_ts):
    given = tables(spark, [{"id": "a"}], [{"id": "c", "BOOKING_ID": "a"}])
    got = results(given, quality.PIPELINE_RULES, run_ts)
    assert len(got) == 6 and set(got.values()) == {(0, "PASS")}
    assert set(results(given, quality.GOLD_RULES, run_ts).values()) == {(0, "PASS")}


def test_all_rules_pass_on_no_data(spark, run_ts):
    given = {k: df.limit(0) for k, df in tables(spark, [{"id": "a"}], [{"id": "c"}]).items()}
    got = results(given, quality.PIPELINE_RULES, run_ts)
    assert len(got) == 6 and set(got.values()) == {(0, "PASS")}


def test_each_rule_counts_its_rows(spark, run_ts):
    given = tables(
        spark,
        [{"id": "a", "FARE_AMOUNT": "5"}, {"id": "b", "BOOKING_STATUS": "ODD"}, {"id": "d", "op": "D"},
         {"id": "n", "BOOKING_STATUS": None}, {"id": "x", "BOOKING_STATUS": "CANCELLED"}],
        [{"id": "c1", "BOOKING_ID": "a", "CLAIM_STATUS": "SETTLED", "CLAIM_AMOUNT": "7"},
         {"id": "c2", "BOOKING_ID": "nowhere"}, {"id": "c3", "BOOKING_ID": "nowhere"}, {"id": "c4", "BOOKING_ID": None},
         {"id": "c5", "BOOKING_ID": "nowhere", "op": "D"}, {"id": "c6", "BOOKING_ID": "d"}],
        stale=[{"id": "d"}, {"id": "x"}],
    )
    booking = given["SILVER.BOOKING"]
    lost = booking.limit(1).withColumn("BOOKING_ID", F.lit(None).cast("string"))
    given["SILVER.BOOKING"] = booking.unionByName(booking.filter("BOOKING_ID in ('a', 'b')")).unionByName(lost)
    got = results(given, quality.PIPELINE_RULES, run_ts)
    assert got[("SILVER.BOOKING", "unique_booking_id")] == (2, "FAIL")
    assert got[("SILVER.BOOKING", "not_null_booking_id")] == (1, "FAIL")
    assert got[("SILVER.BOOKING", "accepted_booking_status")][1] == "FAIL"
    assert got[("SILVER.CLAIM", "fk_claim_to_booking")] == (3, "FAIL")  # two orphans and one without a booking
    assert got[("GOLD.BOOKING_FACT", "net_revenue_not_negative")] == (1, "WARN")
    assert got[("GOLD.BOOKING_FACT", "gold_excludes_cancelled")] == (2, "FAIL")


def test_gold_suite_failures(spark, run_ts):
    given = tables(spark, [{"id": "a", "FARE_AMOUNT": "x"}, {"id": "b", "BOOKING_STATUS": "ODD"}], [{"id": "c"}])
    fact = given["GOLD.BOOKING_FACT"]
    given["GOLD.BOOKING_FACT"] = fact.unionByName(fact.withColumn("REVENUE_BAND", F.lit("TOP")))
    got = results(given, quality.GOLD_RULES, run_ts)
    assert got == {
        ("GOLD.BOOKING_FACT", "not_null_booking_id"): (0, "PASS"),
        ("GOLD.BOOKING_FACT", "unique_booking_id"): (2, "FAIL"),
        ("GOLD.BOOKING_FACT", "not_null_fare_amount"): (2, "FAIL"),
        ("GOLD.BOOKING_FACT", "accepted_revenue_band"): (2, "FAIL"),
        ("GOLD.BOOKING_FACT", "accepted_booking_status"): (2, "FAIL"),
        ("GOLD.DAILY_ROUTE_SUMMARY", "not_null_bookings"): (0, "PASS"),
    }


def test_row_rules_of_a_table_share_one_pass(spark, run_ts, tmp_path):
    path = str(tmp_path / "b")
    silver(spark, BOOKING, {"id": "a"}).write.parquet(path)
    rules = [r for r in quality.PIPELINE_RULES if isinstance(r, quality.RowRule) and r.target == "SILVER.BOOKING"]
    df = quality.run_rules({"SILVER.BOOKING": spark.read.parquet(path)}, rules, run_ts)
    assert len(rules) == 2 and df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_freshness_states(spark):
    now = datetime(2026, 8, 21, 12, 0, 30)

    def aged(**delta):
        return silver(spark, BOOKING, {"id": "a"}, run_ts=now - timedelta(**delta)), "UPDATED_AT"

    empty = (silver(spark, BOOKING, {"id": "a"}, run_ts=now).limit(0), "UPDATED_AT")
    watched = {"new": aged(minutes=3), "edge": aged(hours=2), "old": aged(hours=2, seconds=1), "dead": aged(hours=7), "none": empty}
    got = {r.OBJ: (r.LAG_MIN, r.STATUS) for r in quality.freshness(watched, now).collect()}
    assert got == {"new": (3, "PASS"), "edge": (120, "PASS"), "old": (120, "WARN"), "dead": (420, "ERROR"), "none": (None, "ERROR")}


def test_relationships_need_one_shuffle_of_values(spark):
    rules = [
        quality.Relationship("a", "child", "x", "parent", "k"), quality.Relationship("b", "child", "y", "parent", "k", "WARN"),
        quality.Relationship("c", "parent", "k", "child", "x"), quality.Relationship("d", "none", "x", "parent", "k"),
    ]
    tables = {
        "child": spark.createDataFrame([(1, "1"), (1, "9"), (7, None), (7, "9"), (None, "2")], "x int, y string"),
        "parent": spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"),
        "none": spark.createDataFrame([], "x int"),
    }
    got = quality.relationships(tables, rules, datetime(2026, 8, 21))
    assert {(r.TEST_NAME, r.TARGET, r.FAIL_COUNT, r.STATUS) for r in got.collect()} == {
        ("a", "child", 2, "FAIL"), ("b", "child", 2, "WARN"), ("c", "parent", 2, "FAIL"), ("d", "none", 0, "PASS")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(rule") <= 4 and "Join" not in plan.replace("BroadcastHashJoin", "")
