from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tests.build import BOOKING, RESERVATION, by_key, raw
from tidemark.functions import scalars
from tidemark.operators.typing import split_rejects, typed
from tidemark.plans.quality import load_audit
from tidemark.specs import AS_DELIVERED, SAFE


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_values_are_read_leniently(spark):
    rows = raw(
        spark, BOOKING,
        {"id": "a", "FARE_AMOUNT": "12.345", "ORIGIN": " jfk ", "CURRENCY": None},
        {"id": "b", "FARE_AMOUNT": "12,00", "BOOKING_TS": "yesterday", "DESTINATION": "l"},
        {"id": "c", "FARE_AMOUNT": "99999999999.00"},
        {"id": "d", "FARE_AMOUNT": None, "BOOKING_TS": None, "BOOKING_STATUS": None},
    )
    got = by_key(typed(rows, BOOKING), "BOOKING_ID")
    assert got["a"].FARE_AMOUNT == Decimal("12.35") and got["a"].ORIGIN == "JFK" and got["a"].CURRENCY == "USD"
    assert got["b"].FARE_AMOUNT is None and got["b"].BOOKING_TS is None and got["b"].DESTINATION == "L"
    assert got["c"].FARE_AMOUNT is None
    assert got["d"].BOOKING_STATUS is None and got["d"].BOOKING_TS is None


def test_sequence_keeps_38_digits_and_rounds(spark):
    assert one(spark, scalars.try_sequence(F.lit("12345678901234567890123456789"))) == Decimal(
        "12345678901234567890123456789"
    )
    assert one(spark, scalars.try_sequence(F.lit("1.5"))) == 2
    assert one(spark, scalars.try_sequence(F.lit(" 7 "))) == 7
    assert one(spark, scalars.try_sequence(F.lit("x"))) is None


def test_flags_are_three_valued(spark):
    rows = raw(
        spark, RESERVATION,
        {"id": "a", "CHECKED_IN_FLAG": "y"}, {"id": "b", "CHECKED_IN_FLAG": "N"}, {"id": "c", "CHECKED_IN_FLAG": None},
    )
    got = by_key(typed(rows, RESERVATION), "RESERVATION_ID")
    assert [got[k].CHECKED_IN for k in "abc"] == [True, False, None]


def test_missing_operation(spark):
    rows = raw(spark, BOOKING, {"id": "a", "op": None}, {"id": "b", "op": "D"}, {"id": "c", "op": "L"})
    safe = by_key(typed(rows, BOOKING, SAFE), "BOOKING_ID")
    plain = by_key(typed(rows, BOOKING, AS_DELIVERED), "BOOKING_ID")
    assert [safe[k].IS_DELETED for k in "abc"] == [False, True, False]
    assert [plain[k].IS_DELETED for k in "abc"] == [None, True, False]


def test_unusable_rows_are_set_aside(spark):
    rows = raw(
        spark, BOOKING,
        {"id": None}, {"id": "b", "seq": "x"}, {"id": "c", "seq": None},
        {"id": "d", "ORIGIN": "ABCD"}, {"id": "e", "CURRENCY": "EURO"}, {"id": "f"},
    )
    usable, rejected = split_rejects(rows, BOOKING)
    assert [r.BOOKING_ID for r in usable.collect()] == ["f"]
    reasons = {r.BOOKING_ID: r.REJECT_REASON for r in rejected.collect()}
    assert reasons == {
        None: "missing key", "b": "unusable sequence", "c": "unusable sequence",
        "d": "ORIGIN too long", "e": "CURRENCY too long",
    }
    assert typed(rows, BOOKING, AS_DELIVERED).count() == 5  # only the row without a key cannot be stored


def test_load_audit(spark):
    rows = raw(
        spark, BOOKING,
        {"id": "a", "FARE_AMOUNT": "n/a", "BOOKING_TS": "??"}, {"id": None}, {"id": "c", "SRC_FILE": "g.csv"},
    )
    got = {r.SRC_FILE: (r.ROWS_READ, r.ROWS_REJECTED, r.FIELDS_UNPARSABLE) for r in load_audit(rows, BOOKING).collect()}
    assert got == {"f.csv": (2, 1, 2), "g.csv": (1, 0, 0)}


def test_minutes_count_boundaries(spark):
    def lag(a, b):
        return one(spark, scalars.minutes_between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz")))

    assert lag("2026-01-01 09:12:59", "2026-01-01 09:13:01") == 1
    assert lag("2026-01-01 09:12:01", "2026-01-01 09:12:59") == 0
    assert lag("2025-12-31 23:59:59", "2026-01-02 00:00:00") == 1441
    assert lag("2026-01-01 10:00:00", "2026-01-01 09:00:30") == -60


def test_percentage_is_exact(spark):
    def share(a, b):
        return one(spark, scalars.percentage(F.lit(a), F.lit(b)))

    assert share(1, 3) == 33.33 and share(2, 3) == 66.67 and share(1, 20000) == 0.01 and share(0, 5) == 0.0


def test_stamp_is_free_of_time_zones(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, scalars.as_timestamp(datetime(2026, 3, 8, 2, 30))) == datetime(2026, 3, 8, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
