"""Business layer: claim roll-up, booking fact, daily route aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark.functions.scalars import as_timestamp, percentage
from tidemark.operators.changes import CHANGE_TYPE, PRE, join_side
from tidemark.operators.latest import latest_per_key
from tidemark.specs import FACT_KEY, FACT_SCHEMA, MONEY_TOTAL

DAILY_ROUTE_KEYS = ["BOOKING_DATE", "ROUTE", "CHANNEL"]


def is_live(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(K.IS_DELETED))


def is_dead_booking() -> Column:
    return F.col(K.IS_DELETED) | (F.col("BOOKING_STATUS") == K.CANCELLED)


def claim_rollup(claim: DataFrame) -> DataFrame:
    """Per booking: number, total, settled total and open number of live claims.

    The partial aggregate runs before the shuffle, so a booking with very many claims sends one row
    per task. Claims without a booking belong to no group and are left out.
    """
    amount = F.col("CLAIM_AMOUNT")
    status = F.col("CLAIM_STATUS")
    return (
        is_live(claim)
        .filter(F.col(FACT_KEY).isNotNull())
        .groupBy(FACT_KEY)
        .agg(
            F.count("*").alias("CLAIM_COUNT"),
            F.sum(amount).alias("CLAIM_AMOUNT"),
            F.sum(F.when(status == K.SETTLED, amount).otherwise(0)).alias("SETTLED_AMOUNT"),
            F.count_if(status == K.OPEN).alias("OPEN_CLAIMS"),
        )
    )


def live_reservation(reservation: DataFrame) -> DataFrame:
    """One live reservation per booking: the newest by sequence, then by id."""
    rows = is_live(reservation).filter(F.col(FACT_KEY).isNotNull())
    rows = rows.select(FACT_KEY, "RESERVATION_ID", "CABIN_CLASS", "CHECKED_IN", K.CHANGE_SEQ)
    newest = latest_per_key(rows, FACT_KEY, K.CHANGE_SEQ, ["RESERVATION_ID"])
    return newest.select(FACT_KEY, "CABIN_CLASS", "CHECKED_IN")


def revenue_band(fare: Column) -> Column:
    (high, high_from), (medium, medium_from) = K.BAND_HIGH, K.BAND_MEDIUM
    return F.when(fare >= high_from, high).when(fare >= medium_from, medium).otherwise(K.BAND_LOW)


def booking_fact(
    booking: DataFrame,
    reservation: DataFrame,
    claim: DataFrame,
    keys: DataFrame | None = None,
    small_keys: bool = False,
    run_ts=None,
) -> DataFrame:
    """One row per live booking, for all bookings or for those in `keys`.

    The keys cut all three inputs, however many they are; `small_keys` (checked size) only says that
    they may be broadcast for it.
    """
    if keys is not None:
        wanted = join_side(keys, small_keys)
        booking, reservation, claim = (
            t.join(wanted, FACT_KEY, "left_semi") for t in (booking, reservation, claim)
        )

    bookings = is_live(booking).filter(F.col("BOOKING_STATUS") != K.CANCELLED)
    parts = [live_reservation(reservation), claim_rollup(claim)]
    if keys is None or not small_keys:  # as many rows as there are bookings
        parts = [join_side(p, small=False) for p in parts]
    joined = bookings.join(parts[0], FACT_KEY, "left").join(parts[1], FACT_KEY, "left")
    fare = F.col("FARE_AMOUNT")
    checked_in = F.coalesce("CHECKED_IN", F.lit(False))
    open_claims = F.coalesce("OPEN_CLAIMS", F.lit(0))
    derived = {
        "ROUTE": F.concat("ORIGIN", F.lit("-"), "DESTINATION"),
        "BOOKING_DATE": F.to_date("BOOKING_TS"),
        "CHECKED_IN": checked_in,
        "CLAIM_COUNT": F.coalesce("CLAIM_COUNT", F.lit(0)),
        "CLAIM_AMOUNT": F.coalesce("CLAIM_AMOUNT", F.lit(0)).cast(MONEY_TOTAL),
        "NET_REVENUE": (fare - F.coalesce("SETTLED_AMOUNT", F.lit(0))).cast(MONEY_TOTAL),
        "REVENUE_BAND": revenue_band(fare),
        "IS_AT_RISK": (open_claims > 0) | ~checked_in,
        "LOAD_TS": as_timestamp(run_ts),
    }
    return joined.select(*[derived.get(c, F.col(c)).alias(c) for c in FACT_SCHEMA.names])


def fact_changes(fact: DataFrame | None, live: DataFrame, keys: DataFrame, small_keys: bool = False) -> DataFrame:
    """Change set of the fact for refreshed `keys`: rows of `live` are written, the others leave.

    A key that `live` does not produce (deleted, cancelled, without status) is removed, so no stale
    row can stay behind.
    """
    names = FACT_SCHEMA.names
    if fact is None:
        nothing = F.lit(None).cast(FACT_SCHEMA)
        return live.select(*names, nothing.alias(PRE), F.lit("insert").alias(CHANGE_TYPE))
    old = fact.join(join_side(keys, small_keys), FACT_KEY, "left_semi")
    return _paired(old, live)


def fact_changes_as_delivered(fact: DataFrame | None, live: DataFrame, booking: DataFrame) -> DataFrame:
    """Change set of the fact when only `live` rows are merged and dead bookings are then deleted.

    A fact row whose booking is neither live nor dead stays as it was. `live` is computed once: a
    fact has one row per booking, so each row of `live` meets the row it replaces, or none.
    """
    if fact is None:
        return fact_changes(None, live, live.select(FACT_KEY))
    dead = booking.filter(is_dead_booking()).select(FACT_KEY)
    removed = fact.join(join_side(dead, small=False), FACT_KEY, "left_semi")
    names = FACT_SCHEMA.names
    deletes = removed.select(
        FACT_KEY,
        *[F.lit(None).cast(FACT_SCHEMA[c].dataType).alias(c) for c in names if c != FACT_KEY],
        F.struct(*names).alias(PRE),
        F.lit("delete").alias(CHANGE_TYPE),
    )
    return _paired(fact, live, "right").unionByName(deletes)


def _paired(old: DataFrame, new: DataFrame, how: str = "full") -> DataFrame:
    names = FACT_SCHEMA.names
    before = old.select(F.col(FACT_KEY), F.struct(*names).alias(PRE))
    after = new.select(F.col(FACT_KEY), F.struct(*names).alias("_post"))
    kind = (
        F.when(F.col(PRE).isNull(), "insert").when(F.col("_post").isNull(), "delete").otherwise("update")
    )
    return before.join(join_side(after, small=False), FACT_KEY, how).select(
        FACT_KEY,
        *[F.col(f"_post.{c}").alias(c) for c in names if c != FACT_KEY],
        PRE,
        kind.alias(CHANGE_TYPE),
    )


def merge_fact(fact: DataFrame, live: DataFrame, keys: DataFrame, small_keys: bool = False) -> DataFrame:
    """The fact after a refresh of `keys`: their rows leave, the rows of `live` come in."""
    kept = fact.join(join_side(keys, small_keys), FACT_KEY, "left_anti")
    return kept.unionByName(live)


def merge_fact_as_delivered(fact: DataFrame, live: DataFrame, booking: DataFrame) -> DataFrame:
    """The fact after merging `live` and deleting the dead bookings of silver."""
    merged = fact.join(live.select(FACT_KEY), FACT_KEY, "left_anti").unionByName(live)
    dead = booking.filter(is_dead_booking()).select(FACT_KEY)
    return merged.join(dead, FACT_KEY, "left_anti")


def daily_route(fact: DataFrame) -> DataFrame:
    """Dashboard aggregate by day, route and channel."""
    return fact.groupBy(*DAILY_ROUTE_KEYS).agg(
        F.count("*").alias("BOOKINGS"),
        F.sum("FARE_AMOUNT").alias("GROSS_REVENUE"),
        F.sum("NET_REVENUE").alias("NET_REVENUE"),
        F.sum("CLAIM_AMOUNT").alias("CLAIM_EXPOSURE"),
        F.count_if("IS_AT_RISK").alias("AT_RISK_BOOKINGS"),
    )


def with_share(daily: DataFrame) -> DataFrame:
    """The dashboard aggregate with the share of bookings at risk."""
    return daily.withColumn("AT_RISK_PCT", percentage(F.col("AT_RISK_BOOKINGS"), F.col("BOOKINGS")))


def daily_route_summary(fact: DataFrame) -> DataFrame:
    return with_share(daily_route(fact))


# ---- the same, kept up by images of changes ----------------------------------------------

# What a group holds: sums that start at nothing, and how many values are behind those that may be unknown.
TOTALS = {
    "BOOKINGS": lambda: F.lit(1),
    "GROSS_REVENUE": lambda: F.coalesce("FARE_AMOUNT", F.lit(0)),
    "NET_REVENUE": lambda: F.coalesce("NET_REVENUE", F.lit(0)),
    "CLAIM_EXPOSURE": lambda: F.coalesce("CLAIM_AMOUNT", F.lit(0)),
    "AT_RISK_BOOKINGS": lambda: F.coalesce(F.col("IS_AT_RISK").cast("int"), F.lit(0)),
    "KNOWN_FARES": lambda: F.col("FARE_AMOUNT").isNotNull().cast("int"),
    "KNOWN_NET": lambda: F.col("NET_REVENUE").isNotNull().cast("int"),
    "KNOWN_CLAIMS": lambda: F.col("CLAIM_AMOUNT").isNotNull().cast("int"),
}
KNOWN = {"GROSS_REVENUE": "KNOWN_FARES", "NET_REVENUE": "KNOWN_NET", "CLAIM_EXPOSURE": "KNOWN_CLAIMS"}


def _summed(rows: DataFrame) -> DataFrame:
    kinds = {name: T.DecimalType(34, 2) if name in KNOWN else T.LongType() for name in TOTALS}
    return rows.groupBy(*DAILY_ROUTE_KEYS).agg(*[F.sum(n).cast(k).alias(n) for n, k in kinds.items()])


def daily_totals(fact: DataFrame) -> DataFrame:
    """Totals of every day, route and channel of a whole fact."""
    return _summed(fact.select(*DAILY_ROUTE_KEYS, *[c().alias(n) for n, c in TOTALS.items()]))


def maintained_totals(totals: DataFrame, images: DataFrame) -> DataFrame:
    """Totals after changes of the fact, given as images before (taken off) and after (added). Groups without
    a booking leave. The images are summed per group before they meet the totals."""
    before = F.col(CHANGE_TYPE).isin("delete", "update_preimage")
    signed = {n: F.when(before, -c()).otherwise(c()).alias(n) for n, c in TOTALS.items()}
    changed = _summed(images.select(*DAILY_ROUTE_KEYS, *signed.values()))
    return _summed(totals.unionByName(changed)).filter("BOOKINGS > 0")


def totals_shown(totals: DataFrame) -> DataFrame:
    """The dashboard aggregate from totals: a sum without any known value is unknown."""
    shown = [F.when(F.col(KNOWN[n]) > 0, F.col(n)).alias(n) if n in KNOWN else F.col(n) for n in TOTALS if not n.startswith("KNOWN")]
    return totals.select(*DAILY_ROUTE_KEYS, *shown)
