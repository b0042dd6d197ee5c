"""Declarations of the three entities: file layout, typed columns, keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tidemark import constants as K

MONEY = T.DecimalType(12, 2)
# Wider than one amount: a booking with very many claims must not overflow.
MONEY_TOTAL = T.DecimalType(24, 2)
SEQUENCE = T.DecimalType(38, 0)

# Column kind -> type in silver. How a kind is read from text: functions/scalars.py.
KIND_TYPES = {
    "text": T.StringType(),
    "code": T.StringType(),
    "currency": T.StringType(),
    "money": MONEY,
    "timestamp": T.TimestampNTZType(),
    "flag": T.BooleanType(),
}


@dataclass(frozen=True)
class Field:
    """One silver column, read from the raw column `raw` (same name if not given)."""

    name: str
    kind: str = "text"
    raw: str | None = None

    @property
    def source(self) -> str:
        return self.raw or self.name


@dataclass(frozen=True)
class EntitySpec:
    """One change feed. `raw_columns` is the order of the file columns before the change header.

    `delete_image` says what a delete record carries: "full" overwrites the stored row with the
    record's columns, "key_only" keeps the stored columns and sets the deleted flag.
    """

    name: str
    key: str
    raw_columns: tuple[str, ...]
    fields: tuple[Field, ...]
    parent_key: str = "BOOKING_ID"
    delete_image: str = "full"

    @property
    def file_columns(self) -> tuple[str, ...]:
        return (*self.raw_columns, K.CHANGE_OPER, K.CHANGE_SEQ, K.CHANGE_TS)

    @property
    def file_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.file_columns])

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType(
            [
                *self.file_schema.fields,
                T.StructField(K.SRC_FILE, T.StringType()),
                T.StructField(K.LOAD_TS, T.TimestampNTZType()),
            ]
        )

    @property
    def state_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.key, T.StringType()),
                *[T.StructField(f.name, KIND_TYPES[f.kind]) for f in self.fields],
                T.StructField(K.IS_DELETED, T.BooleanType()),
                T.StructField(K.CHANGE_SEQ, SEQUENCE),
                T.StructField(K.UPDATED_AT, T.TimestampNTZType()),
            ]
        )

    @property
    def state_columns(self) -> list[str]:
        return self.state_schema.names


BOOKING = EntitySpec(
    name="booking",
    key="BOOKING_ID",
    raw_columns=(
        "BOOKING_ID", "PASSENGER_ID", "FLIGHT_NUMBER", "ORIGIN", "DESTINATION",
        "BOOKING_TS", "BOOKING_STATUS", "FARE_AMOUNT", "CURRENCY", "CHANNEL",
    ),
    fields=(
        Field("PASSENGER_ID"),
        Field("FLIGHT_NUMBER"),
        Field("ORIGIN", "code"),
        Field("DESTINATION", "code"),
        Field("BOOKING_TS", "timestamp"),
        Field("BOOKING_STATUS"),
        Field("FARE_AMOUNT", "money"),
        Field("CURRENCY", "currency"),
        Field("CHANNEL"),
    ),
)

RESERVATION = EntitySpec(
    name="reservation",
    key="RESERVATION_ID",
    raw_columns=(
        "RESERVATION_ID", "BOOKING_ID", "SEAT_NUMBER", "CABIN_CLASS",
        "RESERVATION_STATUS", "CHECKED_IN_FLAG", "UPDATED_TS",
    ),
    fields=(
        Field("BOOKING_ID"),
        Field("SEAT_NUMBER"),
        Field("CABIN_CLASS"),
        Field("RESERVATION_STATUS"),
        Field("CHECKED_IN", "flag", raw="CHECKED_IN_FLAG"),
    ),
)

CLAIM = EntitySpec(
    name="claim",
    key="CLAIM_ID",
    raw_columns=(
        "CLAIM_ID", "BOOKING_ID", "CLAIM_TYPE", "CLAIM_STATUS",
        "CLAIM_AMOUNT", "FILED_TS", "SETTLED_TS",
    ),
    fields=(
        Field("BOOKING_ID"),
        Field("CLAIM_TYPE"),
        Field("CLAIM_STATUS"),
        Field("CLAIM_AMOUNT", "money"),
        Field("FILED_TS", "timestamp"),
        Field("SETTLED_TS", "timestamp"),
    ),
)

ENTITIES = (BOOKING, RESERVATION, CLAIM)

FACT_KEY = "BOOKING_ID"

FACT_SCHEMA = T.StructType(
    [
        T.StructField("BOOKING_ID", T.StringType()),
        T.StructField("PASSENGER_ID", T.StringType()),
        T.StructField("FLIGHT_NUMBER", T.StringType()),
        T.StructField("ROUTE", T.StringType()),
        T.StructField("BOOKING_DATE", T.DateType()),
        T.StructField("BOOKING_STATUS", T.StringType()),
        T.StructField("CHANNEL", T.StringType()),
        T.StructField("CABIN_CLASS", T.StringType()),
        T.StructField("CHECKED_IN", T.BooleanType()),
        T.StructField("FARE_AMOUNT", MONEY),
        T.StructField("CLAIM_COUNT", T.LongType()),
        T.StructField("CLAIM_AMOUNT", MONEY_TOTAL),
        T.StructField("NET_REVENUE", MONEY_TOTAL),
        T.StructField("REVENUE_BAND", T.StringType()),
        T.StructField("IS_AT_RISK", T.BooleanType()),
        T.StructField("LOAD_TS", T.TimestampNTZType()),
    ]
)

# The outbound feed carries every fact column but the load timestamp.
EXPORT_COLUMNS = [c for c in FACT_SCHEMA.names if c != "LOAD_TS"]


@dataclass(frozen=True)
class Policy:
    """How changes are applied.

    guard             skip a change that is not newer than the stored row
    quarantine        set aside rows whose key or sequence is unusable, or whose code is too long
    null_op_is_live   a row without an operation code counts as not deleted
    all_sources       changes of all three entities refresh the fact, not only booking changes
    """

    guard: bool = True
    quarantine: bool = True
    null_op_is_live: bool = True
    all_sources: bool = True


SAFE = Policy()
# Last delivery wins, nothing is set aside, only booking changes reach the fact.
AS_DELIVERED = Policy(guard=False, quarantine=False, null_op_is_live=False, all_sources=False)
