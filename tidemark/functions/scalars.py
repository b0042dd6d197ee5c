"""Column helpers. All are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.specs import MONEY, SEQUENCE, Field


def session_now(spark: SparkSession) -> datetime:
    """The current moment by the clock that stamps rows: Spark's, in the session's time zone."""
    return spark.sql("SELECT localtimestamp() AS t").first()["t"]


def as_timestamp(run_ts: datetime | Column | None) -> Column:
    """The stamp to write: a given moment, a column of the data, or the current moment."""
    if run_ts is None:
        return F.localtimestamp()
    if isinstance(run_ts, Column):
        return run_ts
    # through text: a Python datetime literal would pass through the session time zone
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def blank_to_null(c: Column) -> Column:
    value = F.trim(c)
    return F.when(~value.isin(*K.NULL_TOKENS), value)


def try_sequence(c: Column) -> Column:
    """38-digit whole number or NULL; a log sequence may exceed 64 bits."""
    return c.try_cast(SEQUENCE)


def try_money(c: Column) -> Column:
    return c.try_cast(MONEY)


def try_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def code(c: Column) -> Column:
    return F.upper(F.trim(c))


def yes_flag(c: Column) -> Column:
    return F.upper(c) == "Y"


_READERS = {
    "text": lambda c: c,
    "code": code,
    "currency": lambda c: F.coalesce(c, F.lit(K.DEFAULT_CURRENCY)),
    "money": try_money,
    "timestamp": try_timestamp,
    "flag": yes_flag,
}


def read_field(field: Field) -> Column:
    """The typed value of a silver column, read from its raw text."""
    return _READERS[field.kind](F.col(field.source))


def is_unparsable(field: Field) -> Column:
    """True where the raw text is present but gives no value."""
    return F.col(field.source).isNotNull() & read_field(field).isNull()


def minutes_between(earlier: Column, later: Column) -> Column:
    """Minute boundaries crossed between two zone-less timestamps."""

    def minute_of_day(c: Column) -> Column:
        return F.hour(c) * 60 + F.minute(c)

    days = F.datediff(F.to_date(later), F.to_date(earlier))
    return (days * 1440 + minute_of_day(later) - minute_of_day(earlier)).cast("long")


def percentage(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals. Computed in decimal, so the rounding is exact."""
    ratio = (part.cast("decimal(18,0)") * F.lit(100)).cast("decimal(20,0)") / whole.cast("decimal(18,0)")
    return F.round(ratio, 2).cast("double")
