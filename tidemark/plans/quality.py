"""Data quality rules, freshness and load audit. A rule counts the rows that break it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.scalars import as_timestamp, minutes_between
from tidemark.operators.changes import join_side
from tidemark.operators.typing import reject_reason, unparsable_fields
from tidemark.plans.gold import is_dead_booking
from tidemark.specs import SAFE, EntitySpec, Policy

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class RowRule:
    """Breaks where `broken` is true; NULL is not a violation. Rules of one table share one pass."""

    name: str
    target: str
    broken: Callable[[], Column]
    severity: str = "FAIL"


@dataclass(frozen=True)
class TableRule:
    """`failures` gives one row with the number of violations in `n`."""

    name: str
    target: str
    failures: Callable[[Tables], DataFrame]
    severity: str = "FAIL"


def not_null(name: str, target: str, column: str) -> RowRule:
    return RowRule(name, target, lambda: F.col(column).isNull())


def accepted(name: str, target: str, column: str, values: tuple[str, ...]) -> RowRule:
    return RowRule(name, target, lambda: ~F.col(column).isin(*values))


def not_negative(name: str, target: str, column: str) -> RowRule:
    return RowRule(name, target, lambda: F.col(column) < 0, "WARN")


def unique(name: str, target: str, column: str) -> TableRule:
    """Counts the values that occur more than once."""

    def failures(tables: Tables) -> DataFrame:
        repeated = tables[target].groupBy(column).count().filter(F.col("count") > 1)
        return repeated.agg(F.count("*").alias("n"))

    return TableRule(name, target, failures)


def foreign_key(
    name: str, target: str, column: str, parent: str, parent_key: str, live_only: bool = True
) -> TableRule:
    """Rows without a parent: live rows, or all of a table that knows no soft deletes. A soft-deleted
    parent still counts as one.

    Children are counted per key first, so a parent with very many children is one row in the join.
    """

    def failures(tables: Tables) -> DataFrame:
        rows = tables[target].filter(~F.col(K.IS_DELETED)) if live_only else tables[target]
        children = rows.groupBy(column).count()
        parents = tables[parent].select(F.col(parent_key).alias(column))
        orphans = children.join(join_side(parents, small=False), column, "left_anti")
        return orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"))

    return TableRule(name, target, failures)


@dataclass(frozen=True)
class Relationship:
    """Every value of `column` occurs as `key` of `parent`; rows without a value are not asked."""

    name: str
    target: str
    column: str
    parent: str
    key: str
    severity: str = "FAIL"


def relationships(tables: Tables, rules: list[Relationship], run_ts=None) -> DataFrame:
    """The result rows of many relationships from one aggregate over the values of all their sides.

    Every table is read once: a row gives a value for each side it takes part in. Values are counted per rule
    before the shuffle, so a parent with very many children is one row per task. Values meet as text.
    """
    parts = []
    for name in dict.fromkeys([*(r.target for r in rules), *(r.parent for r in rules)]):
        sides = [
            F.struct(F.lit(i).alias("rule"), F.col(column).cast("string").alias("value"), F.lit(child).alias("child"))
            for i, r in enumerate(rules)
            for table, column, child in ((r.target, r.column, True), (r.parent, r.key, False))
            if table == name
        ]
        parts.append(tables[name].select(F.inline(F.array(*sides))))
    values = reduce(DataFrame.unionByName, parts).filter(F.col("value").isNotNull())
    counted = values.groupBy("rule", "value").agg(F.count_if("child").alias("children"), F.bool_or(~F.col("child")).alias("found"))
    broken = counted.groupBy("rule").agg(F.sum(F.when(~F.col("found"), F.col("children")).otherwise(0)).alias("n"))
    lines = F.array(*[_line(r, F.lit(0)) for r in rules])
    asked = tables[rules[0].target].sparkSession.range(1).select(F.posexplode(lines).alias("rule", "line"))
    results = asked.join(F.broadcast(broken), "rule", "left")  # a row per rule on either side
    count = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    status = F.when(count == 0, "PASS").otherwise(F.col("line.SEVERITY"))
    return results.select(
        as_timestamp(run_ts).alias("RUN_TS"), "line.TEST_NAME", "line.TARGET", count.alias("FAIL_COUNT"), status.alias("STATUS"))


def no_dead_parent(name: str, target: str, parent: str, key: str) -> TableRule:
    """Rows whose parent is deleted or cancelled."""

    def failures(tables: Tables) -> DataFrame:
        dead = tables[parent].filter(is_dead_booking()).select(key)
        return tables[target].select(key).join(join_side(dead, small=False), key, "inner").agg(F.count("*").alias("n"))

    return TableRule(name, target, failures)


# Rule names and targets, as reports name them.
SILVER_BOOKING, SILVER_CLAIM, GOLD_FACT = "SILVER.BOOKING", "SILVER.CLAIM", "GOLD.BOOKING_FACT"
GOLD_DAILY = "GOLD.DAILY_ROUTE_SUMMARY"

PIPELINE_RULES = [
    unique("unique_booking_id", SILVER_BOOKING, "BOOKING_ID"),
    not_null("not_null_booking_id", SILVER_BOOKING, "BOOKING_ID"),
    accepted("accepted_booking_status", SILVER_BOOKING, "BOOKING_STATUS", K.BOOKING_STATUSES),
    foreign_key("fk_claim_to_booking", SILVER_CLAIM, "BOOKING_ID", SILVER_BOOKING, "BOOKING_ID"),
    not_negative("net_revenue_not_negative", GOLD_FACT, "NET_REVENUE"),
    no_dead_parent("gold_excludes_cancelled", GOLD_FACT, SILVER_BOOKING, "BOOKING_ID"),
]

GOLD_RULES = [
    not_null("not_null_booking_id", GOLD_FACT, "BOOKING_ID"),
    unique("unique_booking_id", GOLD_FACT, "BOOKING_ID"),
    not_null("not_null_fare_amount", GOLD_FACT, "FARE_AMOUNT"),
    accepted("accepted_revenue_band", GOLD_FACT, "REVENUE_BAND", K.REVENUE_BANDS),
    accepted("accepted_booking_status", GOLD_FACT, "BOOKING_STATUS", K.LIVE_BOOKING_STATUSES),
    not_null("not_null_bookings", GOLD_DAILY, "BOOKINGS"),
]


def run_rules(tables: Tables, rules: list, run_ts=None) -> DataFrame:
    """One row per rule: RUN_TS, TEST_NAME, TARGET, FAIL_COUNT, STATUS."""
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    parts = []
    for target in dict.fromkeys(r.target for r in row_rules):
        same = [r for r in row_rules if r.target == target]
        counted = tables[target].agg(*[F.count_if(r.broken()).alias(f"n{i}") for i, r in enumerate(same)])
        lines = F.array(*[_line(r, F.col(f"n{i}")) for i, r in enumerate(same)])
        parts.append(counted.select(F.inline(lines)))
    for rule in rules:
        if isinstance(rule, TableRule):
            parts.append(rule.failures(tables).select(_line(rule, F.col("n")).alias("l")).select("l.*"))
    results = reduce(DataFrame.unionByName, parts)
    status = F.when(F.col("FAIL_COUNT") == 0, "PASS").otherwise(F.col("SEVERITY"))
    return results.select(
        as_timestamp(run_ts).alias("RUN_TS"), "TEST_NAME", "TARGET", "FAIL_COUNT", status.alias("STATUS")
    )


def _line(rule, count: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("TEST_NAME"),
        F.lit(rule.target).alias("TARGET"),
        count.cast("long").alias("FAIL_COUNT"),
        F.lit(rule.severity).alias("SEVERITY"),
    )


def freshness(
    tables: dict[str, tuple[DataFrame, str]],
    run_ts: datetime,
    warn_hours: float = K.FRESHNESS_WARN_HOURS,
    error_hours: float = K.FRESHNESS_ERROR_HOURS,
) -> DataFrame:
    """Newest stamp of each table, its lag in minutes and its state against the limits."""

    def line(name: str, df: DataFrame, column: str) -> DataFrame:
        last = F.max(column)
        return df.agg(last.alias("LAST_UPDATE")).select(F.lit(name).alias("OBJ"), "LAST_UPDATE")

    lines = reduce(DataFrame.unionByName, [line(n, df, c) for n, (df, c) in tables.items()])
    last = F.col("LAST_UPDATE")
    state = (
        F.when(last >= as_timestamp(run_ts - timedelta(hours=warn_hours)), "PASS")
        .when(last >= as_timestamp(run_ts - timedelta(hours=error_hours)), "WARN")
        .otherwise("ERROR")
    )
    lag = minutes_between(last, as_timestamp(run_ts))
    return lines.select("OBJ", "LAST_UPDATE", lag.alias("LAG_MIN"), state.alias("STATUS"))


def load_audit(raw: DataFrame, spec: EntitySpec, policy: Policy = SAFE, loaded_at: bool = False) -> DataFrame:
    """Per source file: rows, rows set aside, fields that did not parse, and when it was loaded if wanted."""
    return raw.groupBy(K.SRC_FILE).agg(
        *([F.max(K.LOAD_TS).alias("LOADED_AT")] if loaded_at else []),
        F.lit(spec.name).alias("ENTITY"),
        F.count("*").alias("ROWS_READ"),
        F.count_if(reject_reason(spec, policy).isNotNull()).alias("ROWS_REJECTED"),
        F.sum(unparsable_fields(spec)).alias("FIELDS_UNPARSABLE"),
    )
