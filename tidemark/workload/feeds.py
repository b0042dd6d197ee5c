"""Change feeds derived from the order tables: every order and every line becomes changes.

Batch 0 is the full load, batch 1 the changes, batch 2 a late delivery of older booking changes.

booking      one log per order. Orders of priority 5-LOW arrive as inserts after the full load;
             pending orders are confirmed at a 10% higher fare; confirmed 2-HIGH orders are
             cancelled; confirmed 4-NOT SPECIFIED orders are deleted; pending 3-MEDIUM orders have
             an older change that is delivered late.
claim        one change per line, keyed by order and line number: several lines of a key are
             successive changes, ordered by ship date.
reservation  one change per line, keyed by order and line status, so an order may hold two.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.scalars import try_timestamp
from tidemark.operators.changes import upsert
from tidemark.operators.latest import newest_changes
from tidemark.operators.typing import typed
from tidemark.session import prepare
from tidemark.specs import BOOKING, CLAIM, ENTITIES, RESERVATION, SAFE, EntitySpec, Policy

BATCH = "BATCH"
FULL, DELTA, LATE = 0, 1, 2
PREFIXES = {FULL: "fullload", DELTA: "cdc", LATE: "late"}
DELTA_FROM = "2000-01-01"
# Rows of a compressed landing file: what one task reads of it.
FILE_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cases(c: str, mapping: dict[str, str]) -> Column:
    value = F.col(c)
    result = value
    for text, meaning in mapping.items():
        result = F.when(value == text, meaning).otherwise(result)
    return result


def _scaled(c: str, factor: str, kind: str) -> Column:
    """A price as money, in exact decimals so that every engine rounds alike."""
    return (F.col(c).cast("decimal(12,2)") * F.lit(factor).cast(kind)).cast("decimal(12,2)")


def _raw(df: DataFrame, spec: EntitySpec, batches: tuple[int, ...]) -> DataFrame:
    prefix = F.element_at(F.create_map(*[F.lit(x) for kv in PREFIXES.items() for x in kv]), F.col(BATCH))
    rows = df.select(
        *spec.file_columns,
        F.concat(prefix, F.lit(f"/{spec.name}.csv")).alias(K.SRC_FILE),
        F.col(K.CHANGE_TS).try_cast("timestamp_ntz").alias(K.LOAD_TS),
        BATCH,
    )
    return rows.filter(F.col(BATCH).isin(*batches)) if batches else rows


def booking_feed(spark: SparkSession, sf_dir: str, *batches: int) -> DataFrame:
    """The log of the given batches (all by default): changes of other batches are not even built."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    base = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    status = _cases("o_orderstatus", {"P": "PENDING", "O": "CONFIRMED", "F": K.CANCELLED})
    priority, code = F.col("o_orderpriority"), F.col("o_orderstatus")

    def change(when: Column, batch: int, pos: int, op: str, state: Column, factor: str) -> tuple[int, Column]:
        return batch, F.when(
            when,
            F.struct(
                F.lit(batch).alias(BATCH),
                F.lit(pos).alias("pos"),
                F.lit(op).alias("op"),
                state.alias("status"),
                F.lit(factor).cast("decimal(3,2)").alias("factor"),
            ),
        )

    changes = [
        change(priority != "5-LOW", FULL, 1, K.OP_LOAD, status, "1.00"),
        change((priority == "3-MEDIUM") & (code == "P"), LATE, 2, K.OP_UPDATE, F.lit("PENDING"), "0.90"),
        change(priority == "5-LOW", DELTA, 3, K.OP_INSERT, status, "1.00"),
        change(code == "P", DELTA, 4, K.OP_UPDATE, F.lit("CONFIRMED"), "1.10"),
        change((priority == "2-HIGH") & (code == "O"), DELTA, 5, K.OP_UPDATE, F.lit(K.CANCELLED), "1.00"),
        change((priority == "4-NOT SPECIFIED") & (code == "O"), DELTA, 6, K.OP_DELETE, status, "1.00"),
    ]
    log = F.array_compact(F.array(*[c for batch, c in changes if batch in (batches or PREFIXES)]))
    rows = base.withColumn("c", F.explode(log))
    fare = (_scaled("o_totalprice", "0.004", "decimal(4,3)") * F.col("c.factor")).cast("decimal(12,2)")
    nation = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    named = rows.select(
        F.concat(F.lit("BK"), F.col("o_orderkey")).alias("BOOKING_ID"),
        F.concat(F.lit("PX"), F.col("o_custkey")).alias("PASSENGER_ID"),
        F.concat(F.lit("FL"), F.col("c_nationkey")).alias("FLIGHT_NUMBER"),
        F.concat(F.lit(" n"), nation, F.lit(" ")).alias("ORIGIN"),
        F.substring("c_mktsegment", 1, 3).alias("DESTINATION"),
        F.col("o_orderdate").cast("string").alias("BOOKING_TS"),
        F.col("c.status").alias("BOOKING_STATUS"),
        F.when((priority == "1-URGENT") & (code == "F"), "n/a").otherwise(fare.cast("string")).alias("FARE_AMOUNT"),
        F.when(code != "O", "EUR").alias("CURRENCY"),
        priority.alias("CHANNEL"),
        F.col("c.op").alias(K.CHANGE_OPER),
        (F.col("c.pos").cast("long") * 1_000_000_000_000 + F.col("o_orderkey")).cast("string").alias(K.CHANGE_SEQ),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("c.pos"))).cast("string").alias(K.CHANGE_TS),
        F.col(f"c.{BATCH}").alias(BATCH),
    )
    return _raw(named, BOOKING, batches)


def _line_batch() -> Column:
    return F.when(F.col("l_shipdate") < F.lit(DELTA_FROM).cast("timestamp_ntz"), FULL).otherwise(DELTA)


def _line_sequence() -> Column:
    """Ship day, part and supplier as one number of up to 29 digits: newer ship days are newer."""
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("string")
    wide = [F.lpad(F.col(c).cast("string"), 12, "0") for c in ("l_partkey", "l_suppkey")]
    return F.concat(day, *wide)


def _line_op(deleted: Column) -> Column:
    return F.when(_line_batch() == FULL, K.OP_LOAD).when(deleted, K.OP_DELETE).otherwise(K.OP_UPDATE)


def claim_feed(spark: SparkSession, sf_dir: str, *batches: int) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    shipped = F.col("l_shipdate").cast("string")
    gone = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_quantity") >= 25)
    named = line.select(
        F.concat(F.lit("CL"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("CLAIM_ID"),
        F.concat(F.lit("BK"), F.col("l_orderkey")).alias("BOOKING_ID"),
        _cases("l_linestatus", {"O": "BAGGAGE", "F": "DELAY"}).alias("CLAIM_TYPE"),
        _cases("l_returnflag", {"R": K.OPEN, "A": K.SETTLED, "N": "REJECTED"}).alias("CLAIM_STATUS"),
        _scaled("l_extendedprice", "0.001", "decimal(4,3)").cast("string").alias("CLAIM_AMOUNT"),
        shipped.alias("FILED_TS"),
        F.when(F.col("l_returnflag") == "A", shipped).alias("SETTLED_TS"),
        _line_op(gone).alias(K.CHANGE_OPER),
        _line_sequence().alias(K.CHANGE_SEQ),
        shipped.alias(K.CHANGE_TS),
        _line_batch().alias(BATCH),
    )
    return _raw(named, CLAIM, batches)


def reservation_feed(spark: SparkSession, sf_dir: str, *batches: int) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    shipped = F.col("l_shipdate").cast("string")
    flag = F.col("l_returnflag")
    named = line.select(
        F.concat(F.lit("RS"), F.col("l_orderkey"), F.lit("-"), F.col("l_linestatus")).alias("RESERVATION_ID"),
        F.concat(F.lit("BK"), F.col("l_orderkey")).alias("BOOKING_ID"),
        F.concat(F.col("l_linenumber"), flag).alias("SEAT_NUMBER"),
        _cases("l_returnflag", {"A": "FIRST", "N": "ECONOMY", "R": "BUSINESS"}).alias("CABIN_CLASS"),
        _cases("l_returnflag", {"A": "ACTIVE", "N": "HELD", "R": "ACTIVE"}).alias("RESERVATION_STATUS"),
        F.when(F.col("l_discount") >= 0.05, "y").otherwise("N").alias("CHECKED_IN_FLAG"),
        shipped.alias("UPDATED_TS"),
        _line_op(F.col("l_quantity") > 45).alias(K.CHANGE_OPER),
        F.concat(_line_sequence(), F.col("l_linenumber")).alias(K.CHANGE_SEQ),
        shipped.alias(K.CHANGE_TS),
        _line_batch().alias(BATCH),
    )
    return _raw(named, RESERVATION, batches)


FEEDS = {"booking": booking_feed, "reservation": reservation_feed, "claim": claim_feed}


def feed(spark: SparkSession, sf_dir: str, spec: EntitySpec, *batches: int) -> DataFrame:
    return FEEDS[spec.name](spark, sf_dir, *batches)


def newest(spark: SparkSession, sf_dir: str, spec: EntitySpec, *batches: int, policy: Policy = SAFE) -> DataFrame:
    """Newest typed change per key of the given batches, stamped with the change time."""
    rows = feed(spark, sf_dir, spec, *batches)
    return newest_changes(typed(rows, spec, policy, try_timestamp(F.col(K.CHANGE_TS))), spec)


def stepwise(spark: SparkSession, sf_dir: str, spec: EntitySpec, *batches: int, guard: bool = True) -> DataFrame:
    """The state after applying the batches one after the other."""
    state = None
    for batch in batches:
        state = upsert(state, newest(spark, sf_dir, spec, batch), spec, guard)
    return state


def raw_batches(spark: SparkSession, sf_dir: str, batch: int) -> dict[EntitySpec, DataFrame]:
    """One batch of every feed, as it would lie in raw."""
    return {e: feed(spark, sf_dir, e, batch).select(*e.raw_schema.names) for e in ENTITIES}


def silver(spark: SparkSession, sf_dir: str, *batches: int) -> dict[str, DataFrame]:
    """All three states. With the guard, batches in any order end in the newest change per key."""
    return {e.name: newest(spark, sf_dir, e, *batches) for e in ENTITIES}


def write_landing(spark: SparkSession, sf_dir: str, landing: str, *batches: int, fmt: str = "csv") -> None:
    """The feeds as landing files, one directory per batch and entity. CSV is compressed; as a reader cannot divide
    such files, none holds more than FILE_ROWS rows."""
    prepare(spark)

    def write(spec: EntitySpec, batch: int) -> None:
        rows = feed(spark, sf_dir, spec, batch).select(*spec.file_columns)
        options = {"header": "true", "escape": '"'} if fmt == "csv" else dict(K.STORED)
        if fmt == "csv":
            options |= {"compression": "gzip", "zlib.compress.level": "FOUR", "maxRecordsPerFile": str(FILE_ROWS)}
        rows.write.format(fmt).options(**options).save(f"{landing}/{PREFIXES[batch]}/{spec.name}")

    targets = [(spec, batch) for spec in ENTITIES for batch in batches]
    with ThreadPoolExecutor(len(targets)) as pool:
        for done in [pool.submit(write, *target) for target in targets]:
            done.result()
