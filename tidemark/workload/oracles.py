"""For each registered query, the same question as SQL over the given tables.

The feeds are restated below as common table expressions; a query text is the expressions it needs
plus its own select. Money is shown as DOUBLE and sequences as VARCHAR, as the queries show them.
"""

from __future__ import annotations

FEEDS = """
booking_base AS (
  SELECT o.*, c.c_nationkey, c.c_mktsegment,
    CASE o_orderstatus WHEN 'P' THEN 'PENDING' WHEN 'O' THEN 'CONFIRMED' WHEN 'F' THEN 'CANCELLED'
      ELSE o_orderstatus END AS status,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.004 AS DECIMAL(4,3)) AS DECIMAL(12,2)) AS price
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
booking_log AS (
  SELECT b.*, 0 AS batch, 1 AS pos, 'L' AS op, status AS new_status, CAST(1.00 AS DECIMAL(3,2)) AS factor
  FROM booking_base b WHERE o_orderpriority <> '5-LOW'
  UNION ALL
  SELECT b.*, 2, 2, 'U', 'PENDING', 0.90 FROM booking_base b
  WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P'
  UNION ALL
  SELECT b.*, 1, 3, 'I', status, 1.00 FROM booking_base b WHERE o_orderpriority = '5-LOW'
  UNION ALL
  SELECT b.*, 1, 4, 'U', 'CONFIRMED', 1.10 FROM booking_base b WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT b.*, 1, 5, 'U', 'CANCELLED', 1.00 FROM booking_base b
  WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'
  UNION ALL
  SELECT b.*, 1, 6, 'D', status, 1.00 FROM booking_base b
  WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O'
),
booking_feed AS (
  SELECT batch,
    'BK' || o_orderkey AS BOOKING_ID, 'PX' || o_custkey AS PASSENGER_ID, 'FL' || c_nationkey AS FLIGHT_NUMBER,
    'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS ORIGIN, upper(substr(c_mktsegment, 1, 3)) AS DESTINATION,
    o_orderdate AS BOOKING_TS, new_status AS BOOKING_STATUS,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'n/a'
      ELSE CAST(CAST(price * factor AS DECIMAL(12,2)) AS VARCHAR) END AS FARE_TEXT,
    CASE WHEN o_orderstatus <> 'O' THEN 'EUR' ELSE 'USD' END AS CURRENCY,
    o_orderpriority AS CHANNEL, op, op = 'D' AS IS_DELETED,
    CAST(pos AS BIGINT) * 1000000000000 + o_orderkey AS seq,
    o_orderdate + pos * INTERVAL 1 HOUR AS UPDATED_AT
  FROM booking_log
),
booking_typed AS (
  SELECT batch, BOOKING_ID, PASSENGER_ID, FLIGHT_NUMBER, ORIGIN, DESTINATION, BOOKING_TS, BOOKING_STATUS,
    TRY_CAST(FARE_TEXT AS DECIMAL(12,2)) AS FARE_AMOUNT, CURRENCY, CHANNEL, IS_DELETED, seq, UPDATED_AT
  FROM booking_feed
),
line AS (
  SELECT *, CASE WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN 0 ELSE 1 END AS batch,
    CAST(CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS VARCHAR)
      || lpad(CAST(l_partkey AS VARCHAR), 12, '0') || lpad(CAST(l_suppkey AS VARCHAR), 12, '0')
      AS DECIMAL(38,0)) AS seq
  FROM lineitem
),
claim_typed AS (
  SELECT batch, 'CL' || l_orderkey || '-' || l_linenumber AS CLAIM_ID, 'BK' || l_orderkey AS BOOKING_ID,
    CASE l_linestatus WHEN 'O' THEN 'BAGGAGE' WHEN 'F' THEN 'DELAY' ELSE l_linestatus END AS CLAIM_TYPE,
    CASE l_returnflag WHEN 'R' THEN 'OPEN' WHEN 'A' THEN 'SETTLED' WHEN 'N' THEN 'REJECTED'
      ELSE l_returnflag END AS CLAIM_STATUS,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(12,2)) AS CLAIM_AMOUNT,
    l_shipdate AS FILED_TS, CASE WHEN l_returnflag = 'A' THEN l_shipdate END AS SETTLED_TS,
    batch = 1 AND l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity >= 25 AS IS_DELETED,
    seq, l_shipdate AS UPDATED_AT
  FROM line
),
reservation_typed AS (
  SELECT batch, 'RS' || l_orderkey || '-' || l_linestatus AS RESERVATION_ID, 'BK' || l_orderkey AS BOOKING_ID,
    l_linenumber || l_returnflag AS SEAT_NUMBER,
    CASE l_returnflag WHEN 'A' THEN 'FIRST' WHEN 'N' THEN 'ECONOMY' WHEN 'R' THEN 'BUSINESS'
      ELSE l_returnflag END AS CABIN_CLASS,
    CASE l_returnflag WHEN 'A' THEN 'ACTIVE' WHEN 'N' THEN 'HELD' WHEN 'R' THEN 'ACTIVE'
      ELSE l_returnflag END AS RESERVATION_STATUS,
    l_discount >= 0.05 AS CHECKED_IN, batch = 1 AND l_quantity > 45 AS IS_DELETED,
    seq * 10 + l_linenumber AS seq, l_shipdate AS UPDATED_AT
  FROM line
)"""

COLUMNS = {
    "booking": (
        "BOOKING_ID, PASSENGER_ID, FLIGHT_NUMBER, ORIGIN, DESTINATION, BOOKING_TS, BOOKING_STATUS, "
        "FARE_AMOUNT, CURRENCY, CHANNEL, IS_DELETED, seq, UPDATED_AT"
    ),
    "reservation": (
        "RESERVATION_ID, BOOKING_ID, SEAT_NUMBER, CABIN_CLASS, RESERVATION_STATUS, CHECKED_IN, "
        "IS_DELETED, seq, UPDATED_AT"
    ),
    "claim": (
        "CLAIM_ID, BOOKING_ID, CLAIM_TYPE, CLAIM_STATUS, CLAIM_AMOUNT, FILED_TS, SETTLED_TS, "
        "IS_DELETED, seq, UPDATED_AT"
    ),
}
KEYS = {"booking": "BOOKING_ID", "reservation": "RESERVATION_ID", "claim": "CLAIM_ID"}
# Order of the remaining columns where two changes carry the same sequence.
TIES = {
    "booking": (
        "IS_DELETED, PASSENGER_ID, FLIGHT_NUMBER, ORIGIN, DESTINATION, BOOKING_TS, BOOKING_STATUS, "
        "FARE_AMOUNT, CURRENCY, CHANNEL"
    ),
    "reservation": "IS_DELETED, BOOKING_ID, SEAT_NUMBER, CABIN_CLASS, RESERVATION_STATUS, CHECKED_IN",
    "claim": "IS_DELETED, BOOKING_ID, CLAIM_TYPE, CLAIM_STATUS, CLAIM_AMOUNT, FILED_TS, SETTLED_TS",
}


def _down(columns: str) -> str:
    return ", ".join(f"{c.strip()} DESC NULLS LAST" for c in columns.split(","))


def state(name: str, entity: str, batches: str = "0, 1", first: str = "") -> str:
    """CTE `name`: newest change per key of an entity over some batches. `first` ranks before the sequence."""
    order = f"{first}seq DESC NULLS FIRST, UPDATED_AT DESC NULLS LAST, {_down(TIES[entity])}"
    return f"""
{name} AS (
  SELECT {COLUMNS[entity]} FROM {entity}_typed WHERE batch IN ({batches})
  QUALIFY row_number() OVER (PARTITION BY {KEYS[entity]} ORDER BY {order}) = 1
)"""


def states(batches: str = "0, 1", prefix: str = "") -> str:
    return ",".join(state(f"{prefix}{e}", e, batches) for e in KEYS)


def rollup(name: str, claims: str) -> str:
    return f"""
{name} AS (
  SELECT BOOKING_ID, count(*) AS CLAIM_COUNT, sum(CLAIM_AMOUNT) AS CLAIM_AMOUNT,
    sum(CASE WHEN CLAIM_STATUS = 'SETTLED' THEN CLAIM_AMOUNT ELSE 0 END) AS SETTLED_AMOUNT,
    count(*) FILTER (WHERE CLAIM_STATUS = 'OPEN') AS OPEN_CLAIMS
  FROM {claims} WHERE NOT IS_DELETED GROUP BY BOOKING_ID
)"""


def fact(name: str = "fact", prefix: str = "") -> str:
    """CTEs ending in `name`: one row per live booking of the given states."""
    return (
        rollup(f"{prefix}rolled", f"{prefix}claim")
        + f""",
{prefix}seat AS (
  SELECT BOOKING_ID, CABIN_CLASS, CHECKED_IN FROM {prefix}reservation WHERE NOT IS_DELETED
  QUALIFY row_number() OVER (PARTITION BY BOOKING_ID ORDER BY seq DESC, RESERVATION_ID DESC) = 1
),
{name} AS (
  SELECT b.BOOKING_ID, b.PASSENGER_ID, b.FLIGHT_NUMBER, b.ORIGIN || '-' || b.DESTINATION AS ROUTE,
    CAST(b.BOOKING_TS AS DATE) AS BOOKING_DATE, b.BOOKING_STATUS, b.CHANNEL, s.CABIN_CLASS,
    coalesce(s.CHECKED_IN, FALSE) AS CHECKED_IN, b.FARE_AMOUNT,
    coalesce(r.CLAIM_COUNT, 0) AS CLAIM_COUNT,
    CAST(coalesce(r.CLAIM_AMOUNT, 0) AS DECIMAL(24,2)) AS CLAIM_AMOUNT,
    CAST(b.FARE_AMOUNT - coalesce(r.SETTLED_AMOUNT, 0) AS DECIMAL(24,2)) AS NET_REVENUE,
    CASE WHEN b.FARE_AMOUNT >= 1200 THEN 'HIGH' WHEN b.FARE_AMOUNT >= 900 THEN 'MEDIUM' ELSE 'LOW' END
      AS REVENUE_BAND,
    coalesce(r.OPEN_CLAIMS, 0) > 0 OR NOT coalesce(s.CHECKED_IN, FALSE) AS IS_AT_RISK,
    b.UPDATED_AT AS LOAD_TS
  FROM {prefix}booking b
  LEFT JOIN {prefix}seat s ON s.BOOKING_ID = b.BOOKING_ID
  LEFT JOIN {prefix}rolled r ON r.BOOKING_ID = b.BOOKING_ID
  WHERE NOT b.IS_DELETED AND b.BOOKING_STATUS <> 'CANCELLED'
)"""
    )


MONEY = {"FARE_AMOUNT", "CLAIM_AMOUNT", "NET_REVENUE", "GROSS_REVENUE", "CLAIM_EXPOSURE"}
FACT = (
    "BOOKING_ID, PASSENGER_ID, FLIGHT_NUMBER, ROUTE, BOOKING_DATE, BOOKING_STATUS, CHANNEL, CABIN_CLASS, "
    "CHECKED_IN, FARE_AMOUNT, CLAIM_COUNT, CLAIM_AMOUNT, NET_REVENUE, REVENUE_BAND, IS_AT_RISK, LOAD_TS"
)


def shown(columns: str, without: tuple[str, ...] = ()) -> str:
    def one(c: str) -> str:
        if c in MONEY:
            return f"CAST({c} AS DOUBLE) AS {c}"
        return "CAST(seq AS VARCHAR) AS CHANGE_SEQ" if c == "seq" else c

    return ", ".join(one(c.strip()) for c in columns.split(",") if c.strip() not in without)


def query(select: str, *ctes: str) -> str:
    return "WITH " + ",".join([FEEDS, *ctes]) + "\n" + select


DAILY = """
daily AS (
  SELECT BOOKING_DATE, ROUTE, CHANNEL, count(*) AS BOOKINGS, CAST(sum(FARE_AMOUNT) AS DOUBLE) AS GROSS_REVENUE,
    CAST(sum(NET_REVENUE) AS DOUBLE) AS NET_REVENUE, CAST(sum(CLAIM_AMOUNT) AS DOUBLE) AS CLAIM_EXPOSURE,
    count(*) FILTER (WHERE IS_AT_RISK) AS AT_RISK_BOOKINGS
  FROM fact GROUP BY BOOKING_DATE, ROUTE, CHANNEL
)"""
# half-up to two decimals in whole numbers
SUMMARY = "SELECT *, ((AT_RISK_BOOKINGS * 20000 + BOOKINGS) // (2 * BOOKINGS)) / 100.0 AS AT_RISK_PCT FROM daily"


def change_ctes(entity: str) -> str:
    """CTE `<entity>_diff`: keys the delta changes, with the row before and after."""
    key = KEYS[entity]
    return (
        state(f"{entity}_old", entity, "0")
        + ","
        + state(f"{entity}_new", entity, "1")
        + f""",
{entity}_diff AS (
  SELECT n.*, o.{key} AS old_key, o.BOOKING_ID AS old_booking
  FROM {entity}_new n LEFT JOIN {entity}_old o ON o.{key} = n.{key}
  WHERE o.{key} IS NULL OR o.seq IS NULL OR n.seq > o.seq
)"""
    )


def dq_line(name: str, target: str, count: str, severity: str = "FAIL") -> str:
    return (
        f"SELECT TIMESTAMP '2001-11-04 03:00:30' AS RUN_TS, '{name}' AS TEST_NAME, '{target}' AS TARGET, "
        f"CAST(n AS BIGINT) AS FAIL_COUNT, CASE WHEN n = 0 THEN 'PASS' ELSE '{severity}' END AS STATUS "
        f"FROM (SELECT count(*) AS n FROM ({count}) v) t"
    )


def both(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


def repeated(table: str, key: str) -> str:
    return f"SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1"


DEAD = "s.IS_DELETED OR s.BOOKING_STATUS = 'CANCELLED'"
GOLD = "GOLD.BOOKING_FACT"


def orphans(parent: str, claim: str = "claim") -> str:
    return (
        f"SELECT c.CLAIM_ID FROM {claim} c LEFT JOIN {parent} b ON b.BOOKING_ID = c.BOOKING_ID "
        "WHERE b.BOOKING_ID IS NULL AND NOT c.IS_DELETED"
    )


def dead_in(table: str, booking: str = "booking") -> str:
    return f"SELECT g.BOOKING_ID FROM {table} g JOIN {booking} s ON s.BOOKING_ID = g.BOOKING_ID WHERE {DEAD}"


def upsert_sql(entity: str) -> str:
    """Batch by batch: the newest change of the delta replaces the stored row if it is newer."""
    key = KEYS[entity]
    columns = COLUMNS[entity]
    pick = ", ".join(
        f"CASE WHEN n.{key} IS NOT NULL AND (o.{key} IS NULL OR n.seq > o.seq) THEN n.{c} ELSE o.{c} END AS {c}"
        for c in (c.strip() for c in columns.split(","))
    )
    merged = f"merged AS (SELECT {pick} FROM {entity}_old o FULL JOIN {entity}_new n ON o.{key} = n.{key})"
    return query(
        f"SELECT {shown(columns)} FROM merged",
        state(f"{entity}_old", entity, "0"),
        state(f"{entity}_new", entity, "1"),
        "\n" + merged,
    )


EVENTS = """
WITH changes AS (
  SELECT CAST(ts AS DATE) AS DAY, user_id AS USER_ID, event_id AS EVENT_ID, event_type AS EVENT_TYPE,
    value AS VALUE, event_type = 'error' AS IS_DELETED FROM events
)
SELECT * FROM changes
"""


def counts(pairs: dict[str, str]) -> str:
    return both(*[f"SELECT '{t}' AS TBL, count(*) AS N FROM {source}" for t, source in pairs.items()])


def version_summary(version: int, table: str) -> str:
    return (
        f"SELECT {version} AS VERSION, CLAIM_STATUS, IS_DELETED, count(*) AS N, "
        f"CAST(sum(CLAIM_AMOUNT) AS DOUBLE) AS AMOUNT FROM {table} GROUP BY CLAIM_STATUS, IS_DELETED"
    )


def freshness_line(obj: str, table: str, column: str) -> str:
    run = "TIMESTAMP '2001-11-04 03:00:30'"
    return (
        f"SELECT '{obj}' AS OBJ, LAST_UPDATE, date_diff('minute', LAST_UPDATE, {run}) AS LAG_MIN, "
        f"CASE WHEN LAST_UPDATE >= {run} - INTERVAL 2 HOUR THEN 'PASS' "
        f"WHEN LAST_UPDATE >= {run} - INTERVAL 6 HOUR THEN 'WARN' ELSE 'ERROR' END AS STATUS "
        f"FROM (SELECT max({column}) AS LAST_UPDATE FROM {table}) m"
    )


def audit(entity: str, feed: str, unparsable: str) -> str:
    prefix = "CASE batch WHEN 0 THEN 'fullload' WHEN 1 THEN 'cdc' ELSE 'late' END"
    return (
        f"SELECT {prefix} || '/{entity}.csv' AS SRC_FILE, '{entity}' AS ENTITY, count(*) AS ROWS_READ, "
        f"CAST(0 AS BIGINT) AS ROWS_REJECTED, CAST({unparsable} AS BIGINT) AS FIELDS_UNPARSABLE "
        f"FROM {feed} GROUP BY batch"
    )


def line_ops(entity: str) -> str:
    return (
        "SELECT CASE WHEN batch = 0 THEN 'L' WHEN IS_DELETED THEN 'D' ELSE 'U' END AS CHANGE_OPER, "
        f"count(*) AS N, '{entity}' AS ENTITY FROM {entity}_typed GROUP BY 1"
    )


def merge_line(entity: str) -> str:
    return (
        f"SELECT count(*) FILTER (WHERE old_key IS NULL) AS INSERTED, "
        f"count(*) FILTER (WHERE old_key IS NOT NULL) AS UPDATED, CAST(0 AS BIGINT) AS DELETED, "
        f"'{entity}' AS ENTITY FROM {entity}_diff"
    )


def keys_of(entity: str) -> str:
    return f"SELECT BOOKING_ID FROM {entity}_diff UNION SELECT old_booking FROM {entity}_diff"


def silver_changes_sql() -> str:
    columns = COLUMNS["booking"]
    old = ", ".join(f"o.{c.strip()}" for c in columns.split(","))
    select = both(
        f"SELECT CASE WHEN old_key IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type, "
        f"{shown(columns)} FROM booking_diff",
        f"SELECT 'update_preimage' AS _change_type, {shown(columns)} FROM "
        f"(SELECT {old} FROM booking_old o JOIN booking_diff d ON d.old_key = o.BOOKING_ID) p",
    )
    return query(select, change_ctes("booking"))


def stored_changes_sql() -> str:
    """Images of the delta and of a late batch that overwrites what it finds, as versions 2 and 3."""
    columns = COLUMNS["booking"]
    without = ("UPDATED_AT",)
    cut = shown(columns, without)
    old = ", ".join(f"o.{c.strip()}" for c in columns.split(","))
    parts = []
    for version, diff, before in ((2, "booking_diff", "booking_old"), (3, "late_diff", "booking_mid")):
        parts.append(f"SELECT CASE WHEN old_key IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type, CAST({version} AS BIGINT) AS _version, {cut} FROM {diff}")
        parts.append(f"SELECT 'update_preimage', CAST({version} AS BIGINT), {cut} FROM (SELECT {old} FROM {before} o JOIN {diff} d ON d.old_key = o.BOOKING_ID) p")
    return query(
        both(*parts), state("booking_old", "booking", "0"), state("booking_new", "booking", "1"), state("late_new", "booking", "2"),
        """
booking_mid AS (SELECT * FROM booking_new UNION ALL SELECT * FROM booking_old WHERE BOOKING_ID NOT IN (SELECT BOOKING_ID FROM booking_new)),
booking_diff AS (SELECT n.*, o.BOOKING_ID AS old_key FROM booking_new n LEFT JOIN booking_old o ON o.BOOKING_ID = n.BOOKING_ID),
late_diff AS (SELECT n.*, o.BOOKING_ID AS old_key FROM late_new n LEFT JOIN booking_mid o ON o.BOOKING_ID = n.BOOKING_ID)""",
    )


def net_changes_sql() -> str:
    return query(
        "SELECT n.BOOKING_ID, CASE WHEN o.BOOKING_ID IS NULL THEN 'insert' ELSE 'update' END AS _change_type, "
        "n.BOOKING_STATUS, CAST(n.FARE_AMOUNT AS DOUBLE) AS FARE_AMOUNT, CAST(n.seq AS VARCHAR) AS CHANGE_SEQ, "
        "o.BOOKING_STATUS AS OLD_STATUS, CAST(o.FARE_AMOUNT AS DOUBLE) AS OLD_FARE "
        "FROM newer n LEFT JOIN older o ON o.BOOKING_ID = n.BOOKING_ID",
        state("older", "booking", "0"),
        state("newer", "booking", "1, 2", first="batch DESC, "),
    )


def out_of_order_sql() -> str:
    return query(
        "SELECT g.BOOKING_ID, g.BOOKING_STATUS AS GUARDED_STATUS, CAST(g.FARE_AMOUNT AS DOUBLE) AS GUARDED_FARE, "
        "CAST(g.seq AS VARCHAR) AS GUARDED_SEQ, d.BOOKING_STATUS AS DELIVERED_STATUS, "
        "CAST(d.FARE_AMOUNT AS DOUBLE) AS DELIVERED_FARE, CAST(d.seq AS VARCHAR) AS DELIVERED_SEQ "
        "FROM guarded g JOIN delivered d ON d.BOOKING_ID = g.BOOKING_ID",
        state("guarded", "booking", "0, 1, 2"),
        state("delivered", "booking", "0, 1, 2", first="batch DESC, "),
    )


def incremental_sql() -> str:
    """Old fact rows of bookings without a booking change, new ones of the others, without dead bookings."""
    diff = "booking_diff AS (SELECT DISTINCT BOOKING_ID FROM booking_typed WHERE batch = 1)"
    select = f"""
SELECT {shown(FACT, without=("LOAD_TS",))} FROM (
  SELECT * FROM old_fact WHERE BOOKING_ID NOT IN (SELECT BOOKING_ID FROM booking_diff)
  UNION ALL
  SELECT * FROM fact WHERE BOOKING_ID IN (SELECT BOOKING_ID FROM booking_diff)
  UNION ALL
  SELECT f.* FROM old_fact f JOIN booking s ON s.BOOKING_ID = f.BOOKING_ID
  WHERE f.BOOKING_ID IN (SELECT BOOKING_ID FROM booking_diff)
    AND f.BOOKING_ID NOT IN (SELECT BOOKING_ID FROM fact) AND NOT ({DEAD})
) m"""
    return query(select, states(), fact(), states("0", "old_"), fact("old_fact", "old_"), "\n" + diff)


def _fact_select(columns: str = FACT, **kw) -> str:
    return query(f"SELECT {shown(columns, **kw)} FROM fact", states(), fact())


def gold_suite() -> str:
    return query(
        both(
            dq_line("not_null_booking_id", GOLD, "SELECT 1 FROM fact WHERE BOOKING_ID IS NULL"),
            dq_line("unique_booking_id", GOLD, repeated("fact", "BOOKING_ID")),
            dq_line("not_null_fare_amount", GOLD, "SELECT 1 FROM fact WHERE FARE_AMOUNT IS NULL"),
            dq_line(
                "accepted_revenue_band", GOLD,
                "SELECT 1 FROM fact WHERE REVENUE_BAND NOT IN ('HIGH', 'MEDIUM', 'LOW')",
            ),
            dq_line(
                "accepted_booking_status", GOLD,
                "SELECT 1 FROM fact WHERE BOOKING_STATUS NOT IN ('CONFIRMED', 'PENDING')",
            ),
            dq_line("not_null_bookings", "GOLD.DAILY_ROUTE_SUMMARY", "SELECT 1 FROM daily WHERE BOOKINGS IS NULL"),
        ),
        states(), fact(), DAILY,
    )


ACCEPTED = "BOOKING_STATUS NOT IN ('CONFIRMED', 'PENDING', 'CANCELLED')"
NEGATIVE = dq_line("net_revenue_not_negative", GOLD, "SELECT 1 FROM fact WHERE NET_REVENUE < 0", "WARN")


def pipeline_rules(prefix: str = "", table: str = "fact") -> str:
    """The six rules over the states and the fact of one moment."""
    booking = f"{prefix}booking"
    return both(
        dq_line("unique_booking_id", "SILVER.BOOKING", repeated(booking, "BOOKING_ID")),
        dq_line("not_null_booking_id", "SILVER.BOOKING", f"SELECT 1 FROM {booking} WHERE BOOKING_ID IS NULL"),
        dq_line("accepted_booking_status", "SILVER.BOOKING", f"SELECT 1 FROM {booking} WHERE {ACCEPTED}"),
        dq_line("fk_claim_to_booking", "SILVER.CLAIM", orphans(booking, f"{prefix}claim")),
        dq_line("net_revenue_not_negative", GOLD, f"SELECT 1 FROM {table} WHERE NET_REVENUE < 0", "WARN"),
        dq_line("gold_excludes_cancelled", GOLD, dead_in(table, booking)),
    )


def rejects_sql() -> str:
    bad = "BOOKING_STATUS = 'PENDING' AND CHANNEL IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
    reason = "CASE CHANNEL WHEN '1-URGENT' THEN 'unusable sequence' WHEN '2-HIGH' THEN 'ORIGIN too long' ELSE 'missing key' END"
    audited = {
        "ROWS_READ": "count(*)",
        "ROWS_REJECTED": f"count(*) FILTER (WHERE {bad})",
        "FIELDS_UNPARSABLE": "count(*) FILTER (WHERE FARE_TEXT = 'n/a')",
    }
    return query(
        both(
            *[f"SELECT '{p}' AS PART, 'fullload/booking' AS NAME, CAST({n} AS BIGINT) AS N FROM landed" for p, n in audited.items()],
            f"SELECT 'REASON', {reason}, count(*) FROM landed WHERE {bad} GROUP BY 2",
            f"SELECT 'CURRENCY', CURRENCY, count(*) FROM landed WHERE NOT ({bad}) GROUP BY 2",
        ),
        "\nlanded AS (SELECT * FROM booking_feed WHERE batch = 0)",
    )


def undelete_sql() -> str:
    changed = {"seq": "CAST(CASE WHEN IS_DELETED THEN seq + 10000000000000 ELSE seq END AS VARCHAR) AS CHANGE_SEQ", "IS_DELETED": "FALSE AS IS_DELETED"}
    columns = ", ".join(changed.get(c.strip(), shown(c)) for c in COLUMNS["booking"].split(","))
    return query(f"SELECT {columns} FROM booking", state("booking", "booking"))


def offsets_sql() -> str:
    lines = []
    for after in (0, 1):
        if after == 0:
            lines.append("SELECT 0 AS AFTER, CAST(1 AS BIGINT) AS _version, 'insert' AS _change_type, count(*) AS N FROM booking_old")
        for kind, when in (("insert", "IS NULL"), ("update_preimage", "IS NOT NULL"), ("update_postimage", "IS NOT NULL")):
            lines.append(f"SELECT {after}, 2, '{kind}', count(*) FROM booking_diff WHERE old_key {when}")
    return query(f"SELECT * FROM ({both(*lines)}) v WHERE N > 0", change_ctes("booking"))


def run_log_sql() -> str:
    keys = " UNION ".join(keys_of(e) for e in KEYS)
    refreshed = f"SELECT count(*) FROM fact WHERE BOOKING_ID IN ({keys})"

    def line(step: str, target: str, runs: int, rows: str) -> str:
        return (
            f"SELECT '{step}' AS STEP, '{target}' AS TARGET, {runs} AS RUNS, CAST({rows} AS BIGINT) AS ROWS_AFFECTED, "
            "TIMESTAMP '2001-11-04 03:00:30' AS LAST_TS"
        )

    merged = "(SELECT count(*) FROM {0}_old) + (SELECT count(*) FROM {0}_diff)"
    return query(
        both(
            *[line("RAW->SILVER", f"SILVER.{e.upper()}", 2, merged.format(e)) for e in KEYS],
            line("SILVER->GOLD", GOLD, 2, f"(SELECT count(*) FROM old_fact) + ({refreshed})"),
            line("GOLD->OUTBOUND", "booking_fact", 1, "(SELECT count(*) FROM fact)"),
        ),
        states(), fact(), states("0", "old_"), fact("old_fact", "old_"), *[change_ctes(e) for e in KEYS],
    )


INSPECTION = (
    "SELECT f.REVENUE_BAND, r.CABIN_CLASS, count(*) AS CLAIMS FROM fact f "
    "JOIN claim c ON c.BOOKING_ID = f.BOOKING_ID LEFT JOIN (SELECT * FROM reservation WHERE NOT IS_DELETED) r "
    "ON r.BOOKING_ID = f.BOOKING_ID WHERE NOT c.IS_DELETED AND c.CLAIM_STATUS = 'OPEN' AND f.CHANNEL = '1-URGENT' "
    "AND f.REVENUE_BAND <> 'LOW' GROUP BY ALL"
)
STATUS_TOTALS = (
    "SELECT '{0}' AS STAGE, BOOKING_STATUS, IS_DELETED, count(*) AS N, CAST(sum(FARE_AMOUNT) AS DOUBLE) AS FARE "
    "FROM {1} GROUP BY BOOKING_STATUS, IS_DELETED"
)


RELATIONSHIPS = (
    ("order_has_customer", "orders", "o_custkey", "customer", "c_custkey", "FAIL"),
    ("line_has_order", "lineitem", "l_orderkey", "orders", "o_orderkey", "FAIL"),
    ("line_has_part", "lineitem", "l_partkey", "part", "p_partkey", "FAIL"),
    ("line_has_supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey", "FAIL"),
    ("nation_has_region", "nation", "n_regionkey", "region", "r_regionkey", "FAIL"),
    ("customer_has_order", "customer", "c_custkey", "orders", "o_custkey", "WARN"),
    ("part_number_is_an_order", "part", "p_partkey", "orders", "o_orderkey", "FAIL"),
)


def landed(entity: str) -> str:
    """The changes of a feed with the folder they land in."""
    op = "op" if entity == "booking" else "CASE WHEN batch = 0 THEN 'L' WHEN IS_DELETED THEN 'D' ELSE 'U' END"
    feed = "booking_feed" if entity == "booking" else f"{entity}_typed"
    return f"SELECT '{entity}' AS entity, batch, CASE batch WHEN 0 THEN 'fullload' WHEN 1 THEN 'cdc' ELSE 'late' END AS folder, {op} AS op FROM {feed}"


def oracles() -> dict[str, str]:
    booking = COLUMNS["booking"]
    return {
        "cdc_latest": query(f"SELECT {shown(booking)} FROM newest", state("newest", "booking", "0, 1, 2")),
        "cdc_upsert": upsert_sql("booking"),
        "cdc_upsert_reservation": upsert_sql("reservation"),
        "cdc_upsert_claim": upsert_sql("claim"),
        "cdc_full_then_delta": query(
            both(STATUS_TOTALS.format("full", "f"), STATUS_TOTALS.format("delta", "d")),
            state("f", "booking", "0"), state("d", "booking"),
        ),
        "cdc_soft_delete": query(f"SELECT {shown(booking)} FROM s WHERE IS_DELETED", state("s", "booking")),
        "cdc_out_of_order": out_of_order_sql(),
        "cdc_events_by_day": EVENTS
        + "QUALIFY row_number() OVER (PARTITION BY DAY, USER_ID ORDER BY EVENT_ID DESC NULLS FIRST) = 1",
        "cdc_events_state": EVENTS
        + "QUALIFY row_number() OVER (PARTITION BY USER_ID ORDER BY EVENT_ID DESC NULLS FIRST) = 1",
        "silver_changes": silver_changes_sql(),
        "silver_net_changes": net_changes_sql(),
        "changed_keys": query(
            "SELECT DISTINCT BOOKING_ID FROM ("
            + " UNION ".join(keys_of(e) for e in KEYS)
            + ") k WHERE BOOKING_ID IS NOT NULL",
            *[change_ctes(e) for e in KEYS],
        ),
        "merge_counts": query(both(*[merge_line(e) for e in KEYS]), *[change_ctes(e) for e in KEYS]),
        "committed_counts": query(both(*[merge_line(e) for e in KEYS]), *[change_ctes(e) for e in KEYS]),
        "change_op_counts": query(
            both(
                "SELECT op AS CHANGE_OPER, count(*) AS N, 'booking' AS ENTITY FROM booking_feed GROUP BY op",
                line_ops("reservation"),
                line_ops("claim"),
            )
        ),
        "table_counts": query(
            counts(
                {f"RAW.{e.upper()}": f"{e}_typed" for e in KEYS} | {f"SILVER.{e.upper()}": e for e in KEYS}
            ),
            states(),
        ),
        "claim_rollup": query(
            "SELECT BOOKING_ID, CLAIM_COUNT, CAST(CLAIM_AMOUNT AS DOUBLE) AS CLAIM_AMOUNT, "
            "CAST(SETTLED_AMOUNT AS DOUBLE) AS SETTLED_AMOUNT, OPEN_CLAIMS FROM rolled",
            state("claim", "claim"), rollup("rolled", "claim"),
        ),
        "gold_rebuild": _fact_select(),
        "gold_incremental": incremental_sql(),
        "gold_incremental_all": _fact_select(without=("LOAD_TS",)),
        "daily_route": query("SELECT * FROM daily", states(), fact(), DAILY),
        "daily_route_summary": query(SUMMARY, states(), fact(), DAILY),
        "daily_route_maintained": query(SUMMARY, states(), fact(), DAILY),
        "silver_changes_stored": stored_changes_sql(),
        "load_audit": query(
            both(
                audit("booking", "booking_feed", "count(*) FILTER (WHERE TRY_CAST(FARE_TEXT AS DECIMAL(12,2)) IS NULL)"),
                audit("reservation", "reservation_typed", "0"),
                audit("claim", "claim_typed", "0"),
            )
        ),
        "freshness": query(
            both(
                *[freshness_line(f"SILVER.{e.upper()}", e, "UPDATED_AT") for e in KEYS],
                freshness_line(GOLD, "fact", "LOAD_TS"),
            ),
            states(), fact(),
        ),
        "dq_unique": query(
            both(
                dq_line("unique_booking_id", "SILVER.BOOKING", repeated("booking", "BOOKING_ID")),
                dq_line("unique_booking_id", "RAW.BOOKING", repeated("booking_feed", "BOOKING_ID")),
                dq_line("unique_claim_id", "RAW.CLAIM", repeated("claim_typed", "CLAIM_ID")),
            ),
            states(),
        ),
        "dq_not_null": query(
            both(
                *[
                    dq_line(f"not_null_{c.lower()}", "SILVER.BOOKING", f"SELECT 1 FROM booking WHERE {c} IS NULL")
                    for c in ("BOOKING_ID", "FARE_AMOUNT", "BOOKING_TS")
                ]
            ),
            states(),
        ),
        "dq_accepted": query(
            both(
                dq_line("accepted_booking_status", "SILVER.BOOKING", f"SELECT 1 FROM booking WHERE {ACCEPTED}"),
                dq_line(
                    "live_booking_status", "SILVER.BOOKING",
                    "SELECT 1 FROM booking WHERE BOOKING_STATUS NOT IN ('CONFIRMED', 'PENDING')",
                ),
                dq_line(
                    "open_or_settled_claim", "SILVER.CLAIM",
                    "SELECT 1 FROM claim WHERE CLAIM_STATUS NOT IN ('OPEN', 'SETTLED')",
                ),
            ),
            states(),
        ),
        "dq_fk": query(
            both(
                dq_line("fk_claim_to_booking", "SILVER.CLAIM", orphans("booking")),
                dq_line("fk_claim_to_full_load", "SILVER.CLAIM", orphans("full_booking")),
            ),
            states(), state("full_booking", "booking", "0"),
        ),
        "dq_net_revenue": query(NEGATIVE, states(), fact()),
        "dq_gold_excludes_cancelled": query(
            both(
                dq_line("gold_excludes_cancelled", GOLD, dead_in("fact")),
                dq_line("gold_excludes_cancelled", "STALE.BOOKING_FACT", dead_in("old_fact")),
            ),
            states(), fact(), states("0", "old_"), fact("old_fact", "old_"),
        ),
        "dq_gold_suite": gold_suite(),
        "dq_results": query(pipeline_rules(), states(), fact()),
        "stream_ingest": query(
            f"SELECT {shown(booking, without=('UPDATED_AT',))} FROM newest", state("newest", "booking", "0, 1, 2")
        ),
        "stream_to_gold": _fact_select(without=("LOAD_TS",)),
        "replay": query(SUMMARY, states(), fact(), DAILY),
        "raw_empty_after_load": query(
            counts(
                {f"RAW.{e.upper()}": f"{e}_typed WHERE FALSE" for e in KEYS}
                | {f"SILVER.{e.upper()}": e for e in KEYS}
            ),
            states("0"),
        ),
        "unload_roundtrip": _fact_select(without=("LOAD_TS",)),
        "unload_partitioned": query(
            "SELECT BOOKING_DATE AS DT, count(*) AS N, CAST(sum(NET_REVENUE) AS DOUBLE) AS NET_REVENUE "
            "FROM fact GROUP BY BOOKING_DATE",
            states(), fact(),
        ),
        "time_travel": query(
            both(version_summary(1, "v1"), version_summary(2, "v2"), version_summary(3, "v1")),
            state("v1", "claim", "0"), state("v2", "claim"),
        ),
        "landed_rejects": rejects_sql(),
        "cdc_undelete": undelete_sql(),
        "consumer_offsets": offsets_sql(),
        "run_log": run_log_sql(),
        "dq_history": query(
            both(pipeline_rules("old_", "old_fact"), pipeline_rules()),
            states(), fact(), states("0", "old_"), fact("old_fact", "old_"),
        ),
        "stored_rebuild": query(SUMMARY, states(), fact(), DAILY),
        "export_top": _fact_select(without=("LOAD_TS",)) + " ORDER BY fact.FARE_AMOUNT DESC NULLS LAST, BOOKING_ID LIMIT 100",
        "inspection": query(INSPECTION, states(), fact()),
        "landed_by_path": query(
            f"SELECT folder || '/' || entity AS FOLDER, op AS CHANGE_OPER, count(*) AS N, CASE batch WHEN 0 THEN 'parquet' ELSE 'csv' END AS FORMAT "
            f"FROM ({both(*[landed(e) for e in KEYS])}) v GROUP BY ALL"
        ),
        "unloaded_files": query(
            f"SELECT folder || '/' || entity AS FOLDER, CASE batch WHEN 0 THEN count(*) END AS ROWS_READ, "
            f"CASE batch WHEN 0 THEN TIMESTAMP '2001-11-04 03:00:30' END AS LOADED_AT, CAST(batch AS BIGINT) AS WAITING "
            f"FROM ({both(*[landed(e) for e in KEYS])}) v WHERE batch < 2 GROUP BY folder, entity, batch"
        ),
        "triggered_batches": query(
            f"SELECT entity AS FEED, CAST(batch AS BIGINT) AS BATCH, count(*) AS ROWS FROM ({both(*[landed(e) for e in KEYS])}) v GROUP BY entity, batch"
        ),
        "retired_files": query(
            f"SELECT folder AS PREFIX, count(*) AS N, CASE batch WHEN 2 THEN 'landing' ELSE 'archive' END AS PLACE "
            f"FROM ({landed('booking')}) v GROUP BY folder, batch"
        ),
        "export_sizes": query(
            "SELECT count(*) AS N, CAST(sum(NET_REVENUE) AS DOUBLE) AS NET_REVENUE, CAST(0 AS BIGINT) AS TOO_LARGE FROM fact", states(), fact()
        ),
        "unload_runs": query(
            both(
                *[
                    f"SELECT '{run}' AS RUN, count(*) AS N, CAST(sum(NET_REVENUE) AS DOUBLE) AS NET_REVENUE FROM {source}"
                    for run, source in (("first", "old_fact"), ("second", "fact"), ("newest", "fact"), ("2001-11-03", "old_fact"), ("2001-11-04", "fact"))
                ]
            ),
            states(), fact(), states("0", "old_"), fact("old_fact", "old_"),
        ),
        "dq_relationships": both(
            *[
                dq_line(name, child, f"SELECT 1 FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)", severity)
                for name, child, column, parent, key, severity in RELATIONSHIPS
            ]
        ),
    }
