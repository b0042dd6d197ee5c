"""Short ways to make raw rows in tests."""

from tidemark import constants as K
from tidemark.specs import BOOKING, CLAIM, RESERVATION

TS = "2026-08-01 09:00:00"

DEFAULTS = {
    "booking": {
        "BOOKING_ID": "B1", "PASSENGER_ID": "P1", "FLIGHT_NUMBER": "F1", "ORIGIN": "AAA", "DESTINATION": "BBB",
        "BOOKING_TS": TS, "BOOKING_STATUS": "CONFIRMED", "FARE_AMOUNT": "100.00", "CURRENCY": "USD", "CHANNEL": "WEB",
    },
    "reservation": {
        "RESERVATION_ID": "R1", "BOOKING_ID": "B1", "SEAT_NUMBER": "1A", "CABIN_CLASS": "ECONOMY",
        "RESERVATION_STATUS": "ACTIVE", "CHECKED_IN_FLAG": "N", "UPDATED_TS": TS,
    },
    "claim": {
        "CLAIM_ID": "C1", "BOOKING_ID": "B1", "CLAIM_TYPE": "DELAY", "CLAIM_STATUS": "OPEN", "CLAIM_AMOUNT": "10.00",
        "FILED_TS": TS, "SETTLED_TS": None,
    },
}


def raw(spark, spec, *rows):
    """Raw rows from dicts; unnamed columns take defaults, `op` and `seq` are short for the header."""
    lines = []
    for i, row in enumerate(rows):
        line = {
            **DEFAULTS[spec.name],
            K.CHANGE_OPER: "U", K.CHANGE_SEQ: str(i + 1), K.CHANGE_TS: TS, K.SRC_FILE: "f.csv", K.LOAD_TS: None,
        }
        short = {"op": K.CHANGE_OPER, "seq": K.CHANGE_SEQ, "id": spec.key}
        line.update({short.get(k, k): v for k, v in row.items()})
        lines.append(tuple(line[c] for c in spec.raw_schema.names))
    return spark.createDataFrame(lines, spec.raw_schema)


def by_key(df, key):
    rows = df.collect()
    found = {r[key]: r for r in rows}
    assert len(found) == len(rows), "duplicate keys"
    return found


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


__all__ = ["BOOKING", "CLAIM", "RESERVATION", "TS", "by_key", "raw", "same_rows"]
