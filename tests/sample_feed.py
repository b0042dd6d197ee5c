"""A small airline feed with known results: one full load and one hourly batch.

Fixed values: the rows below belong to the expected results in FIXTURES.md.
"""

FULL_BOOKING = """\
BOOKING_ID,PASSENGER_ID,FLIGHT_NUMBER,ORIGIN,DESTINATION,BOOKING_TS,BOOKING_STATUS,FARE_AMOUNT,CURRENCY,CHANNEL,HEADER__CHANGE_OPER,HEADER__CHANGE_SEQ,HEADER__TIMESTAMP
BK1001,PX501,AA210,JFK,LHR,2026-08-01 09:12:00,CONFIRMED,842.50,USD,WEB,L,1000000001,2026-08-20 00:00:00
BK1002,PX502,AA210,JFK,LHR,2026-08-01 10:03:00,CONFIRMED,799.00,USD,MOBILE,L,1000000002,2026-08-20 00:00:00
BK1003,PX503,DL880,ATL,CDG,2026-08-02 14:45:00,CONFIRMED,1120.75,USD,AGENT,L,1000000003,2026-08-20 00:00:00
BK1004,PX504,UA455,ORD,FRA,2026-08-03 07:30:00,PENDING,950.00,USD,WEB,L,1000000004,2026-08-20 00:00:00
BK1005,PX505,AA210,JFK,LHR,2026-08-03 18:20:00,CONFIRMED,860.00,USD,WEB,L,1000000005,2026-08-20 00:00:00
BK1006,PX506,BA112,BOS,LHR,2026-08-04 11:05:00,CONFIRMED,1310.00,USD,MOBILE,L,1000000006,2026-08-20 00:00:00
BK1007,PX507,DL880,ATL,CDG,2026-08-05 16:40:00,CANCELLED,1120.75,USD,AGENT,L,1000000007,2026-08-20 00:00:00
BK1008,PX508,UA455,ORD,FRA,2026-08-06 08:15:00,CONFIRMED,975.25,USD,WEB,L,1000000008,2026-08-20 00:00:00
BK1009,PX509,AF022,LAX,CDG,2026-08-07 22:00:00,CONFIRMED,1450.00,USD,PARTNER,L,1000000009,2026-08-20 00:00:00
BK1010,PX510,BA112,BOS,LHR,2026-08-08 06:25:00,PENDING,1290.00,USD,WEB,L,1000000010,2026-08-20 00:00:00
"""

FULL_RESERVATION = """\
RESERVATION_ID,BOOKING_ID,SEAT_NUMBER,CABIN_CLASS,RESERVATION_STATUS,CHECKED_IN_FLAG,UPDATED_TS,HEADER__CHANGE_OPER,HEADER__CHANGE_SEQ,HEADER__TIMESTAMP
RS9001,BK1001,12A,ECONOMY,ACTIVE,N,2026-08-01 09:15:00,L,2000000001,2026-08-20 00:00:00
RS9002,BK1002,12B,ECONOMY,ACTIVE,N,2026-08-01 10:05:00,L,2000000002,2026-08-20 00:00:00
RS9003,BK1003,03C,BUSINESS,ACTIVE,N,2026-08-02 14:50:00,L,2000000003,2026-08-20 00:00:00
RS9004,BK1004,21F,ECONOMY,HELD,N,2026-08-03 07:35:00,L,2000000004,2026-08-20 00:00:00
RS9005,BK1005,14D,ECONOMY,ACTIVE,Y,2026-08-03 18:25:00,L,2000000005,2026-08-20 00:00:00
RS9006,BK1006,01A,FIRST,ACTIVE,N,2026-08-04 11:10:00,L,2000000006,2026-08-20 00:00:00
RS9007,BK1007,03D,BUSINESS,CANCELLED,N,2026-08-05 16:45:00,L,2000000007,2026-08-20 00:00:00
RS9008,BK1008,18C,ECONOMY,ACTIVE,N,2026-08-06 08:20:00,L,2000000008,2026-08-20 00:00:00
RS9009,BK1009,02B,BUSINESS,ACTIVE,Y,2026-08-07 22:10:00,L,2000000009,2026-08-20 00:00:00
RS9010,BK1010,22A,ECONOMY,HELD,N,2026-08-08 06:30:00,L,2000000010,2026-08-20 00:00:00
"""

FULL_CLAIM = """\
CLAIM_ID,BOOKING_ID,CLAIM_TYPE,CLAIM_STATUS,CLAIM_AMOUNT,FILED_TS,SETTLED_TS,HEADER__CHANGE_OPER,HEADER__CHANGE_SEQ,HEADER__TIMESTAMP
CL7001,BK1003,BAGGAGE,OPEN,320.00,2026-08-06 09:00:00,,L,3000000001,2026-08-20 00:00:00
CL7002,BK1007,CANCELLATION,SETTLED,1120.75,2026-08-06 12:30:00,2026-08-12 10:00:00,L,3000000002,2026-08-20 00:00:00
CL7003,BK1009,DELAY,OPEN,250.00,2026-08-09 08:45:00,,L,3000000003,2026-08-20 00:00:00
CL7004,BK1001,BAGGAGE,REJECTED,180.00,2026-08-10 15:20:00,2026-08-14 09:00:00,L,3000000004,2026-08-20 00:00:00
CL7005,BK1006,DELAY,OPEN,400.00,2026-08-11 19:05:00,,L,3000000005,2026-08-20 00:00:00
"""

CDC_BOOKING = """\
BOOKING_ID,PASSENGER_ID,FLIGHT_NUMBER,ORIGIN,DESTINATION,BOOKING_TS,BOOKING_STATUS,FARE_AMOUNT,CURRENCY,CHANNEL,HEADER__CHANGE_OPER,HEADER__CHANGE_SEQ,HEADER__TIMESTAMP
BK1004,PX504,UA455,ORD,FRA,2026-08-03 07:30:00,CONFIRMED,950.00,USD,WEB,U,1000000101,2026-08-21 06:10:00
BK1010,PX510,BA112,BOS,LHR,2026-08-08 06:25:00,CONFIRMED,1290.00,USD,WEB,U,1000000102,2026-08-21 06:11:00
BK1011,PX511,AA210,JFK,LHR,2026-08-21 05:55:00,CONFIRMED,880.00,USD,MOBILE,I,1000000103,2026-08-21 06:12:00
BK1012,PX512,AF022,LAX,CDG,2026-08-21 06:01:00,CONFIRMED,1499.99,USD,WEB,I,1000000104,2026-08-21 06:13:00
BK1002,PX502,AA210,JFK,LHR,2026-08-01 10:03:00,CANCELLED,799.00,USD,MOBILE,U,1000000105,2026-08-21 06:14:00
BK1005,PX505,AA210,JFK,LHR,2026-08-03 18:20:00,CONFIRMED,860.00,USD,WEB,D,1000000106,2026-08-21 06:15:00
BK1011,PX511,AA210,JFK,LHR,2026-08-21 05:55:00,CONFIRMED,910.00,USD,MOBILE,U,1000000107,2026-08-21 06:20:00
"""

CDC_RESERVATION = """\
RESERVATION_ID,BOOKING_ID,SEAT_NUMBER,CABIN_CLASS,RESERVATION_STATUS,CHECKED_IN_FLAG,UPDATED_TS,HEADER__CHANGE_OPER,HEADER__CHANGE_SEQ,HEADER__TIMESTAMP
RS9004,BK1004,21F,ECONOMY,ACTIVE,N,2026-08-21 06:10:00,U,2000000101,2026-08-21 06:10:00
RS9010,BK1010,22A,PREMIUM,ACTIVE,N,2026-08-21 06:11:00,U,2000000102,2026-08-21 06:11:00
RS9011,BK1011,15C,ECONOMY,ACTIVE,N,2026-08-21 06:12:00,I,2000000103,2026-08-21 06:12:00
RS9012,BK1012,02A,BUSINESS,ACTIVE,N,2026-08-21 06:13:00,I,2000000104,2026-08-21 06:13:00
RS9002,BK1002,12B,ECONOMY,CANCELLED,N,2026-08-21 06:14:00,U,2000000105,2026-08-21 06:14:00
RS9005,BK1005,14D,ECONOMY,ACTIVE,Y,2026-08-21 06:15:00,D,2000000106,2026-08-21 06:15:00
RS9011,BK1011,15C,ECONOMY,ACTIVE,Y,2026-08-21 07:00:00,U,2000000107,2026-08-21 07:00:00
"""

CDC_CLAIM = """\
CLAIM_ID,BOOKING_ID,CLAIM_TYPE,CLAIM_STATUS,CLAIM_AMOUNT,FILED_TS,SETTLED_TS,HEADER__CHANGE_OPER,HEADER__CHANGE_SEQ,HEADER__TIMESTAMP
CL7001,BK1003,BAGGAGE,SETTLED,320.00,2026-08-06 09:00:00,2026-08-21 06:05:00,U,3000000101,2026-08-21 06:05:00
CL7006,BK1011,DELAY,OPEN,150.00,2026-08-21 06:30:00,,I,3000000102,2026-08-21 06:30:00
CL7003,BK1009,DELAY,SETTLED,250.00,2026-08-09 08:45:00,2026-08-21 06:40:00,U,3000000103,2026-08-21 06:40:00
CL7004,BK1001,BAGGAGE,REJECTED,180.00,2026-08-10 15:20:00,2026-08-14 09:00:00,D,3000000104,2026-08-21 06:45:00
"""

FULL = {"booking": FULL_BOOKING, "reservation": FULL_RESERVATION, "claim": FULL_CLAIM}
CDC = {"booking": CDC_BOOKING, "reservation": CDC_RESERVATION, "claim": CDC_CLAIM}


def land(landing, prefix: str, files: dict[str, str], tag: str = "0001") -> None:
    """Write one file per entity below `landing/prefix`."""
    folder = landing / prefix
    folder.mkdir(parents=True, exist_ok=True)
    for entity, text in files.items():
        (folder / f"{entity}_{tag}.csv").write_text(text)
