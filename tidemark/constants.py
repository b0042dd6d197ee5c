"""Values that results depend on. Everything here is a fixed value of the data contract."""

# Change operation codes (full load, insert, update, delete).
OP_LOAD = "L"
OP_INSERT = "I"
OP_UPDATE = "U"
OP_DELETE = "D"

# Change header columns of every raw row, and the bookkeeping columns of silver.
CHANGE_OPER = "CHANGE_OPER"
CHANGE_SEQ = "CHANGE_SEQ"
CHANGE_TS = "CHANGE_TS"
SRC_FILE = "SRC_FILE"
LOAD_TS = "LOAD_TS"
IS_DELETED = "IS_DELETED"
UPDATED_AT = "UPDATED_AT"

# Text that means "no value" in a landing file.
NULL_TOKENS = ("", "NULL")

# Business vocabulary.
BOOKING_STATUSES = ("CONFIRMED", "PENDING", "CANCELLED")
LIVE_BOOKING_STATUSES = ("CONFIRMED", "PENDING")
CANCELLED = "CANCELLED"
SETTLED = "SETTLED"
OPEN = "OPEN"
DEFAULT_CURRENCY = "USD"
CODE_LENGTH = 3

# Revenue bands, lower bound of the fare.
BAND_HIGH = ("HIGH", 1200)
BAND_MEDIUM = ("MEDIUM", 900)
BAND_LOW = "LOW"
REVENUE_BANDS = ("HIGH", "MEDIUM", "LOW")

# Freshness limits in hours, export chunk in bytes, trigger interval.
FRESHNESS_WARN_HOURS = 2
FRESHNESS_ERROR_HOURS = 6
EXPORT_FILE_BYTES = 16_000_000
TRIGGER_INTERVAL = "30 seconds"

# A side of a join may be broadcast only while its row count, read from a commit record or counted
# beforehand, stays below this (keys of some 100 bytes each). Beyond it the same step runs as a
# shuffled join.
BROADCAST_ROWS = 1_000_000

# How tables, change sets and staged batches are written: zstd, and encodings by which sorted keys and texts
# that begin alike keep only what differs. A third less to write than by the defaults, and a sixth less again.
STORED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6", "parquet.writer.version": "v2"}

# How a batch lies in raw until it is merged: rows in the order of the files, for which the defaults take no more room.
PASSING = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}

# Up to so many keys of a batch are listed in the look-up itself: literals that choose files and pages.
LISTED_KEYS = 1_000
