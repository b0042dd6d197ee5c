"""The newest row of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators.typing import TIE_COLUMNS
from tidemark.specs import EntitySpec


class DuplicateKeyError(ValueError):
    """A merge source holds more than one row for a key."""


def latest_per_key(df: DataFrame, key: str | list[str], seq: str, ties: list[str] | None = None) -> DataFrame:
    """One row per key: highest sequence, then the tie columns in order, all descending.

    An unknown sequence ranks first. The `rank = 1` filter lets Spark drop all but one row per key
    in every map task (WindowGroupLimit), so a hot key costs one row per task in the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.desc_nulls_first(seq), *[F.desc_nulls_last(t) for t in ties or []]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def newest_changes(typed_rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """One typed row per key of a batch. Equal sequences fall back to a total order of the row."""
    values = [f.name for f in spec.fields]
    ties = [*TIE_COLUMNS, K.IS_DELETED, *values]
    return latest_per_key(typed_rows, spec.key, K.CHANGE_SEQ, ties).select(*spec.state_columns)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Fail like a merge does when its source repeats a key."""
    if not df.groupBy(key).count().filter(F.col("count") > 1).isEmpty():
        raise DuplicateKeyError(f"more than one source row for a value of {key}")
    return df
