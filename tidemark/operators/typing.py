"""Raw text rows to typed rows, and the split of unusable rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.scalars import as_timestamp, is_unparsable, read_field, try_sequence, try_timestamp
from tidemark.specs import SAFE, EntitySpec, Policy

# Ordering columns that travel with typed rows until the newest row of a key is chosen.
TIE_COLUMNS = ["_change_ts", "_src_file"]


def reject_reason(spec: EntitySpec, policy: Policy = SAFE) -> Column:
    """Why a raw row cannot be stored; NULL for a usable row. A row without a key never can."""
    reason = F.when(F.col(spec.key).isNull(), F.lit("missing key"))
    if not policy.quarantine:
        return reason
    reason = reason.when(try_sequence(F.col(K.CHANGE_SEQ)).isNull(), F.lit("unusable sequence"))
    for field in spec.fields:
        if field.kind in ("code", "currency"):
            reason = reason.when(F.length(read_field(field)) > K.CODE_LENGTH, F.lit(f"{field.name} too long"))
    return reason


def split_rejects(raw: DataFrame, spec: EntitySpec, policy: Policy = SAFE) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows with REJECT_REASON)."""
    reason = reject_reason(spec, policy)
    return raw.filter(reason.isNull()), raw.filter(reason.isNotNull()).withColumn("REJECT_REASON", reason)


def typed(raw: DataFrame, spec: EntitySpec, policy: Policy = SAFE, run_ts=None) -> DataFrame:
    """Silver columns plus the ordering columns. Rows narrow here, before any shuffle."""
    deleted = F.col(K.CHANGE_OPER) == K.OP_DELETE
    if policy.null_op_is_live:
        deleted = F.coalesce(deleted, F.lit(False))
    usable, _ = split_rejects(raw, spec, policy)
    return usable.select(
        F.col(spec.key),
        *[read_field(f).alias(f.name) for f in spec.fields],
        deleted.alias(K.IS_DELETED),
        try_sequence(F.col(K.CHANGE_SEQ)).alias(K.CHANGE_SEQ),
        as_timestamp(run_ts).alias(K.UPDATED_AT),
        try_timestamp(F.col(K.CHANGE_TS)).alias(TIE_COLUMNS[0]),
        F.col(K.SRC_FILE).alias(TIE_COLUMNS[1]),
    )


def unparsable_fields(spec: EntitySpec) -> Column:
    """How many fields of a raw row hold text that gives no value."""
    counts = [is_unparsable(f).cast("int") for f in spec.fields if f.kind in ("money", "timestamp")]
    return reduce(lambda a, b: a + b, counts, F.lit(0))
