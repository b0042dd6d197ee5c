"""Change sets: what one batch does to a table, and how a table takes it in.

A change set has one row per changed key: the table's columns (the image after the change),
`_pre` (the image before, NULL for an insert) and `_change_type` (insert, update, delete).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark.specs import EntitySpec

PRE = "_pre"
CHANGE_TYPE = "_change_type"
VERSION = "_version"
COUNTED = {"INSERTED": "insert", "UPDATED": "update", "DELETED": "delete"}


def change_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            *schema.fields,
            T.StructField(PRE, schema),
            T.StructField(CHANGE_TYPE, T.StringType()),
            T.StructField(VERSION, T.LongType()),
        ]
    )


def join_side(df: DataFrame, small: bool) -> DataFrame:
    """A side of a join by key: broadcast if its size was checked, else never. Left alone, Spark would decide by the
    bytes of the stored files, which hold some 25 times as much in memory."""
    return F.broadcast(df) if small else df.hint("merge")


def change_set(
    current: DataFrame | None,
    batch: DataFrame,
    spec: EntitySpec,
    guard: bool = True,
    lookup: str = "join",
) -> DataFrame:
    """What `batch` (one row per key) does to `current`. `lookup` says how stored rows are found:

    join       one shuffled join, for inputs that are themselves still plans
    pick       first a semi join with the batch's keys, which Spark moves down to the files of a
               stored table: the keys are shuffled to its buckets, the table stays where it is
    broadcast  the same with broadcast keys, for a batch whose size was checked
    buckets    one join in place, for a batch that lies in the buckets of a table that is its base alone
    """
    columns = spec.state_columns
    if current is None:
        empty = F.lit(None).cast(T.StructType(spec.state_schema.fields))
        return batch.select(*columns, empty.alias(PRE), F.lit("insert").alias(CHANGE_TYPE))

    stored = current
    if lookup in ("pick", "broadcast"):
        keys = join_side(batch.select(spec.key), lookup == "broadcast")
        stored = stored.join(keys, spec.key, "left_semi")
    stored = stored.select(F.col(spec.key), F.struct(*columns).alias(PRE))
    if lookup in ("pick", "buckets"):
        stored = join_side(stored, small=False)
    joined = batch.select(*columns).join(stored, spec.key, "left")

    if guard:
        stored_seq = F.col(f"{PRE}.{K.CHANGE_SEQ}")
        joined = joined.filter(stored_seq.isNull() | (F.col(K.CHANGE_SEQ) > stored_seq))
    if spec.delete_image == "key_only":
        keep = F.col(K.IS_DELETED) & F.col(PRE).isNotNull()
        kept = {f.name: F.when(keep, F.col(f"{PRE}.{f.name}")).otherwise(F.col(f.name)) for f in spec.fields}
        joined = joined.withColumns(kept)
    kind = F.when(F.col(PRE).isNull(), "insert").otherwise("update")
    return joined.select(*columns, PRE, kind.alias(CHANGE_TYPE))


def apply_change_set(current: DataFrame | None, changes: DataFrame, key: str, small: bool = False) -> DataFrame:
    """The table after the change set. With `small` (checked size) `current` is not shuffled."""
    columns = [c for c in changes.columns if c not in (PRE, CHANGE_TYPE, VERSION)]
    written = changes.filter(F.col(CHANGE_TYPE) != "delete").select(*columns)
    if current is None:
        return written
    untouched = current.join(join_side(changes.select(key), small), key, "left_anti")
    return untouched.select(*columns).unionByName(written)


def upsert(current: DataFrame | None, batch: DataFrame, spec: EntitySpec, guard: bool = True) -> DataFrame:
    """The table after `batch`, as one full outer join on the key: each side is read once."""
    columns = spec.state_columns
    if current is None:
        return batch.select(*columns)
    old = current.select(F.col(spec.key), F.struct(*columns).alias("_old"))
    new = batch.select(F.col(spec.key), F.struct(*columns).alias("_new"))
    both = old.join(new, spec.key, "full")

    takes_new = F.col("_new").isNotNull()
    if guard:
        old_seq, new_seq = F.col(f"_old.{K.CHANGE_SEQ}"), F.col(f"_new.{K.CHANGE_SEQ}")
        takes_new = takes_new & (old_seq.isNull() | F.coalesce(new_seq > old_seq, F.lit(False)))
    from_new = list(columns)
    if spec.delete_image == "key_only":
        from_new = [spec.key, K.IS_DELETED, K.CHANGE_SEQ, K.UPDATED_AT]
    keeps_values = takes_new & F.col(f"_new.{K.IS_DELETED}") & F.col("_old").isNotNull()

    def pick(c: str):
        if c in from_new:
            return F.when(takes_new, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
        return F.when(takes_new & ~F.coalesce(keeps_values, F.lit(False)), F.col(f"_new.{c}")).otherwise(
            F.col(f"_old.{c}")
        ).alias(c)

    return both.select(*[pick(c) for c in columns])


def change_rows(changes: DataFrame) -> DataFrame:
    """The change set as a stream of images: an update gives a row before and a row after."""
    columns = [c for c in changes.columns if c not in (PRE, CHANGE_TYPE, VERSION)]
    carried = [VERSION] if VERSION in changes.columns else []
    after = F.struct(*columns)
    kind = F.col(CHANGE_TYPE)

    def image(label: str, value):
        return F.array(F.struct(F.lit(label).alias(CHANGE_TYPE), value.alias("_image")))

    rows = (
        F.when(kind == "insert", image("insert", after))
        .when(kind == "delete", image("delete", F.col(PRE)))
        .otherwise(F.concat(image("update_preimage", F.col(PRE)), image("update_postimage", after)))
    )
    exploded = changes.select(*carried, F.explode(rows).alias("_row"))
    return exploded.select(
        F.col(f"_row.{CHANGE_TYPE}").alias(CHANGE_TYPE),
        *[F.col(f"_row._image.{c}").alias(c) for c in columns],
        *carried,
    )


def net_changes(changes: DataFrame, key: str) -> DataFrame:
    """Several versions of changes folded into one change set: first image before, last image after."""
    columns = [c for c in changes.columns if c not in (PRE, CHANGE_TYPE, VERSION)]
    last = F.when(F.col(CHANGE_TYPE) != "delete", F.struct(*columns))
    folded = (
        changes.withColumn("_post", last)
        .groupBy(key)
        .agg(F.min_by(PRE, VERSION).alias(PRE), F.max_by("_post", VERSION).alias("_post"))
    )
    kind = (
        F.when(F.col(PRE).isNull(), "insert")
        .when(F.col("_post").isNull(), "delete")
        .otherwise("update")
    )
    return folded.filter(F.col(PRE).isNotNull() | F.col("_post").isNotNull()).select(
        key,
        *[F.col(f"_post.{c}").alias(c) for c in columns if c != key],
        PRE,
        kind.alias(CHANGE_TYPE),
    )


def changed_keys(change_sets: dict[str, DataFrame], all_sources: bool = True, key: str = "BOOKING_ID") -> DataFrame:
    """Distinct parent keys named by the change sets, before or after each change.

    The image before matters: a claim moved to another booking changes both bookings.
    """
    names = list(change_sets) if all_sources else ["booking"]
    parts = [
        change_sets[n].select(F.explode(F.array_distinct(F.array(F.col(key), F.col(f"{PRE}.{key}")))).alias(key))
        for n in names
    ]
    united = reduce(DataFrame.unionByName, parts)
    return united.filter(F.col(key).isNotNull()).distinct()


def count_changes(changes: DataFrame) -> DataFrame:
    """One row: how many keys were inserted, updated and deleted."""
    return changes.agg(*[F.count_if(F.col(CHANGE_TYPE) == v).alias(k) for k, v in COUNTED.items()])


def newest_images(changes: DataFrame, key: str) -> DataFrame:
    """The last change of every key among several versions."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(VERSION)))
    return changes.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
