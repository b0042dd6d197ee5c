"""A keyed table kept as a base snapshot plus change sets, published by small commit files.

    <path>/changes/v=<n>/   change set of version n, written once, never rewritten
    <path>/base/v=<n>/      full rows at version n, written now and then by `compact`
    <path>/folded/v=<n>/    the newest images of all change sets up to version n, written by `commit`
    <path>/_commits/<n>     JSON: which base and change sets make up version n
    <path>/_commits/<n>.base  JSON: the base that `compact` made of version n

A commit writes only what changed, so its cost follows the batch and not the table. Readers take
the newest commit file; a directory without one is ignored, so a job that dies half-way leaves the
table as it was and its retry writes the same directory again. One writer per table.

The base is bucketed by key. A join of the table with changed keys therefore never shuffles the
base: few keys are broadcast, many keys are shuffled to the base's buckets. Bucketing needs a name
in the session catalog, so each base is known there as an external table. Names of earlier bases
stay, for readers that still use them; dropping one keeps its files.

Looking up a batch reads of the base what the batch can touch. Files carry Bloom filters of the
looked-up columns and are sorted by key. Few keys become literals, which choose buckets, row groups and
pages; more keys carry their range, which Spark infers for the base too and which lets it build a
runtime filter from the batch.
"""

from __future__ import annotations

import bisect
import hashlib
import json
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K
from tidemark.operators.changes import (
    CHANGE_TYPE,
    PRE,
    VERSION,
    apply_change_set,
    change_schema,
    net_changes,
    newest_images,
)
from tidemark.state.files import SharedFiles

KINDS = ("insert", "update", "delete")
# So many change sets are folded into one, which leaves the base alone.
FOLD_CHANGE_SETS = 24
# The base is written anew when the change sets hold this share of it.
MAX_CHANGED_SHARE = 0.25
# Estimates come from compressed files, so a bucket holds several times this in memory.
BUCKET_BYTES = 16 * 1024 * 1024


def observed(rows: DataFrame, **measures: Column) -> tuple[DataFrame, Observation]:
    """Rows that are measured while they are written, without a job of its own. The measures belong to the
    tasks that write, so each task counts once, however often it was tried."""
    seen = Observation()
    return rows.observe(seen, *[m.alias(n) for n, m in (measures or {"n": F.count(F.lit(1))}).items()]), seen


def counted() -> dict[str, Column]:
    """How many rows of a change set are of each kind."""
    return {k: F.count_if(F.col(CHANGE_TYPE) == k) for k in KINDS}


class VersionedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        schema: T.StructType,
        buckets: int | None = None,
        looked_up: tuple[str, ...] = (),
    ):
        """`buckets` of the base; by default as its estimated size asks, up to the shuffle partitions.
        `looked_up`: columns besides the key that rows are picked by."""
        self.spark = spark
        self.key = key
        self.schema = schema
        self._files = SharedFiles(spark, path)
        self.path = self._files.qualified(path.rstrip("/"))
        self._buckets = buckets
        self._looked_up = tuple(dict.fromkeys((key, *looked_up)))

    # ---- commits -------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self._files.names(f"{self.path}/_commits") if n.isdigit())

    def record(self, version: int | None = None) -> dict | None:
        """The commit record of a version, by default the newest; None for a table never written."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        path = f"{self.path}/_commits/{version}"
        record = json.loads(self._files.read_text(path))
        compacted = f"{path}.base"
        return record | json.loads(self._files.read_text(compacted)) if self._files.exists(compacted) else record

    def version(self) -> int:
        known = self.versions()
        return known[-1] if known else 0

    def version_at(self, moment: datetime) -> int:
        """The newest version committed at or before `moment` (without a zone: the driver's)."""
        known, stamp = self.versions(), moment.astimezone(UTC).replace(tzinfo=None).isoformat(timespec="microseconds")
        later = bisect.bisect_right(known, stamp, key=lambda v: self.record(v)["committed"])
        return known[later - 1] if later else 0

    def seen(self, token: tuple[str, int] | None) -> bool:
        """Whether the batch `(feed id, batch id)` is already part of the table."""
        head = self.record()
        if token is None or head is None:
            return False
        return head["tokens"].get(token[0], -1) >= token[1]

    def _publish(self, version: int, **values) -> dict:
        head = self.record() or {"tokens": {}, "meta": {}, "rows": 0}
        record = {
            "version": version,
            "committed": datetime.now(UTC).replace(tzinfo=None).isoformat(timespec="microseconds"),
            "base": None,
            "buckets": None,
            "base_rows": 0,
            "change_sets": [],
            "changed_rows": 0,
            "rows": head["rows"],
            "counts": dict.fromkeys(KINDS, 0),
            "tokens": head["tokens"],
            "meta": head["meta"],
            "cut": False,
            **values,
        }
        self._files.publish_text(f"{self.path}/_commits/{version}", json.dumps(record))
        return record

    # ---- reading -------------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the newest."""
        record = self.record(version) if version != 0 else None
        if record is None or record["base"] is None:
            return self.spark.createDataFrame([], self.schema)
        base = self._read_base(record)
        if not record["change_sets"]:
            return base
        small = record["changed_rows"] <= K.BROADCAST_ROWS
        return apply_change_set(base, self._newest(record).drop(PRE), self.key, small)

    def _newest(self, record: dict) -> DataFrame:
        images = self._change_sets(record["change_sets"])
        return newest_images(images, self.key) if len(record["change_sets"]) > 1 else images

    def _base_name(self, target: str) -> str:
        return "tidemark_" + hashlib.md5(f"{self.path}/{target}".encode()).hexdigest()

    def _read_base(self, record: dict) -> DataFrame:
        name = self._base_name(record["base"])
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {record['buckets']} BUCKETS "
                f"LOCATION '{self.path}/{record['base']}'"
            )
        return self.spark.table(name).select(*self.schema.names)

    def _bucket_count(self, rows: DataFrame) -> int:
        """As asked for, else by the estimated size: a divisor of the shuffle partitions, so that
        rows shuffled by key already lie in tasks that write whole buckets. The estimate multiplies the
        sides of a join, so it cannot go unbounded."""
        if self._buckets:
            return self._buckets
        partitions = self._shuffle_partitions()
        estimate = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        wanted = int(str(estimate)) // BUCKET_BYTES + 1
        return next((n for n in range(1, partitions) if partitions % n == 0 and n >= wanted), partitions)

    def _shuffle_partitions(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _write_base(self, rows: DataFrame, target: str, buckets: int, spread: bool, **measured: Column) -> dict:
        """Write bucketed rows, after a shuffle to the buckets if they still need to be spread. Returns
        the measures of what was written."""
        if spread:  # rows of a join by key lie in the shuffle partitions already and are not moved again
            fits = self._shuffle_partitions() % buckets == 0
            rows = rows.repartition(self.key) if fits else rows.repartition(buckets, self.key)
        rows, seen = observed(rows, **measured)
        writer = rows.write.mode("overwrite").format("parquet").bucketBy(buckets, self.key).sortBy(self.key)
        writer = writer.options(**K.STORED)
        for column in self._looked_up:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.option("path", f"{self.path}/{target}").saveAsTable(self._base_name(target))
        return seen.get

    def is_empty(self) -> bool:
        record = self.record()
        return record is None or record["base"] is None

    def _change_sets(self, versions: list[int | str]) -> DataFrame:
        """Change sets by version, or by path if folded."""
        paths = [f"{self.path}/{v if isinstance(v, str) else f'changes/v={v}'}" for v in versions]
        return self.spark.read.schema(change_schema(self.schema)).parquet(*paths)

    def change_versions(self, after: int, upto: int | None = None) -> list[int]:
        """Versions in (after, upto] that changed at least one row."""
        inside = [v for v in self.versions() if v > after and (upto is None or v <= upto)]
        return [v for v in inside if sum(self.record(v)["counts"].values())]

    def changes(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """The change sets of the versions in (after, upto], one row per key and version."""
        versions = self.change_versions(after, upto)
        if not versions:
            return self.spark.createDataFrame([], change_schema(self.schema))
        return self._change_sets(versions)

    def net_changes(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """The versions in (after, upto] folded into one change set."""
        return net_changes(self.changes(after, upto), self.key)

    def changed_rows(self, after: int = 0, upto: int | None = None) -> int:
        """How many change rows lie in (after, upto], from the commit records."""
        return sum(sum(self.record(v)["counts"].values()) for v in self.change_versions(after, upto))

    def stream_rows(self, after: int = 0, upto: int | None = None) -> int:
        """How many images a change stream shows for (after, upto]: an update counts twice."""
        counts = [self.record(v)["counts"] for v in self.change_versions(after, upto)]
        return sum(sum(c.values()) + c["update"] for c in counts)

    # ---- writing -------------------------------------------------------------------------

    def stage(self, rows: DataFrame, clustered: bool = False) -> tuple[DataFrame, int]:
        """Rows of a batch written next to the table and read back, with their number.

        Whatever is done with them next then starts from files: nothing before is computed twice,
        and a lost executor costs a file read. They stay until `unstage` or the next batch. The rows come back under
        the range of their keys, measured while they were written: it reaches the base of a join by key.

        `clustered` says the rows come from a shuffle by key: a large batch then lies in the buckets of the base,
        so that the look-up shuffles neither.
        """
        aligned = clustered and self.aligned(rows)
        target = "staging-by-key" if aligned else "staging"
        rows, seen = observed(rows, n=F.count(F.lit(1)), low=F.min(self.key), high=F.max(self.key))
        if aligned:
            self._write_by_key(rows, target)
            staged = self.spark.table(self._base_name(target))
        else:
            rows.write.mode("overwrite").options(**K.STORED).parquet(f"{self.path}/{target}")
            staged = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{target}")
        if seen.get["n"] == 0:
            return staged, 0
        key = F.col(self.key)
        return staged.filter(key.between(F.lit(seen.get["low"]), F.lit(seen.get["high"]))), seen.get["n"]

    def unstage(self) -> None:
        """Remove the staged batch, once it is committed."""
        for target in ("staging", "staging-by-key"):
            self._files.remove(f"{self.path}/{target}")

    def aligned(self, rows: DataFrame) -> bool:
        """Whether rows from a shuffle by key are worth buckets and lie in tasks that write few of them."""
        return self.in_whole_buckets() and self._bucket_count(rows) > 1

    def in_whole_buckets(self) -> bool:
        """Whether a task after a shuffle by key holds rows of one bucket of the base, not of several."""
        head = self.record()
        return head is not None and head["base"] is not None and self._shuffle_partitions() % head["buckets"] == 0

    def _write_by_key(self, rows: DataFrame, target: str) -> None:
        """Write rows into as many buckets as the base has, so that neither is shuffled to meet the other."""
        writer = rows.write.mode("overwrite").format("parquet").options(**K.STORED)
        writer = writer.bucketBy(self.record()["buckets"], self.key).option("path", f"{self.path}/{target}")
        writer.saveAsTable(self._base_name(target))

    def read_keys(self, keys: list, version: int | None = None, column: str | None = None) -> DataFrame:
        """The rows of a version with a few listed keys, or values of another looked-up column. Spark
        chooses buckets, row groups and pages by them."""
        return self.read(version).filter(F.col(column or self.key).isin(keys))

    def commit(
        self,
        changes: DataFrame,
        token: tuple[str, int] | None = None,
        meta: dict | None = None,
        clustered: bool = False,
        buckets: int | None = None,
    ) -> dict:
        """Write a change set as the next version. An empty one adds no version.

        The first change set of an empty table holds every row: it is written as the base.
        `clustered` says its rows come from a shuffle by key, or from a join with the base that shuffled
        neither side; `buckets` overrides the estimate, which is far too high above a join.
        """
        head = self.record()
        version = (head["version"] if head else 0) + 1
        target = f"changes/v={version}"
        names = [f.name for f in change_schema(self.schema).fields]
        rows = changes.withColumn(VERSION, F.lit(version).cast("long")).select(*names)
        first = head is None or head["base"] is None
        if first:
            buckets = buckets or self._bucket_count(rows)
            partitions = self._shuffle_partitions()
            spread = not clustered or (partitions % buckets > 0 and buckets % partitions > 0)
            counts = self._write_base(rows, target, buckets, spread, **counted())
        else:
            rows, seen = observed(rows, **counted())
            if clustered:  # compaction then moves neither the changes nor the base
                self._write_by_key(rows, target)
            else:
                rows.write.mode("overwrite").options(**K.STORED).parquet(f"{self.path}/{target}")
            counts = seen.get
        changed = sum(counts.values())
        merged_meta = {**(head["meta"] if head else {}), **(meta or {})}
        if changed == 0 and (head is None or merged_meta == head["meta"]):
            return {"version": version - 1, "counts": counts}

        tokens = dict(head["tokens"]) if head else {}
        if token is not None:
            tokens[token[0]] = token[1]
        values = {"counts": counts, "tokens": tokens, "meta": merged_meta}
        if first:
            base = target if changed else None
            values |= {"base": base, "base_rows": changed, "rows": changed, "buckets": buckets}
        else:
            sets, held = head["change_sets"], head["changed_rows"]
            if changed and len(sets) >= FOLD_CHANGE_SETS:
                sets, held = self._fold(head)
            new_sets = [version] if changed else []
            values |= {
                "base": head["base"],
                "buckets": head["buckets"],
                "base_rows": head["base_rows"],
                "change_sets": sets + new_sets,
                "changed_rows": held + changed,
                "rows": head["rows"] + counts["insert"] - counts["delete"],
            }
        return self._publish(version, **values)

    def _fold(self, head: dict) -> tuple[list[str], int]:
        """The newest images of all change sets as one, and their number. The base is not touched."""
        target = f"folded/v={head['version']}"
        rows, seen = observed(self._newest(head), n=F.count(F.lit(1)))
        rows.write.mode("overwrite").options(**K.STORED).parquet(f"{self.path}/{target}")
        return [target], seen.get["n"]

    def needs_compaction(self) -> bool:
        head = self.record()
        if head is None or not head["change_sets"]:
            return False
        return head["changed_rows"] > max(K.BROADCAST_ROWS, MAX_CHANGED_SHARE * head["base_rows"])

    def compact(self) -> dict | None:
        """Write the newest rows as a new base of the same version."""
        head = self.record()
        if head is None or not head["change_sets"]:
            return head
        target = f"base/v={head['version']}"
        # Only changes that do not lie in its buckets are moved; the rows of the old base stay in the tasks
        # that read them, unless the table has outgrown its buckets.
        buckets = head["buckets"]
        name = self._base_name(f"changes/v={head['change_sets'][-1]}")
        if len(head["change_sets"]) == 1 and self.spark.catalog.tableExists(name):
            images = self.spark.table(name).drop(PRE)
        else:
            images = self._newest(head).drop(PRE).repartition(buckets, self.key)
        small = head["changed_rows"] <= K.BROADCAST_ROWS
        rows = apply_change_set(self._read_base(head), images, self.key, small)
        outgrown = self._bucket_count(rows) > 2 * buckets
        if outgrown:
            buckets = self._bucket_count(rows)
        self._write_base(rows, target, buckets, spread=outgrown)
        based = {"base": target, "base_rows": head["rows"], "buckets": buckets, "change_sets": [], "changed_rows": 0}
        self._files.publish_text(f"{self.path}/_commits/{head['version']}.base", json.dumps(based))
        return head | based

    def replace(self, rows: DataFrame, meta: dict | None = None, buckets: int | None = None) -> dict:
        """A new version that holds exactly `rows`, without a change set."""
        head = self.record()
        version = self.version() + 1
        target = f"base/v={version}"
        buckets = buckets or self._bucket_count(rows)
        written = self._write_base(rows, target, buckets, spread=True, n=F.count(F.lit(1)))["n"]
        merged = {**(head["meta"] if head else {}), **(meta or {})}
        return self._publish(
            version, base=target, base_rows=written, rows=written, meta=merged, buckets=buckets, cut=True
        )

    def truncate(self, meta: dict | None = None) -> dict:
        """An empty version. Earlier versions stay readable."""
        return self._publish(self.version() + 1, rows=0, tokens={}, meta=meta or {}, cut=True)

    def restore(self, version: int) -> dict:
        """A new version with the rows of an earlier one, recorded as an ordinary change set.

        Only the keys changed since then are touched: the image before a key's first change after
        `version` is its row at `version`. Across a cut in the
        history (truncate, replace) the two states are compared whole.
        """
        if any(self.record(v)["cut"] for v in self.versions() if v > version):
            then = self.read(version).select(F.col(self.key), F.struct(*self.schema.names).alias("_then"))
            return self.commit(self._towards(then, self.read(), "full"))
        later = self.changes(after=version)
        then = later.groupBy(self.key).agg(F.min_by(PRE, VERSION).alias("_then"))
        now = self.read().join(then.select(self.key), self.key, "left_semi")
        return self.commit(self._towards(then, now, "left"))

    def _towards(self, then: DataFrame, now: DataFrame, how: str) -> DataFrame:
        """The change set that turns the rows `now` into the images `_then`."""
        columns = self.schema.names
        now = now.select(F.col(self.key), F.struct(*columns).alias(PRE))
        both = then.join(now, self.key, how).filter(F.col("_then").isNotNull() | F.col(PRE).isNotNull())
        kind = (
            F.when(F.col("_then").isNull(), "delete").when(F.col(PRE).isNull(), "insert").otherwise("update")
        )
        return both.select(
            self.key,
            *[F.col(f"_then.{c}").alias(c) for c in columns if c != self.key],
            PRE,
            kind.alias(CHANGE_TYPE),
        )
