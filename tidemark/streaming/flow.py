"""The layers as one flow: landing files -> raw -> silver -> gold -> export and checks.

    <root>/raw/<entity>         the batch being applied, empty in between
    <root>/silver/<entity>      current state, one row per key (VersionedTable)
    <root>/gold/booking_fact    business fact (VersionedTable)
    <root>/util/...             run log, quality results, load audit, rows set aside
    <root>/checkpoints/...      what each stream has read
"""

from __future__ import annotations

import json
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import constants as K
from tidemark.operators.changes import change_rows, change_set, changed_keys
from tidemark.operators.latest import newest_changes
from tidemark.operators.typing import split_rejects, typed
from tidemark.plans import gold, quality
from tidemark.session import prepare
from tidemark.sinks.export import export_csv, publish_run
from tidemark.functions.scalars import session_now
from tidemark.sources.landing import file_states, read_landing, stream_landing
from tidemark.specs import ENTITIES, FACT_KEY, FACT_SCHEMA, SAFE, EntitySpec, Policy
from tidemark.state.files import SharedFiles
from tidemark.state.table import VersionedTable, observed

LOG_SCHEMA = "LOG_TS timestamp_ntz, STEP string, TARGET string, ROWS_AFFECTED long, NOTE string"


class Flow:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        landing: str,
        policy: Policy = SAFE,
        entities: tuple[EntitySpec, ...] = ENTITIES,
        run_ts: datetime | None = None,
        fmt: str = "csv",
        max_files: int | None = None,
        path_pattern: str | None = None,
        multi_line: bool = False,
        archive: str | None = None,
        max_file_age: str | None = None,
    ):
        """`path_pattern` cuts landing files by their path below the landing folder; `multi_line` reads CSV
        fields with line breaks; `archive` takes the files that streams have read, `max_file_age` bounds
        how long streams remember names."""
        prepare(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.landing = landing
        self.policy = policy
        self.entities = entities
        self.run_ts = run_ts
        self.fmt = fmt
        self.max_files = max_files
        self.reading = {"path_pattern": path_pattern, "multi_line": multi_line}
        self.retiring = {"archive": archive, "max_file_age": max_file_age}
        self.silver = {
            e.name: VersionedTable(spark, f"{self.root}/silver/{e.name}", e.key, e.state_schema, looked_up=(e.parent_key,))
            for e in entities
        }
        self.fact = VersionedTable(spark, f"{self.root}/gold/booking_fact", FACT_KEY, FACT_SCHEMA)
        self._files = SharedFiles(spark, self.root)
        self._gold_lock = threading.RLock()

    # ---- raw -> silver -------------------------------------------------------------------

    def apply_batch(self, spec: EntitySpec, batch: DataFrame, token: tuple[str, int] | None = None) -> dict:
        """Take one batch of raw rows into silver; a batch delivered again is skipped."""
        table = self.silver[spec.name]
        if table.seen(token):
            self._clear_raw(spec)
            return {"version": table.version(), "counts": {}}

        # The written batch is the input of every step below, so no step reads the source again.
        batch.write.mode("overwrite").options(**K.PASSING).parquet(self._raw_path(spec))
        raw = self.raw(spec)
        self._audit(spec, raw, token)

        record = self.merge_batch(spec, raw, token)
        self._clear_raw(spec)
        counts = record["counts"]
        merged = counts["insert"] + counts["update"]
        self._log("RAW->SILVER", f"SILVER.{spec.name.upper()}", merged, "raw truncated")
        return record

    def merge_batch(self, spec: EntitySpec, raw: DataFrame, token: tuple[str, int] | None = None) -> dict:
        """Merge raw rows into the silver table: newest change per key, then one commit."""
        table = self.silver[spec.name]
        newest = newest_changes(typed(raw, spec, self.policy, self.run_ts), spec)
        if table.is_empty():
            record = table.commit(change_set(None, newest, spec), token, clustered=True)
        else:
            staged, rows = table.stage(newest, clustered=True)
            by_key = False
            if rows <= K.LISTED_KEYS:
                keys = [r[0] for r in staged.select(spec.key).collect()]  # at most LISTED_KEYS
                changes = change_set(table.read_keys(keys), staged, spec, self.policy.guard)
            else:
                lookup = "broadcast" if rows <= K.BROADCAST_ROWS else "pick"
                by_key = lookup == "pick" and table.aligned(staged)
                if by_key and not table.record()["change_sets"]:
                    lookup = "buckets"
                changes = change_set(table.read(), staged, spec, self.policy.guard, lookup)
            record = table.commit(changes, token, clustered=by_key)
            table.unstage()
        if table.needs_compaction():
            table.compact()
        return record

    def raw(self, spec: EntitySpec) -> DataFrame:
        """The batch being applied; empty in between."""
        if not self._files.exists(self._raw_path(spec)):
            return self.spark.createDataFrame([], spec.raw_schema)
        return self.spark.read.schema(spec.raw_schema).parquet(self._raw_path(spec))

    def _raw_path(self, spec: EntitySpec) -> str:
        return f"{self.root}/raw/{spec.name}"

    def _clear_raw(self, spec: EntitySpec) -> None:
        self._files.remove(self._raw_path(spec))

    def _audit(self, spec: EntitySpec, raw: DataFrame, token: tuple[str, int] | None) -> None:
        # Named by the batch: a batch delivered again replaces its own audit rows.
        batch = "-".join(map(str, token)) if token else uuid.uuid4().hex
        path = f"{self.root}/util/load_audit/{spec.name}/batch={batch}"
        audit, seen = observed(quality.load_audit(raw, spec, self.policy, loaded_at=True), rejected=F.sum("ROWS_REJECTED"))
        audit.write.mode("overwrite").parquet(path)
        if not seen.get["rejected"]:
            return
        _, rejected = split_rejects(raw, spec, self.policy)
        rejected.write.mode("overwrite").parquet(f"{self.root}/util/quarantine/{spec.name}/batch={batch}")

    def load(self, prefix: str) -> None:
        """Apply all files below a landing prefix, whether read before or not, as one batch each."""
        landing = {
            e: read_landing(self.spark, self.landing, e, prefix, self.fmt, self.run_ts, **self.reading) for e in self.entities
        }
        self._side_by_side(self.apply_batch, landing)

    def merge_all(self, batches: dict[EntitySpec, DataFrame]) -> None:
        """Merge one batch per feed, given as raw rows of any origin."""
        self._side_by_side(self.merge_batch, batches)

    @staticmethod
    def _side_by_side(step, batches: dict[EntitySpec, DataFrame]) -> None:
        """The feeds share no table, so their Spark jobs may run at the same time."""
        with ThreadPoolExecutor(len(batches)) as pool:
            for done in [pool.submit(step, spec, rows) for spec, rows in batches.items()]:
                done.result()

    # ---- silver -> gold ------------------------------------------------------------------

    def refresh_gold(self) -> dict | None:
        """Refresh the fact for the bookings changed since its last refresh; None if nothing changed."""
        with self._gold_lock:
            offsets = self._offsets()
            upto = {name: table.version() for name, table in self.silver.items()}
            watched = self.silver if self.policy.all_sources else {"booking": self.silver["booking"]}
            changed_rows = sum(t.changed_rows(offsets[n], upto[n]) for n, t in watched.items())
            if changed_rows == 0:
                return None

            run_ts = self.run_ts
            sets = {n: t.changes(offsets[n], upto[n]) for n, t in watched.items()}
            small = 2 * changed_rows <= K.BROADCAST_ROWS
            keys = changed_keys(sets, self.policy.all_sources)
            keys_path = f"{self.root}/util/changed_keys/{uuid.uuid4().hex}"
            first = self.fact.is_empty()
            # Every live booking is wanted, so no key is asked for: one that was live before and has not
            # changed since would be in the fact already.
            if small and not first:
                keys = keys.persist(StorageLevel.MEMORY_AND_DISK)
            elif not first:  # several joins read them
                keys.write.options(**K.STORED).parquet(keys_path)
                keys = self.spark.read.parquet(keys_path)
            try:
                listed = None
                if 2 * changed_rows <= K.LISTED_KEYS and not first and self.policy.all_sources:
                    listed = [r[0] for r in keys.collect()]  # at most LISTED_KEYS
                tables = [(self.silver[e.name], upto[e.name]) for e in self.entities]
                if listed is None:
                    booking, reservation, claim = (t.read(v) for t, v in tables)
                    fact = None if first else self.fact.read()
                else:
                    booking, reservation, claim = (t.read_keys(listed, v, FACT_KEY) for t, v in tables)
                    fact = self.fact.read_keys(listed)
                narrowed = None if first else keys
                live = gold.booking_fact(booking, reservation, claim, narrowed, small, run_ts)
                if self.policy.all_sources:
                    changes = gold.fact_changes(fact, live, keys, small)
                else:
                    changes = gold.fact_changes_as_delivered(fact, live, booking)
                # a fact has at most one row per booking, so it takes the buckets of the bookings
                buckets = self._booking_buckets()
                # many changes come from joins by booking: a task writes few buckets, and compaction moves none
                by_key = not first and not small and self.fact.in_whole_buckets()
                record = self.fact.commit(changes, meta={"offsets": upto}, clustered=by_key, buckets=buckets)
            finally:
                if small:
                    keys.unpersist()
                else:
                    self._files.remove(keys_path)
            if self.fact.needs_compaction():
                self.fact.compact()
            counts = record["counts"]
            stream_rows = sum(t.stream_rows(offsets[n], upto[n]) for n, t in watched.items())
            note = f"change rows: {stream_rows}, changed keys: {sum(counts.values())}"
            self._log("SILVER->GOLD", "GOLD.BOOKING_FACT", counts["insert"] + counts["update"], note)
            return record

    def rebuild_gold(self) -> dict:
        """The fact and its daily summary rebuilt from silver, whatever changed."""
        with self._gold_lock:
            upto = {name: table.version() for name, table in self.silver.items()}
            booking, reservation, claim = (self.silver[e.name].read(upto[e.name]) for e in self.entities)
            fact = gold.booking_fact(booking, reservation, claim, run_ts=self.run_ts)
            record = self.fact.replace(fact, {"offsets": upto}, self._booking_buckets())
            summary = gold.daily_route_summary(self.fact.read())
            summary.write.mode("overwrite").parquet(self._summary_path(record["version"]))
            self._log("SILVER->GOLD", "GOLD.BOOKING_FACT", record["rows"], "rebuilt")
            return record

    def daily_route_summary(self) -> DataFrame:
        """The stored summary of the newest fact if a rebuild wrote one, else computed from the fact."""
        stored = self._summary_path(self.fact.version())
        if self._files.exists(f"{stored}/_SUCCESS"):
            return self.spark.read.parquet(stored)
        return gold.daily_route_summary(self.fact.read())

    def refresh_daily_route(self) -> DataFrame:
        """The stored daily aggregate, brought up to the newest fact, with the share at risk.

        Only bookings that changed since its last refresh are read: their images before are taken off, those
        after are added. After a rebuild or reset of the fact, which leave no images, it is computed anew.
        """
        with self._gold_lock:
            folder = f"{self.root}/gold/daily_route"
            done = [int(n[2:]) for n in self._files.names(folder) if self._files.exists(f"{folder}/{n}/_SUCCESS")]
            held, upto = max(done, default=0), self.fact.version()
            if held < upto:
                since = [v for v in self.fact.versions() if v > held]
                if held == 0 or any(self.fact.record(v)["cut"] for v in since):
                    totals = gold.daily_totals(self.fact.read(upto))
                else:
                    images = change_rows(self.fact.net_changes(held, upto))
                    totals = gold.maintained_totals(self.spark.read.parquet(f"{folder}/v={held}"), images)
                totals.write.mode("overwrite").parquet(f"{folder}/v={upto}")
            if upto == 0:
                return gold.with_share(gold.totals_shown(gold.daily_totals(self.fact.read())))
            return gold.with_share(gold.totals_shown(self.spark.read.parquet(f"{folder}/v={upto}")))

    def _summary_path(self, version: int) -> str:
        return f"{self.root}/gold/daily_route_summary/v={version}"

    def _booking_buckets(self) -> int | None:
        record = self.silver["booking"].record()
        return record["buckets"] if record else None

    def _offsets(self) -> dict[str, int]:
        head = self.fact.record()
        return (head["meta"].get("offsets") if head else None) or dict.fromkeys(self.silver, 0)

    def has_changes(self) -> bool:
        """Whether silver holds changes that gold has not taken in."""
        offsets = self._offsets()
        return any(t.changed_rows(offsets[n]) for n, t in self.silver.items())

    # ---- gold -> outside -----------------------------------------------------------------

    def export(self) -> str:
        """Write the fact as a run of its own and make it the one that readers of the folder get."""
        record = self.fact.record()
        version = record["version"] if record else 0  # a refresh meanwhile is not part of this export
        path, run = f"{self.root}/outbound/booking_fact", f"{version}-{uuid.uuid4().hex}"
        export_csv(self.fact.read(version) if record else self.fact.read(), path, run_id=run, stored=True)
        publish_run(self.spark, path, run)
        self._log("GOLD->OUTBOUND", "booking_fact", record["rows"] if record else 0, "unload ok")
        self._files.publish_text(f"{self.root}/util/exports/{uuid.uuid4().hex}-{version}", path)
        return path

    def needs_export(self) -> bool:
        """Whether the fact is newer than its last export, also after a run that broke off between."""
        exported = [int(n.rsplit("-", 1)[1]) for n in self._files.names(f"{self.root}/util/exports") if "." not in n]
        return max(exported, default=0) < self.fact.version()

    def run_quality(self, rules: list = quality.PIPELINE_RULES) -> DataFrame:
        """Run the rules, append their results, return this run's rows."""
        results = quality.run_rules(self.tables(), rules, self.run_ts or session_now(self.spark))
        path = f"{self.root}/util/dq_results/run={uuid.uuid4().hex}"
        results.coalesce(1).write.parquet(path)
        return self.spark.read.parquet(path)

    def freshness(self) -> DataFrame:
        """Lag of every silver table and of the fact."""
        watched = {f"SILVER.{n.upper()}": (t.read(), K.UPDATED_AT) for n, t in self.silver.items()}
        watched[quality.GOLD_FACT] = (self.fact.read(), K.LOAD_TS)
        return quality.freshness(watched, self.run_ts or session_now(self.spark))

    def quality_history(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/util/dq_results").drop("run")

    def tables(self) -> dict[str, DataFrame]:
        fact = self.fact.read()
        named = {f"SILVER.{n.upper()}": t.read() for n, t in self.silver.items()}
        return {**named, quality.GOLD_FACT: fact, quality.GOLD_DAILY: gold.daily_route_summary(fact)}

    def register_views(self) -> None:
        """SQL names for the current tables: silver_booking, ..., gold_booking_fact, v_daily_route."""
        for name, table in self.silver.items():
            table.read().createOrReplaceTempView(f"silver_{name}")
        fact = self.fact.read()
        fact.createOrReplaceTempView("gold_booking_fact")
        gold.daily_route(fact).createOrReplaceTempView("v_daily_route")

    # ---- runs ----------------------------------------------------------------------------

    def run_available(self) -> dict | None:
        """Everything new, once: ingest the three feeds, refresh gold, export, check."""
        self.ingest_available()
        record = self.refresh_gold()
        if self.needs_export():
            self.export()
            self.run_quality()
        return record

    def ingest_available(self, *entities: EntitySpec) -> None:
        """Everything new of the given feeds (all by default) into silver. The feeds run side by side."""
        queries = [self._start_one(e, {"availableNow": True}) for e in entities or self.entities]
        for query in queries:
            query.awaitTermination()

    def start_continuous(
        self, interval: str = K.TRIGGER_INTERVAL, gold_interval: str | None = None, export_interval: str | None = None
    ) -> list[StreamingQuery]:
        """One running query per feed, one that refreshes gold and one that exports it, each at its own
        pace: ingest never waits for a refresh, nor a refresh for an export."""

        def export_newer() -> None:
            if self.needs_export():
                self.export()

        feeds = self.start_feeds(interval).values()
        gold_query = self._every(gold_interval or interval, self.refresh_gold, "refresh")
        return [*feeds, gold_query, self._every(export_interval or interval, export_newer, "export")]

    def start_feeds(self, interval: str = K.TRIGGER_INTERVAL) -> dict[str, StreamingQuery]:
        """One running query per feed, which takes in what has landed since its last trigger."""
        return {e.name: self._start_one(e, {"processingTime": interval}) for e in self.entities}

    def arrive(self, folder: str, prefix: str) -> None:
        """Let a complete folder land as a prefix, by one rename: no trigger sees a part of it."""
        self._files.move(folder, f"{self.landing.rstrip('/')}/{prefix}")

    def archived(self) -> str:
        """The landing folder as the archive of read files mirrors it."""
        archive = self.retiring["archive"]
        return archive.rstrip("/") + "/" + self._files.qualified(self.landing).partition(":")[2].lstrip("/")

    def feed_progress(self, queries: dict[str, StreamingQuery]) -> DataFrame:
        """FEED, BATCH, ROWS of the triggers that read rows, as the running queries report them (Spark
        keeps the newest `spark.sql.streaming.numRecentProgressUpdates` reports of each)."""
        rows = [(name, p.batchId, p.numInputRows) for name, q in queries.items() for p in q.recentProgress if p.numInputRows]
        return self.spark.createDataFrame(rows, "FEED string, BATCH long, ROWS long")

    def _every(self, interval: str, step, label: str) -> StreamingQuery:
        """Run a step at intervals, as a streaming query that can be watched and stopped like the feeds."""
        ticks = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        return (
            ticks.writeStream.foreachBatch(lambda rows, n: step() and None)
            .option("checkpointLocation", f"{self.root}/checkpoints/timers/{label}-{uuid.uuid4().hex}")
            .trigger(processingTime=interval)
            .start()
        )

    def _start_one(self, spec: EntitySpec, trigger: dict) -> StreamingQuery:
        checkpoint = f"{self.root}/checkpoints/{self._generation()}/{spec.name}"

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            self.apply_batch(spec, batch, (self._feed_id(checkpoint), batch_id))

        rows = stream_landing(
            self.spark, self.landing, spec, fmt=self.fmt, load_ts=self.run_ts, max_files=self.max_files, **self.reading, **self.retiring
        )
        return (
            rows.writeStream.foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    def _feed_id(self, checkpoint: str) -> str:
        """The id Spark keeps in the checkpoint: the same after a restart, new for a new checkpoint."""
        return json.loads(self._files.read_text(f"{checkpoint}/metadata"))["id"]

    def _generation(self) -> int:
        return len([n for n in self._files.names(f"{self.root}/util/resets") if n.isdigit()])

    def reset(self) -> None:
        """Empty every layer. Quality results and earlier versions stay; files are read anew."""
        for spec in self.entities:
            self._clear_raw(spec)
            self.silver[spec.name].truncate()
        self.fact.truncate({"offsets": {name: table.version() for name, table in self.silver.items()}})
        self._files.publish_text(f"{self.root}/util/resets/{self._generation() + 1}", "")

    def replay(self, full_prefix: str = "fullload", delta_prefix: str = "cdc") -> DataFrame:
        """From nothing: full load, changes, export, checks. Returns the check results."""
        self.reset()
        for prefix in (full_prefix, delta_prefix):
            self.load(prefix)
            self.refresh_gold()
        self.export()
        return self.run_quality()

    # ---- log -----------------------------------------------------------------------------

    def _log(self, step: str, target: str, rows: int, note: str) -> None:
        line = {
            "LOG_TS": (self.run_ts or session_now(self.spark)).isoformat(sep=" "),
            "STEP": step,
            "TARGET": target,
            "ROWS_AFFECTED": rows,
            "NOTE": note,
        }
        self._files.publish_text(f"{self._log_path()}/{uuid.uuid4().hex}.json", json.dumps(line))

    def _log_path(self) -> str:
        return f"{self.root}/util/pipeline_log/{self._generation()}"

    def run_log(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).json(self._log_path(), pathGlobFilter="*.json")

    def load_audit(self) -> DataFrame:
        folders = [f"{self.root}/util/load_audit/{e.name}" for e in self.entities]
        return self.spark.read.parquet(*[f"{f}/*" for f in folders if self._files.exists(f)])

    def file_states(self) -> DataFrame:
        """Every landing file, and what the load audit has of it."""
        return file_states(self.spark, self.landing, self.load_audit())

    def quarantine(self, spec: EntitySpec) -> DataFrame:
        schema = spec.raw_schema.add("REJECT_REASON", "string")
        folder = f"{self.root}/util/quarantine/{spec.name}"
        if not self._files.exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{folder}/*")
