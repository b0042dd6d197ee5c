"""Outbound feeds: compressed CSV, Parquet, Parquet partitioned by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.session import work_dir
from tidemark.specs import EXPORT_COLUMNS
from tidemark.state.files import SharedFiles

# A gzip-compressed fact row takes a few dozen bytes: what a file is planned with when there is nothing to measure.
MAX_BYTES_PER_ROW = 64
# Rows that are written first to measure how wide they are, and how full files are planned by it.
SAMPLE_ROWS = 5_000
FILL = 0.8
PUBLISHED = "_published"
# Rows of a day that one task writes.
DAY_ROWS = 5_000_000


def rows_per_file(file_bytes: int = K.EXPORT_FILE_BYTES, row_bytes: float = MAX_BYTES_PER_ROW) -> int:
    return max(1, int(file_bytes / row_bytes))


def export_csv(
    fact: DataFrame,
    path: str,
    max_records: int | None = None,
    run_id: str | None = None,
    file_bytes: int = K.EXPORT_FILE_BYTES,
    stored: bool = False,
) -> str:
    """Gzip CSV with header, many files, replacing the target. NULL is nothing, empty text is `""`.

    No file is larger than `file_bytes`: a sample written first says how wide compressed rows are. It is taken
    from written rows (`stored` says that `fact` only reads files; any other plan is written once, so it
    runs once). If rows differ so much that a file still turns out larger, the written rows are exported
    again with fewer rows a file.

    Part files carry a job id; `run_id` puts the run into its own directory instead of replacing, and
    `publish_run` then makes it the one that readers get.
    """
    spark = fact.sparkSession
    target = f"{path}/run={run_id}" if run_id else path
    scratch, files = work_dir(spark, "export"), SharedFiles(spark, target)
    rows = fact.select(*EXPORT_COLUMNS)
    if not stored:
        rows.write.parquet(f"{scratch}/rows")
        rows = spark.read.schema(rows.schema).parquet(f"{scratch}/rows")
    records = max_records or rows_per_file(file_bytes * FILL, _row_bytes(rows, f"{scratch}/sample"))
    while True:
        _write_csv(rows, target, records)
        largest = max(files.sizes(target, ".csv.gz"), default=0)
        if largest <= file_bytes or records == 1:
            break
        records = max(1, min(records // 2, int(records * FILL * file_bytes / largest)))
    SharedFiles(spark, scratch).remove(scratch)
    return target


def _row_bytes(rows: DataFrame, scratch: str) -> float:
    """Bytes of a compressed row, from some rows written as they will be. They are taken from as few tasks as hold
    them: a limit inside the write would run every task of the plan."""
    sample = rows.limit(SAMPLE_ROWS).collect()  # at most SAMPLE_ROWS
    if not sample:
        return MAX_BYTES_PER_ROW
    _write_csv(rows.sparkSession.createDataFrame(sample, rows.schema).coalesce(1), scratch, SAMPLE_ROWS)
    return sum(SharedFiles(rows.sparkSession, scratch).sizes(scratch, ".csv.gz")) / len(sample)


def _write_csv(rows: DataFrame, target: str, records: int) -> None:
    (
        rows.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records)
        .csv(target)
    )


def publish_run(spark: SparkSession, path: str, run_id: str) -> None:
    """Make a complete run the newest one of an export: a small file written last, under the next number."""
    files = SharedFiles(spark, path)
    number = max([int(n.partition("-")[0]) for n in _pointers(files, path)], default=0) + 1
    files.publish_text(f"{path}/{PUBLISHED}/{number:08d}-{run_id}", run_id)


def published_runs(spark: SparkSession, path: str) -> list[str]:
    """The complete runs of an export, oldest first."""
    return [n.partition("-")[2] for n in _pointers(SharedFiles(spark, path), path)]


def _pointers(files: SharedFiles, path: str) -> list[str]:
    return sorted(n for n in files.names(f"{path}/{PUBLISHED}") if not n.startswith(".") and not n.endswith(".draft"))


def read_export(spark: SparkSession, path: str, schema, run_id: str | None = None, multi_line: bool = True) -> DataFrame:
    """An exported CSV directory, read back by position with the given types: of published runs the newest, or `run_id`.

    The unused null token keeps a quoted empty text apart from a missing value. Without `multi_line`, for
    exports whose fields hold no line breaks, lines are records.
    """
    runs = [run_id] if run_id else published_runs(spark, path)
    if runs:
        path = f"{path}/run={runs[-1]}"
    dialect = {"header": "true", "escape": '"', "nullValue": "\0", "emptyValue": "", "multiLine": str(multi_line).lower()}
    return spark.read.schema(schema).options(**dialect).csv(path)


def export_parquet(fact: DataFrame, path: str, dt: str | None = None) -> str:
    """All columns as Parquet, into a dated directory if `dt` is given."""
    target = f"{path}/dt={dt}" if dt else path
    fact.write.mode("overwrite").parquet(target)
    return target


def export_by_date(
    fact: DataFrame, path: str, column: str = "BOOKING_DATE", whole: bool = False, stored: bool = False, task_rows: int = DAY_ROWS
) -> str:
    """Parquet partitioned by day; only the days present in `fact` are replaced. With `whole`, `fact` is
    all there is, and days that it no longer holds leave the export too.

    The cost is the files, not the bytes, so days are dealt over all tasks, few files each. A day of more than
    `task_rows` rows, counted first from written rows (`stored` says that `fact` only reads files; any
    other plan is written once), is dealt over several.
    """
    spark = fact.sparkSession
    scratch = work_dir(spark, "export")
    dated = fact.withColumn("dt", F.col(column).cast("string"))
    if not stored:
        dated.write.parquet(f"{scratch}/rows")
        dated = spark.read.schema(dated.schema).parquet(f"{scratch}/rows")
    days = dated.groupBy("dt").agg(F.count("*").alias("n")).filter(F.col("n") > task_rows)
    heavy = days.select(F.coalesce("dt", F.lit("")).alias("_day"), F.ceil(F.col("n") / task_rows).alias("_parts"))
    extra = heavy.agg(F.coalesce(F.sum("_parts"), F.lit(0))).first()[0]
    tasks, part = int(spark.conf.get("spark.sql.shuffle.partitions")) + extra, F.lit(0)
    if extra:  # at most one row for every `task_rows` rows
        dated = dated.withColumn("_day", F.coalesce("dt", F.lit(""))).join(F.broadcast(heavy), "_day", "left")
        part = F.coalesce(F.pmod(F.xxhash64(*fact.columns), F.col("_parts")), F.lit(0).cast("long"))
    (
        dated.repartition(tasks, "dt", part)
        .select(*fact.columns, "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )
    SharedFiles(spark, scratch).remove(scratch)
    return path
