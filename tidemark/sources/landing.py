"""Landing files as DataFrames: batch and streaming, CSV and Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.scalars import as_timestamp, blank_to_null
from tidemark.specs import EntitySpec
from tidemark.state.files import SharedFiles

# The landing format. One header line, bound by position, not by name.
CSV_READ = {
    "sep": ",",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "enforceSchema": "true",
}


def entity_glob(landing: str, spec: EntitySpec, prefix: str = "*") -> str:
    """Files of one entity below a landing prefix: `<prefix>/booking_x.csv` or `<prefix>/booking/part.csv`."""
    return f"{landing.rstrip('/')}/{prefix.strip('/')}/*{spec.name}*"


def read_landing(
    spark: SparkSession,
    landing: str,
    spec: EntitySpec,
    prefix: str = "*",
    fmt: str = "csv",
    load_ts=None,
    path_pattern: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All files of an entity, whether read before or not; no rows if there are none."""
    glob = entity_glob(landing, spec, prefix)
    if not SharedFiles(spark, landing).matches(glob):
        return spark.createDataFrame([], spec.raw_schema)
    rows = _prepared(spark.read, spec, fmt, multi_line).load(glob)
    return _raw_rows(rows, spark, landing, spec, load_ts, path_pattern)


def stream_landing(
    spark: SparkSession,
    landing: str,
    spec: EntitySpec,
    prefix: str = "*",
    fmt: str = "csv",
    load_ts=None,
    max_files: int | None = None,
    path_pattern: str | None = None,
    multi_line: bool = False,
    archive: str | None = None,
    max_file_age: str | None = None,
) -> DataFrame:
    """New files of an entity; the stream's checkpoint remembers what was read.

    `archive`: a folder outside the landing folder that read files are moved to, under their whole path, when the
    batch after theirs begins: what is listed then is what is new or was read last. `max_file_age` (such as
    "14d") bounds the memory of names: older names, counted from the newest file seen, are forgotten, and
    a file that lands under such a name is read again.
    """
    reader = _prepared(spark.readStream, spec, fmt, multi_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    rows = reader.load(entity_glob(landing, spec, prefix))
    return _raw_rows(rows, spark, landing, spec, load_ts, path_pattern)


def _prepared(reader, spec: EntitySpec, fmt: str, multi_line: bool):
    names = "*.csv{,.gz}" if fmt == "csv" else f"*.{fmt}"  # CSV may land compressed
    reader = reader.format(fmt).schema(spec.file_schema).option("pathGlobFilter", names)
    if fmt == "csv":
        reader = reader.options(**CSV_READ).option("multiLine", multi_line)
    return reader


def _raw_rows(rows, spark, landing, spec, load_ts, path_pattern) -> DataFrame:
    # the metadata hold an encoded URI, in which a plus stands for itself; most have nothing to decode
    uri = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    path = F.when(uri.contains("%"), decoded).otherwise(uri)
    columns = [blank_to_null(F.col(c)).alias(c) for c in spec.file_columns]
    raw = rows.select(
        *columns,
        _below_root(path, SharedFiles(spark, landing).qualified(landing)).alias(K.SRC_FILE),
        as_timestamp(load_ts).alias(K.LOAD_TS),
    )
    return raw.filter(F.col(K.SRC_FILE).rlike(path_pattern)) if path_pattern else raw


def _below_root(path: Column, root: str) -> Column:
    """File path below the landing root, whatever the number of slashes after the scheme."""
    folder = root.partition(":")[2].strip("/") + "/"
    found = F.locate(folder, path)
    return F.when(found > 0, F.substr(path, found + len(folder))).otherwise(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and time of every file below `path`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", "modificationTime")


def file_states(spark: SparkSession, landing: str, audit: DataFrame) -> DataFrame:
    """Every landing file with its size and time, and what the load audit has of it: rows and load time, both
    unknown for a file that was not loaded (or had no rows)."""
    root = SharedFiles(spark, landing).qualified(landing)
    listed = list_files(spark, landing).select(
        _below_root(F.col("path"), root).alias(K.SRC_FILE), F.col("length").alias("LENGTH"), F.col("modificationTime").alias("LANDED_AT"))
    loaded = audit.groupBy(K.SRC_FILE).agg(F.max("LOADED_AT").alias("LOADED_AT"), F.max("ROWS_READ").alias("ROWS_READ"))
    return listed.join(loaded, K.SRC_FILE, "left")


def unloaded_files(spark: SparkSession, landing: str, audit: DataFrame) -> DataFrame:
    """Landing files that the load audit does not know: name, size, time."""
    states = file_states(spark, landing, audit)
    return states.filter(F.col("LOADED_AT").isNull()).drop("LOADED_AT", "ROWS_READ")
