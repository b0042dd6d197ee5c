"""Reading, held-out folds, materialising and streaming helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructType

from tidemark.session import shared_dir

FOLDS = 5


#: documents can be long: a Python worker gets at most so many rows and bytes at once
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1024", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}

#: environment of Python workers: give freed memory back instead of keeping it for the next task
WORKER = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "262144", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def prepare(spark: SparkSession) -> None:
    """Bound the batches that Python workers get, where the session does not say otherwise; have the
    workers return freed memory; and let workers on this machine import the package, wherever the driver
    was started. A cluster gets the package with --py-files or installed."""
    for key, value in BATCH.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    for key, value in WORKER.items():
        environment.setdefault(key, value)
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, columns: list[str]) -> str:
    """A column name like `name` that no column has, whatever the case of its letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5. Null for a null id."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % FOLDS).cast("int")


def is_held_out(doc_id: Column) -> Column:
    """Whether the row belongs to the fold that nothing learns from (a null id does not)."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def materialise(df: DataFrame) -> DataFrame:
    """Compute once, into the checkpoint folder that all executors share."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def utf8(text: Column) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def utf8_list(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8; nulls are empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def arrow_type(kind: DataType) -> pa.DataType:
    return to_arrow_type(kind)


def batch_of(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    """Rows as one Arrow batch of the schema."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=arrow_type(f.dataType)) for c, f in zip(columns, schema, strict=True)], names=schema.names)


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Re-cut batches that are sorted by a long column without nulls, so that no value is divided."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        elif held and held[-1].column(key)[-1].as_py() != keys[-1]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose sizes add up to at most the limit, or single rows."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)
