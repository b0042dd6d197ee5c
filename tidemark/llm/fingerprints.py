"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Every paragraph (line, as split by \\n) is hashed to a wide vector; the vectors of a text are added,
lane by lane, modulo powers of two. The sum does not depend on the order of paragraphs; adding or
subtracting a paragraph's vector inserts or deletes it, so a fingerprint is kept up to date without
the text. The vector has two parts:

* `LANES` lanes modulo 2^64 from a cryptographic hash of the paragraph, for equality;
* `CELLS` cells modulo 2^32, into which the paragraph's word triples are counted with random signs
  (lone words and pairs too, where a paragraph has fewer), for likeness: inner products of these
  estimate how many triples two texts share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidemark.llm.common import arrow_type, prepare, table
from tidemark.llm.rolling import Words, family

LANES = 8
CELLS = 256
RUN = 3
#: rows that are put in order together; see neighbours()
ROWS_PER_RANGE = 4096
_LINE_BYTES = 1 << 20


def paragraph_lanes(paragraph: bytes) -> np.ndarray:
    """The equality part of a paragraph's vector."""
    return np.frombuffer(hashlib.blake2b(paragraph, digest_size=8 * LANES).digest(), dtype="<u8")


def _cells(paragraphs: list[bytes]) -> np.ndarray:
    """The likeness part of the summed vectors of some paragraphs."""
    words = Words([p.split() for p in paragraphs])
    out = np.zeros(CELLS, dtype=np.int64)
    if not len(words):
        return out.astype(np.uint32)
    prefix = family(0).prefix(words.data)
    left = words.first[words.text_of + 1] - np.arange(len(words))
    length = np.minimum(left, RUN)
    # runs cut short by the end of their paragraph count only where the paragraph has no full one
    use = (length == RUN) | ((words.counts[words.text_of] < RUN) & (words.first[words.text_of] == np.arange(len(words))))
    at = np.flatnonzero(use)
    h = family(0).runs(prefix, words.start[at], words.end[at + length[at] - 1])
    sign = np.where((h >> np.uint64(63)).astype(bool), 1.0, -1.0)
    out += np.bincount((h % np.uint64(CELLS)).astype(np.int64), weights=sign, minlength=CELLS).astype(np.int64)
    return (out & 0xFFFFFFFF).astype(np.uint32)


class Fingerprint:
    """The sum of paragraph vectors, with insertion, deletion, merging and likeness."""

    def __init__(self, lanes: np.ndarray | None = None, cells: np.ndarray | None = None):
        self.lanes = np.zeros(LANES, dtype=np.uint64) if lanes is None else lanes
        self.cells = np.zeros(CELLS, dtype=np.uint32) if cells is None else cells

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        return cls().insert(*text.split("\n"))

    @classmethod
    def from_hex(cls, hexed: str) -> Fingerprint:
        data = bytes.fromhex(hexed)
        return cls(np.frombuffer(data[: 8 * LANES], dtype="<u8").copy(), np.frombuffer(data[8 * LANES :], dtype="<u4").copy())

    def hex(self) -> str:
        return self.lanes.astype("<u8").tobytes().hex() + self.cells.astype("<u4").tobytes().hex()

    def insert(self, *paragraphs: str) -> Fingerprint:
        return self._change(paragraphs, 1)

    def delete(self, *paragraphs: str) -> Fingerprint:
        return self._change(paragraphs, -1)

    def merge(self, other: Fingerprint) -> Fingerprint:
        """The fingerprint of both multisets together."""
        return Fingerprint(self.lanes + other.lanes, self.cells + other.cells)

    def _change(self, paragraphs: tuple[str, ...], sign: int) -> Fingerprint:
        data = [p.encode() for p in paragraphs]
        if not data:
            return self
        lanes = np.stack([paragraph_lanes(p) for p in data]).sum(axis=0, dtype=np.uint64)
        cells, size, held = np.zeros(CELLS, dtype=np.uint32), 0, []
        for p in data:  # many paragraphs are hashed in pieces of bounded size
            held.append(p)
            size += len(p)
            if size > _LINE_BYTES:
                cells, size, held = cells + _cells(held), 0, []
        cells = cells + _cells(held) if held else cells
        if sign < 0:
            return Fingerprint(self.lanes - lanes, self.cells - cells)
        return Fingerprint(self.lanes + lanes, self.cells + cells)

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints, else the estimated share of common word triples, 0 to 1."""
        if (self.lanes == other.lanes).all() and (self.cells == other.cells).all():
            return 1.0
        a, b = (x.cells.astype(np.int32).astype(np.float64) for x in (self, other))
        size = float(a @ a + b @ b)
        return min(1.0, max(0.0, 2 * float(a @ b) / size)) if size else 0.0


def neighbours(docs: DataFrame, text: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(doc_id, body, guest, part): rows dealt into ranges of descending doc_id and sorted in them.
    The first row of each range is also, as a guest, the last of the range before; the very first that
    of the last range. So each row's next row follows it in its task. Texts are shuffled once."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("body"))
    total = rows.count()
    ranges = max(1, -(-total // rows_per_range))
    cuts: list = []
    if total:
        # quantiles of the ids; the number of ranges bounds what comes back
        share = [i / ranges for i in range(1, ranges + 1)]
        got = rows.select(F.percentile_approx("doc_id", share, max(10_000, 20 * ranges)).alias("q"), F.max("doc_id").alias("top")).first()
        cuts = sorted({*(q for q in got.q or []), got.top} - {None}, reverse=True)
    spread = spark.sparkContext.broadcast(np.array(sorted(cuts)))
    n = max(1, len(cuts))

    @F.pandas_udf("array<struct<part:int,guest:boolean>>")
    def deal(ids: pd.Series, with_id: pd.Series) -> pd.Series:
        low = spread.value  # ascending; range k holds the ids above its successor's cut, up to its own
        known = with_id.to_numpy()
        values = ids.to_numpy()
        part, first = np.full(len(ids), n - 1), np.zeros(len(ids), dtype=bool)
        if len(low) and known.any():
            of = values[known].astype(low.dtype)
            at = np.searchsorted(low, of, side="left")
            part[known] = n - 1 - np.minimum(at, n - 1)
            first[known] = low[np.minimum(at, n - 1)] == of
        return pd.Series([
            [{"part": p, "guest": False}, {"part": (p - 1) % n, "guest": True}] if f else [{"part": p, "guest": False}]
            for p, f in zip(part.tolist(), first.tolist(), strict=True)])

    dealt = rows.withColumn("to", F.explode(deal(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNotNull()))).select("doc_id", "body", F.col("to.part").alias("part"), F.col("to.guest").alias("guest"))
    return dealt.repartitionById(n, F.col("part")).sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), F.xxhash64("body"))


def edited_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, with the next document in descending doc_id (after the last: the first) as source of
    the edit: the last third of the text is replaced by as many first characters of the next.

    Ids are numbers. Null texts are empty. Rows with equal ids follow one another by a hash of their texts; rows
    without id come last. A lone row is its own next. An empty table gives no rows; without any id,
    rows follow one another by hash and the last has itself as next. Only doc_id and the text are read.
    """
    prepare(docs.sparkSession)
    schema = StructType([
        docs.schema["doc_id"], StructField("n_chars", LongType()), StructField("edited_sha256", StringType()), StructField("fingerprint", StringType()),
        StructField("edited_fingerprint", StringType()), StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())])

    def row(doc, text: str, own: Fingerprint, following: str, following_print: Fingerprint) -> tuple:
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        changed = Fingerprint.of(edited) if edited != text else own
        return (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.hex(), changed.hex(),
                own.likeness(changed), own.likeness(following_print))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done, last_part = None, False, None
        for batch in batches:
            out = {name: [] for name in schema.names}

            def put(values: tuple, out=out) -> None:
                for name, value in zip(schema.names, values, strict=True):
                    out[name].append(value)

            for doc, body, part, guest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != last_part and held is not None and not done:
                    put(row(*held, *held[1:]))
                if part != last_part:
                    held, done, last_part = None, False, part
                if done:
                    continue
                mark = Fingerprint.of(body)
                if held is not None:
                    put(row(*held, body, mark))
                held, done = (doc, body, mark), guest
            yield _batch(out)
        if held is not None and not done:
            out = {name: [] for name in schema.names}
            for name, value in zip(schema.names, row(*held, *held[1:]), strict=True):
                out[name].append(value)
            yield _batch(out)

    kinds = [arrow_type(f.dataType) for f in schema]

    def _batch(out: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(out.values(), kinds, strict=True)], names=schema.names)

    return neighbours(docs, text).mapInArrow(compare, schema)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
