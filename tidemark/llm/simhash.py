"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last filled up with zeros). The
perfect binary Golay code decodes every 23-bit word to the one codeword within 3 bits; the indices of
a word and of all words one bit away are its nearby indices, one or six of them. Two words that
differ in at most 2 bits share a nearby index (that of a word between them); of two that differ in at
most 1 bit, either one's own index is nearby to the other.

Pigeonhole: if two fingerprints differ in at most 4 bits, then either two segments differ in at most
1 bit each, or one segment is equal and the other two differ in exactly 2. So the keys of a
fingerprint are, for each pair of segments, (own index, nearby indices) and (nearby indices, own
index), and for each segment, (its exact bits, nearby indices of the next segment). Fingerprints that
meet under a key are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import materialise, prepare, table, unused, utf8_list, whole_groups
from tidemark.llm.graph import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: fingerprints under one key that a task compares by itself; more are compared in pairs of blocks
BLOCK = 10_000
#: up to so many, all pairs are compared at once
SMALL = 12

# Fixed value: generator polynomial of the Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
_GENERATOR = 0b101011100011


def simhash(data: bytes, words_in_shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text: A-Z lowered, words between ASCII white space, shingles of some
    words (all words, if fewer; none: 0), each hashed by XXH64. A bit is set if it is in over half."""
    import xxhash

    words = data.lower().split()
    if not words:
        return 0
    n = min(words_in_shingle, len(words))
    digest, join = xxhash.xxh64_intdigest, b" ".join
    shingles = zip(*(words[i:] for i in range(n)), strict=False)
    h = np.fromiter((digest(join(s), SEED) for s in shingles), dtype="<u8", count=len(words) - n + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65536):
        ones += np.unpackbits(h[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(((ones * 2 > len(h)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


class Golay:
    """Decoding of 23-bit words, by tables made from the generator polynomial."""

    def __init__(self):
        syndrome_of_bit = []
        for bit in range(23):
            word = 1 << bit
            for high in range(22, 10, -1):
                if word >> high & 1:
                    word ^= _GENERATOR << (high - 11)
            syndrome_of_bit.append(word)
        self.low, self.high = (self._spread(syndrome_of_bit[a:b]) for a, b in ((0, 12), (12, 23)))
        self.error = np.zeros(2048, dtype=np.int64)
        bits = range(23)
        patterns = [(a,) for a in bits] + [(a, b) for a in bits for b in range(a)] + [(a, b, c) for a in bits for b in range(a) for c in range(b)]
        for pattern in patterns:
            syndrome = 0
            for bit in pattern:
                syndrome ^= syndrome_of_bit[bit]
            self.error[syndrome] = sum(1 << bit for bit in pattern)

    @staticmethod
    def _spread(of_bit: list[int]) -> np.ndarray:
        out = np.zeros(1, dtype=np.int64)
        for syndrome in of_bit:
            out = np.concatenate([out, out ^ syndrome])
        return out

    def index(self, words: np.ndarray) -> np.ndarray:
        """Index (12 bits) of the codeword within 3 bits."""
        syndrome = self.low[words & 0xFFF] ^ self.high[words >> 12]
        return (words ^ self.error[syndrome]) >> 11

    def nearby(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct indices of each word and of those one of its first `width` bits away: (which word, index)."""
        around = np.concatenate([[0], 1 << np.arange(width)])
        found = np.sort(self.index(words[:, None] ^ around), axis=1)
        fresh = np.ones(found.shape, dtype=bool)
        fresh[:, 1:] = found[:, 1:] != found[:, :-1]
        row, column = np.nonzero(fresh)
        return row, found[row, column]


_GOLAY: list[Golay] = []


def golay() -> Golay:
    if not _GOLAY:
        _GOLAY.append(Golay())
    return _GOLAY[0]


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which fingerprint, key) of uint64 fingerprints. A key holds its family in the top bits."""
    code = golay()
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    own = [code.index(p) for p in parts]
    near = [code.nearby(p, width) for p, (_, width) in zip(parts, SEGMENTS, strict=True)]
    rows, keys = [], []
    for number, (a, b) in enumerate(((0, 1), (1, 2), (2, 0))):
        row, index = near[b]
        rows.append(row)
        keys.append(((number << 48) | (own[a][row] << 12)) | index)
        exact = (((3 + number) << 48) | (parts[a][row] << 12)) | index
        rows.append(row)
        keys.append(exact)
        row, index = near[a]
        other = index != own[a][row]  # the own index of both is there already
        rows.append(row[other])
        keys.append((((number << 48) | (index << 12)) | own[b][row])[other])
    return np.concatenate(rows), np.concatenate(keys)


def link(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the graph that joins fingerprints at most `distance` bits apart."""
    left, out_a, out_b = np.unique(prints), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            here = queue.pop()
            close = np.bitwise_count(left ^ here) <= distance
            if close.any():
                found = left[close]
                left = left[~close]
                queue.extend(found)
                out_a.append(np.full(len(found), here))
                out_b.append(found)
    if not out_a:
        return prints[:0], prints[:0]
    return np.concatenate(out_a), np.concatenate(out_b)


def _link_keys(keys: np.ndarray, prints: np.ndarray, distance: int) -> tuple[list[np.ndarray], list[np.ndarray], list[tuple[int, int]]]:
    """Links among rows sorted by key; ranges of rows whose key has more than BLOCK."""
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(edge)
    a, b, over = [], [], []
    size_of = np.repeat(sizes, sizes)
    left_in = np.repeat(edge[1:], sizes) - np.arange(len(keys)) - 1  # rows of the key that follow
    for shift in range(1, SMALL):
        at = np.flatnonzero((size_of <= SMALL) & (left_in >= shift))
        if not len(at):
            break
        close = at[np.bitwise_count(prints[at] ^ prints[at + shift]) <= distance]
        a.append(prints[close])
        b.append(prints[close + shift])
    for group in np.flatnonzero(sizes > SMALL):
        begin, end = int(edge[group]), int(edge[group + 1])
        if end - begin > BLOCK:
            over.append((begin, end))
        else:
            x, y = link(prints[begin:end], distance)
            a.append(x)
            b.append(y)
    return a, b, over


def find_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that differ in at most `distance` bits,
    enough of them to join all that are linked. distance is at most 4, which the keys are made for."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"the keys find links of up to {DISTANCE} bits")
    prepare(prints.sparkSession)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for at in range(0, len(fp), 20_000):
                part = fp[at : at + 20_000]
                row, key = fuzzy_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row])], names=["key", "fp"])

    names = ["key", "block", "u", "v"]

    def batch(key: np.ndarray, block: np.ndarray, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(block, pa.int32()), pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "key"):
            keys, fp = rows["key"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
            a, b, over = _link_keys(keys, fp, distance)
            if a:
                pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0).view(np.int64)
                none = np.zeros(len(pairs), dtype=np.int64)
                yield batch(none, none - 1, pairs[:, 0], pairs[:, 1])
            for begin, end in over:
                size = end - begin
                yield batch(keys[begin:end], np.arange(size) // BLOCK, fp[begin:end].view(np.int64), np.full(size, -(-size // BLOCK)))

    keyed = prints.select("fp").mapInArrow(emit, "key long, fp long")
    met = materialise(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "key long, block int, u long, v long"))
    links = met.where("block < 0").select("u", "v")
    over = met.where("block >= 0")
    if over.isEmpty():
        return links

    # crowded keys: every pair of blocks is a task of its own
    paired = over.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("v") - 1).cast("int")))).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "u")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = link(rows["u"].to_numpy().view(np.uint64), distance)
        return pd.DataFrame({"u": x.view(np.int64), "v": y.view(np.int64)})

    return links.unionByName(paired.groupBy("key", "i", "j").applyInPandas(compare, "u long, v long"))


def fingerprints(docs: DataFrame, words_in_shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint as a signed long."""
    prepare(docs.sparkSession)
    schema = StructType([docs.schema["doc_id"], StructField("text_hash", LongType()), StructField("fp", LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(t, words_in_shingle) for t in utf8_list(batch.column(2))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], names=schema.names)

    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text).mapInArrow(scan, schema)


def near_duplicates(docs: DataFrame, words_in_shingle: int = SHINGLE, distance: int = DISTANCE, text: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, component_id, kept_hash) of every row.

    component_id is the smallest doc_id that links reach; kept_hash the hash of that document's text
    (the smaller, if rows share the id). Null texts are empty, and empty texts have fingerprint 0,
    which links like any other. Rows without id take part; a component of only such rows has a null
    id. Equal fingerprints are one node, so copies make no pairs. An empty table gives no rows.
    """
    prints = materialise(fingerprints(docs, words_in_shingle, text))
    # rows without id come last in the order of a component
    first = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")))
    nodes = materialise(prints.groupBy("fp").agg(first.alias("first")))
    roots = components(find_links(nodes, distance))
    joined = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    best = joined.groupBy("root").agg(F.min("first").alias("best"))
    member = joined.join(best, "root").select("fp", F.col("best.id").alias("component_id"), F.col("best.hash").alias("kept_hash"))
    return prints.join(member, "fp").select("doc_id", "text_hash", "fp", "component_id", "kept_hash")


def drop_near_duplicates(docs: DataFrame, words_in_shingle: int = SHINGLE, distance: int = DISTANCE, text: str = "text") -> DataFrame:
    """The rows of docs, one of each component: the one with the smallest doc_id. Repeated rows of it
    are one. A component without any id keeps one of its texts."""
    own_id, own_hash, text_hash = (unused(n, docs.columns) for n in ("_kept_id", "_kept_hash", "_text_hash"))
    kept = near_duplicates(docs, words_in_shingle, distance, text).select(
        F.col("component_id").alias(own_id), F.col("kept_hash").alias(own_hash)).distinct()
    hashed = docs.withColumn(text_hash, F.xxhash64(text))
    same = hashed["doc_id"].eqNullSafe(kept[own_id]) & (hashed[text_hash] == kept[own_hash])
    # both sides are dealt by id and text, which single out a row but for repeats
    return hashed.join(kept, same, "left_semi").dropDuplicates(["doc_id", text_hash]).drop(text_hash)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
