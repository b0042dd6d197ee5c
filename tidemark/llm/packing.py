"""Packing into fixed-length sequences by shortest-pack-first over the length histogram.

Documents become pieces of at most `SEQUENCE` tokens. The histogram of piece lengths has at most
`SEQUENCE` rows whatever the data; it is packed on the driver, longest lengths first, each time into
the pack that is filled least, with counts instead of single pieces. The resulting patterns are
joined back to the pieces by the rank of each piece among those of its length.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import prepare, materialise, table

SEQUENCE = 2048
END_ID = 1
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: parts in which the pieces of one length are numbered
PARTS = 64

# The split of the byte-level vocabulary, and its one special string
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPECIAL = "<|endoftext|>"
# Characters whose classes are the same in every regex engine and Unicode version; texts with others
# go to the tokenizer whole.
_UNSAFE = r"[^\t\n\r\x20-\x7e\xa1-ɏ]"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Tokens:
    """Token ids of texts, as little-endian 32-bit bytes.

    With the path of the same vocabulary as ranks, texts of plain characters take the faster library
    that reads it; texts with the special string or with other characters, and all texts without
    ranks, go to the tokenizer itself. The ids are the same.
    """

    def __init__(self, tokenizer: str, ranks: str | None):
        self.path, self.tokenizer, self.fast = tokenizer, None, None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=table, special_tokens={})
            self.unsafe = re.compile(_UNSAFE)

    def whole(self, text: str) -> bytes:
        if self.tokenizer is None:  # read only if some text needs it
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.fast is None or _SPECIAL in text or self.unsafe.search(text):
            return self.whole(text)
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4").tobytes()


_TOKENS: dict[tuple[str, str | None], Tokens] = {}


def tokens_of(tokenizer: str, ranks: str | None) -> Tokens:
    """The tokenizer, kept for the life of the worker."""
    if (tokenizer, ranks) not in _TOKENS:
        _TOKENS[tokenizer, ranks] = Tokens(tokenizer, ranks)
    return _TOKENS[tokenizer, ranks]


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, sequence: int = SEQUENCE, end_id: int | None = END_ID, text: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids, cut every `sequence`."""
    prepare(docs.sparkSession)
    schema = StructType([docs.schema["doc_id"], *(StructField(c, LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens"))])
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    step = 4 * sequence

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(tokenizer, ranks)
        for batch in batches:
            row: list[int] = []
            out: list[tuple] = []
            for i, body in enumerate(batch.column(1).to_pylist()):
                ids = tokens.encode(body or "") + end
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    row.append(i)
                    out.append((at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
            numbers = np.array(out, dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(numbers[:, i]) for i in range(4))], names=schema.names)

    return docs.select("doc_id", text).mapInArrow(cut, schema)


def pack_histogram(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, tuple[int, ...]]]:
    """(how many packs, lengths in the pack), for a histogram of lengths up to `sequence`."""
    groups: dict[int, list[list]] = defaultdict(list)  # space left -> [count, pattern]
    spaces: list[int] = []  # heap of the spaces in use, largest first
    full: list[tuple[int, tuple[int, ...]]] = []

    def put(space: int, count: int, pattern: tuple[int, ...]) -> None:
        if space == 0:
            full.append((count, pattern))
            return
        if not groups[space]:
            heapq.heappush(spaces, -space)
        groups[space].append([count, pattern])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            while spaces and not groups[-spaces[0]]:
                heapq.heappop(spaces)
            space = -spaces[0] if spaces else 0
            if space < length:
                # a pack just opened is filled least: it takes pieces of this length until it is full
                each = sequence // length
                whole, rest = divmod(left, each)
                if whole:
                    put(sequence - each * length, whole, (length,) * each)
                if rest:
                    put(sequence - rest * length, 1, (length,) * rest)
                break
            pack = groups[space][-1]
            n = min(left, pack[0])
            pack[0] -= n
            left -= n
            if not pack[0]:
                groups[space].pop()
            put(space - length, n, (*pack[1], length))
    return full + [(count, pattern) for group in groups.values() for count, pattern in group]


class Places:
    """For each length, which ranks go to which sequences and offsets."""

    def __init__(self, packs: list[tuple[int, tuple[int, ...]]]):
        rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # length -> (first rank, first sequence, offset)
        used: dict[int, int] = defaultdict(int)
        sequence = 0
        for count, pattern in packs:
            offset = 0
            for length in pattern:
                rows[length].append((used[length], sequence, offset))
                used[length] += count
                offset += length
            sequence += count
        self.rows = {length: np.array(r, dtype=np.int64) for length, r in rows.items()}

    def of(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, sequence, offset = self.rows[length].T
        at = np.searchsorted(first, rank, side="right") - 1
        return sequence[at] + rank - first[at], offset[at]


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, sequence: int = SEQUENCE, end_id: int | None = END_ID, text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is empty: only the end id is left. Every row of docs is a document of its own, repeated
    rows and rows without an id too. Rank ties (same id, start and checksum) hold equal pieces. An
    empty table gives no rows. Columns other than doc_id and the text are not read.
    """
    cut = materialise(pieces(docs, tokenizer, ranks, sequence, end_id, text).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(PARTS)).cast("int")))
    # at most sequence * PARTS rows
    counted = sorted((r.length, r.part, r.n) for r in cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).collect())
    histogram: dict[int, int] = defaultdict(int)
    ahead: dict[tuple[int, int], int] = {}
    for length, part, n in counted:
        ahead[length, part] = histogram[length]
        histogram[length] += n
    shared = docs.sparkSession.sparkContext.broadcast((Places(pack_histogram(histogram, sequence)), ahead))
    ranked = cut.withColumn("rn", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")))
    schema = StructType([*cut.schema.fields[:-1], StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, before = shared.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            base = [before[key] for key in zip(lengths.tolist(), batch.column("part").to_pylist(), strict=True)]
            rank = np.array(base, dtype=np.int64) + batch.column("rn").to_numpy() - 1
            sequence_id, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
            order = np.argsort(lengths, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                if len(at):
                    sequence_id[at], offset[at] = places.of(int(lengths[at[0]]), rank[at])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(schema) - 2], pa.array(sequence_id), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(place, schema)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(RANKS))
