"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of documents of bounded size inside a task. Its words are replaced by ranks of the
benchmark's vocabulary (0 for any other word, which no test phrase holds, so stretches shorter than
the shortest phrase can be left out). Test phrases are searched backwards through wavelet-tree ranks
of the Burrows-Wheeler transform, all phrases side by side; sampled suffix positions locate their
occurrences; the spans of a document are merged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, slices, table, utf8_list

WINDOW = 10
#: bytes of benchmark text that are searched in one pass; larger benchmarks take several passes
BLOCK_BYTES = 32 << 20
#: bytes of documents indexed together
SHARD_BYTES = 4 << 20
#: every so many text positions, the suffix array is kept
SAMPLE = 8

# A-Z lowered; every other ASCII byte that is not a letter or digit ends a word
_FOLD = bytes(
    (b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32) for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    """Lower-cased words of UTF-8 text: runs of letters, digits and non-ASCII characters."""
    return data.translate(_FOLD).split()


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; only groups that are still tied are sorted again. The last
    symbol must be smaller than all others."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    sorted_rank = rank[order]
    new = np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]])
    head = np.flatnonzero(new)
    group = np.repeat(head, np.diff(np.concatenate([head, [n]])))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = group
    step = 1
    while True:
        sizes = np.diff(np.concatenate([head, [n]]))
        tied = np.repeat(sizes > 1, sizes)
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        suffix = order[at]
        # a suffix that ends early is smaller: -1
        after = np.where(suffix + step < n, rank[np.minimum(suffix + step, n - 1)], -1)
        key = group[at] * (n + 1) + after + 1
        resort = np.argsort(key, kind="stable")
        order[at] = suffix[resort]
        key = key[resort]
        first = np.zeros(n, dtype=bool)
        first[head] = True
        first[at[1:]] |= key[1:] != key[:-1]
        head = np.flatnonzero(first)
        group = np.repeat(head, np.diff(np.concatenate([head, [n]])))
        rank[order] = group
        step *= 2


class WaveletTree:
    """Ranks of symbols in a sequence: per bit, from the highest, a stable split and prefix counts."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for bit in range(bits - 1, -1, -1):
            high = ((symbols >> bit) & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(high, dtype=np.int32)]))
            self.zeros.append(int(len(symbols) - self.ones[-1][-1]))
            symbols = np.concatenate([symbols[~high], symbols[high]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol lies before each position."""
        lo, hi = np.zeros_like(upto), upto
        for level in range(self.bits):
            ones, zeros = self.ones[level], self.zeros[level]
            right = (symbol >> (self.bits - 1 - level)) & 1 == 1
            lo1, hi1 = ones[lo], ones[hi]
            lo, hi = np.where(right, zeros + lo1, lo - lo1), np.where(right, zeros + hi1, hi - hi1)
        return hi - lo


class FMIndex:
    """Backward search and location over symbols 1..sigma-1; 0 separates and is never searched."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        text = np.concatenate([symbols + 1, [0]])
        order = suffix_array(text)
        self.bwt = text[order - 1]
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 2))])
        self.tree = WaveletTree(self.bwt, max(1, int(sigma + 1).bit_length()))
        self.sampled = order % SAMPLE == 0
        self.slot = np.concatenate([[0], np.cumsum(self.sampled)])
        self.position = order[self.sampled]
        self.size = len(text)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases, given as rows of symbols padded on the right."""
        lo = np.zeros(len(phrases), dtype=np.int64)
        hi = np.full(len(phrases), self.size, dtype=np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((column < lengths) & (hi > lo))
            symbol = phrases[live, column] + 1
            lo[live] = self.less[symbol] + self.tree.rank(symbol, lo[live])
            hi[live] = self.less[symbol] + self.tree.rank(symbol, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks: step back until a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        out = np.zeros(len(rows), dtype=np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.sampled[rows[open_]]
            out[open_[done]] = self.position[self.slot[rows[open_[done]]]] + steps[open_[done]]
            open_ = open_[~done]
            symbol = self.bwt[rows[open_]]
            rows[open_] = self.less[symbol] + self.tree.rank(symbol, rows[open_])
            steps[open_] += 1
        return out


class Phrases:
    """Distinct test phrases of some benchmark items, as ranks of their own vocabulary."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names: list[str] = []
        owners: dict[tuple[int, ...], list[int]] = {}
        for name, text in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of((text or "").encode()))
            if not ids:
                continue
            self.names.append(name)
            for i in range(max(1, len(ids) - window + 1)):
                owners.setdefault(ids[i : i + window], []).append(len(self.names) - 1)
        self.owners = [sorted(set(o)) for o in owners.values()]
        self.lengths = np.array([len(p) for p in owners], dtype=np.int64)
        self.rows = np.zeros((len(owners), window), dtype=np.int64)
        for i, phrase in enumerate(owners):
            self.rows[i, : len(phrase)] = phrase
        self.shortest = int(self.lengths.min()) if len(owners) else 0


def _search_shard(texts: list[bytes], phrases: Phrases) -> tuple[list[list[tuple[int, int]]], list[set[str]], list[int]]:
    """Per text: hit spans as (first word, past last word), names of items, number of words."""
    get = phrases.vocabulary.get
    parts, origin, counts = [], [], []
    at = 0
    for text in texts:
        ids = [get(w, 0) for w in words_of(text)]
        counts.append(len(ids))
        parts.append(np.array([*ids, 0], dtype=np.int64))
        origin.append(at)
        at += len(ids) + 1
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    names: list[set[str]] = [set() for _ in texts]
    if not len(phrases.lengths):
        return spans, names, counts
    whole = np.concatenate(parts)
    known = whole > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], known]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]  # the last symbol is 0, so every stretch ends
    long = end - begin >= phrases.shortest
    begin, end = begin[long], end[long]
    if not len(begin):
        return spans, names, counts
    length = end - begin + 1  # with the 0 behind each stretch
    source = np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
    index = FMIndex(whole[source], len(phrases.vocabulary) + 1)
    lo, hi = index.search(phrases.rows, phrases.lengths)
    found = np.flatnonzero(hi > lo)
    n = (hi - lo)[found]
    which = np.repeat(found, n)
    rows = np.repeat(lo[found] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    positions = source[index.locate(rows)] if len(rows) else rows
    starts = np.array(origin)
    doc = np.searchsorted(starts, positions, side="right") - 1
    for d, p, w in zip(doc.tolist(), (positions - starts[doc]).tolist(), which.tolist(), strict=True):
        spans[d].append((p, p + int(phrases.lengths[w])))
        names[d].update(phrases.names[o] for o in phrases.owners[w])
    return spans, names, counts


def merge_spans(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
                  block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """docs with three more columns: bench_words (int), bench_spans (flat array: first word, past
    last word, ...), bench_items (sorted names of items of which a window occurs).

    No shuffle. The benchmark is the stated query set: it is sent to the tasks in blocks of at most
    `block_bytes` of text, one pass over the documents each. A null or empty text has no words and no
    spans, a null or wordless item no windows; an item of fewer words than `window` is one window.
    Items with the same id count as one name; items without id are searched too, but have no name. Columns of docs that have the new names are replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.col("text").alias("body"))
    size = items.agg(F.sum(F.octet_length("body") + 64)).first()[0] or 0
    blocks = int(size // block_bytes) + 1
    out = docs.drop("bench_words", "bench_spans", "bench_items").withColumns({
        "bench_words": F.lit(0).cast("long"), "bench_spans": F.array().cast("array<int>"), "bench_items": F.array().cast("array<string>")})
    schema, at = out.schema, out.columns.index(text)
    prepare(spark)
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("name", "body"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(Phrases([(r.name, r.body) for r in part.collect()], window))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            phrases = shared.value
            for batch in batches:
                texts = utf8_list(batch.column(at))
                for a, b in slices(np.array([len(t) for t in texts]), shard_bytes):
                    spans, names, counts = _search_shard(texts[a:b], phrases)
                    *kept, _, old_spans, old_names = batch.slice(a, b - a).columns
                    merged = [
                        [x for span in merge_spans([*zip(old[::2], old[1::2], strict=True), *new]) for x in span]
                        for old, new in zip(old_spans.to_pylist(), spans, strict=True)]
                    both = [sorted({*old, *new} - {None}) for old, new in zip(old_names.to_pylist(), names, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*kept, pa.array(counts, pa.int64()), pa.array(merged, pa.list_(pa.int32())), pa.array(both, pa.list_(pa.string()))],
                        names=schema.names)

        out = out.mapInArrow(search, schema)
    return out


def remove_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """docs with every word inside an occurrence of a test phrase cut out of the text.

    Each span goes from the first byte of its first word to the last of its last word; what stands
    around stays as it is. Untouched documents, empty and null texts stay unchanged; every row stays.
    A column n_chars, if there, is counted anew for changed texts.
    """
    # columns travel under names of our own, so that theirs cannot clash with what is found
    body, counted = docs.columns.index(text), "n_chars" in docs.columns
    carried = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    found = find_passages(carried, benchmark, window, f"c{body}")
    schema = docs.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[: len(schema)]
            spans = batch.column("bench_spans").to_pylist()
            changed = [i for i, s in enumerate(spans) if s]
            if changed:
                texts = columns[body].to_pylist()
                for i in changed:
                    texts[i] = _without(texts[i], [*zip(spans[i][::2], spans[i][1::2], strict=True)])
                columns[body] = pa.array(texts, columns[body].type)
                if counted:
                    n = schema.names.index("n_chars")
                    sizes = columns[n].to_pylist()
                    for i in changed:
                        sizes[i] = len(texts[i])
                    columns[n] = pa.array(sizes, columns[n].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return found.mapInArrow(cut, schema)


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    data = text.encode()
    marks = np.frombuffer(data.translate(_FOLD), dtype=np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    begin, end = edge[::2], edge[1::2]
    keep, at = [], 0
    for a, b in spans:
        keep.append(data[at : begin[a]])
        at = int(end[b - 1])
    return b"".join([*keep, data[at:]]).decode()


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(
        F.sequence(F.lit(0), F.greatest(F.size("bench_spans") - 2, F.lit(0)), F.lit(2)), F.lit(0).cast("long"),
        lambda acc, i: acc + F.coalesce(F.get("bench_spans", i + 1) - F.get("bench_spans", i), F.lit(0)))
    return found.select(
        "doc_id", F.col("bench_words").alias("n_words"), hit.alias("n_hit"),
        F.size("bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("bench_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("bench_spans") > 0).alias("contaminated"))


ORACLE_OP10 = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), bw AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(list_slice(ws, i, i + least(len(ws), 10) - 1), ' ') AS phrase
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 10 + 1, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), lens AS (SELECT DISTINCT n FROM bw), dw AS (
  SELECT rid, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS phrase
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, lens WHERE len(ws) >= n)
), hits AS (SELECT d.rid, d.i, d.n, b.item FROM dw d JOIN bw b ON d.n = b.n AND d.phrase = b.phrase),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS names FROM hits GROUP BY rid)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items.names, '')) AS items_sha256,
  coalesce(words.n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""
