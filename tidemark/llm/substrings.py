"""Removal of passages that occur more than once, by repeated-phrase automata.

A window is a run of `WINDOW` words of one document. Its anchor is the phrase of `PHRASE` words inside
it with the smallest hash, so equal windows have equal anchors, and neighbouring windows mostly share
one.

1. Phrases that are an anchor at two or more places are gathered (one row per phrase, bucket of
   documents and batch).
2. Per bucket, the windows with such an anchor are hashed again, independently, and confirmed if they
   start at two or more places overall. What comes back to the bucket are the anchors that have
   confirmed windows there, and the few windows of these that were not.
3. Per bucket, these anchors are compiled into Aho-Corasick automata of bounded size. All documents of
   the bucket stream through them; around each occurrence, the words of the windows that have this
   anchor and were confirmed are cut.

A bucket holds a bounded number of bytes, and only the phrases that occur in it. So automata grow with
a bucket, not with the corpus, and each document passes through the automata of its bucket alone.
Windows are compared by two independent 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.common import arrow_type, prepare, materialise, slices, table, unused, utf8, utf8_list, whole_groups
from tidemark.llm.rolling import Words, family, mix, sliding_max, sliding_min

WINDOW = 35
PHRASE = 8
BUCKET_BYTES = 4 << 20
#: phrase characters in one automaton
AUTOMATON_CHARS = 1 << 20
#: places of an anchor whose windows are compared in one task
CROWD = 100_000
_CHUNK = 1 << 20


def _anchors(words: Words, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the phrase at each word; anchor hash of the window at each word, 0 where none begins."""
    n = len(words)
    hashes = words.hashes(phrase, np.arange(n - phrase + 1), 0)
    anchors = sliding_min(hashes, window - phrase + 1)
    at = np.arange(len(anchors))
    anchors[words.first[words.text_of[at] + 1] - at < window] = 0
    return hashes, anchors


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, Words]]:
    """Words of consecutive texts, in pieces of bounded size."""
    for a, b in slices(np.array([len(t) for t in texts]), _CHUNK):
        yield a, Words([t.split() for t in texts[a:b]])


def anchor_places(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """(h, bucket, crowded): phrases that are an anchor at two or more places, and the buckets that hold
    them; crowded are those at more than CROWD places."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            for a, words in _chunks(batch.column(1).to_pylist()):
                if len(words) < window:
                    continue
                hashes, anchors = _anchors(words, window, phrase)
                margin = np.zeros(window - phrase, dtype=np.uint64)
                # a phrase is chosen if some window around it has it for its smallest
                around = sliding_max(np.concatenate([margin, anchors, margin]), window - phrase + 1)
                at = np.flatnonzero((around == hashes) & (around > 0))
                pairs = np.stack([buckets[a + words.text_of[at]].astype(np.uint64), hashes[at]], axis=1)
                pairs, n = np.unique(pairs, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 1].view(np.int64)), pa.array(pairs[:, 0].astype(np.int32)), pa.array(n.astype(np.int32))], names=["h", "bucket", "n"])

    found = docs.select("bucket", "body").mapInArrow(scan, "h long, bucket int, n int")
    # the window keeps an anchor's rows outside the heap if they are many; what follows stays in its task
    total = found.withColumn("total", F.sum("n").over(Window.partitionBy("h"))).where("total >= 2")
    return total.select("h", "bucket", (F.col("total") > CROWD).alias("crowded")).distinct()


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values))


_WINDOWS = "h long, bucket int, phrase binary, w array<long>, crowded boolean"


def _empty(names: list[str], types: list[pa.DataType]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)


def confirmed_windows(docs: DataFrame, places: DataFrame, window: int, phrase: int) -> DataFrame:
    """(h, bucket, phrase, w): the anchors that have, in the bucket, windows that start at two or more
    places of the whole corpus; w holds second hashes of their windows there that do not.

    The rows of an anchor meet in one task, but for crowded ones: these stay spread over all tasks and
    are settled by counting their windows one by one."""
    names, types = ["h", "bucket", "phrase", "w", "crowded"], [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.bool_()]

    def windows(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        if not texts.num_rows or not wanted.num_rows:
            return _empty(names, types)
        known = wanted["h"].to_numpy().view(np.uint64)
        order = np.argsort(known)
        known, crowded = known[order], wanted["crowded"].to_numpy()[order]
        found, phrases = [], {}
        for _, words in _chunks(texts["body"].to_pylist()):
            if len(words) < window:
                continue
            hashes, anchors = _anchors(words, window, phrase)
            place = np.minimum(np.searchsorted(known, anchors), len(known) - 1)
            at = np.flatnonzero(known[place] == anchors)
            if not len(at):
                continue
            found.append(np.stack([anchors[at], words.hashes(window, at, 1)], axis=1))
            for h, a in zip(*np.unique(anchors[at], return_index=True), strict=True):
                if h not in phrases:
                    p = at[a] + int(np.flatnonzero(hashes[at[a] : at[a] + window - phrase + 1] == h)[0])
                    phrases[h] = words.data[words.start[p] : words.end[p + phrase - 1]].tobytes()
        if not found:
            return _empty(names, types)
        pairs, n = np.unique(np.concatenate(found), axis=0, return_counts=True)
        pairs = np.repeat(pairs, np.minimum(n, 2), axis=0)  # twice, if at two or more places here
        first = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] != pairs[:-1, 0]]))
        sizes = np.diff(np.concatenate([first, [len(pairs)]]))
        h = pairs[first, 0]
        return pa.Table.from_arrays([
            pa.array(h.view(np.int64)), pa.array(np.full(len(h), wanted["bucket"][0].as_py()), pa.int32()), pa.array([phrases[x] for x in h], pa.binary()),
            _lists(pairs[:, 1].copy().view(np.int64), sizes), pa.array(crowded[np.searchsorted(known, h)])], names=names)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded: list[pa.RecordBatch] = []

        def others() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows - batch.column("crowded").true_count
                yield batch.slice(0, n)
                if n < batch.num_rows:  # crowded rows come last
                    crowded.append(batch.slice(n))
                    return

        for rows in whole_groups(others(), "h"):
            w = rows["w"].combine_chunks()
            row = np.repeat(np.arange(rows.num_rows), w.value_lengths().to_numpy())
            values, h = w.flatten().to_numpy(), rows["h"].to_numpy()[row]
            order = np.lexsort((values, h))
            fresh = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (values[order][1:] != values[order][:-1])])
            group = np.cumsum(fresh) - 1
            twice = np.empty(len(values), dtype=bool)
            twice[order] = np.bincount(group)[group] >= 2
            some = np.flatnonzero(np.bincount(row[twice], minlength=rows.num_rows))
            once = np.bincount(row[~twice], minlength=rows.num_rows)
            has = np.zeros(rows.num_rows, dtype=bool)
            has[some] = True
            part = rows.select(["h", "bucket", "phrase"]).take(pa.array(some)).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [*(part[c].combine_chunks() for c in part.column_names), _lists(values[~twice & has[row]], once[some]), pa.array(np.zeros(len(some), dtype=bool))],
                names=names)
        yield from crowded
        yield from batches

    found = docs.select("bucket", "body").groupBy("bucket").cogroup(places.groupBy("bucket")).applyInArrow(windows, _WINDOWS)
    dealt = found.repartition(F.when(F.col("crowded"), F.xxhash64("h", "bucket")).otherwise(F.col("h")))
    met = materialise(dealt.sortWithinPartitions("crowded", "h").mapInArrow(confirm, _WINDOWS))
    settled, crowded = (met.where(c).drop("crowded") for c in (~F.col("crowded"), F.col("crowded")))
    if crowded.isEmpty():
        return settled

    # a window that occurs once lies in one bucket, which is the least of its buckets
    each = crowded.select("h", "bucket", F.explode("w").alias("x")).groupBy("h", "x").agg(F.count(F.lit(1)).alias("n"), F.min("bucket").alias("bucket"))
    once = each.where("n = 1").groupBy("h", "bucket").agg(F.collect_list("x").alias("once"))
    counted = crowded.join(once, ["h", "bucket"], "left").withColumn("once", F.coalesce("once", F.array().cast("array<long>")))
    some = counted.where(F.size(F.array_distinct("w")) > F.size("once"))
    return settled.unionByName(some.select("h", "bucket", "phrase", F.col("once").alias("w")))


def _automata(phrases: list[bytes]) -> Iterator[tuple]:
    """Automata over phrases with a space on either side, each of bounded size."""
    import ahocorasick

    automaton, size = ahocorasick.Automaton(), 0
    for i, phrase in enumerate(phrases):
        if size > AUTOMATON_CHARS:
            automaton.make_automaton()
            yield automaton
            automaton, size = ahocorasick.Automaton(), 0
        automaton.add_word(f" {phrase.decode('latin-1')} ", i)
        size += len(phrase) + 2
    if size:
        automaton.make_automaton()
        yield automaton


def _covered(words: Words, phrase_at: np.ndarray, which: np.ndarray, h: np.ndarray, unique: np.ndarray, window: int, phrase: int) -> np.ndarray:
    """Which words of one text lie in repeated windows, given its phrase occurrences: the windows
    around one that have it as their anchor, but for those known to be unique."""
    out = np.zeros(len(words) + 1, dtype=np.int64)
    if len(words) < window:
        return out[:-1] > 0
    _, anchors = _anchors(words, window, phrase)
    starts = phrase_at[:, None] - np.arange(window - phrase + 1)
    fits = (starts >= 0) & (starts < len(anchors))
    at, anchor = starts[fits], np.broadcast_to(h[which][:, None], starts.shape)[fits]
    at = np.unique(at[anchors[at] == anchor])
    if len(at) and len(unique):
        key = _pair(anchors[at], words.hashes(window, at, 1))
        at = at[unique[np.minimum(np.searchsorted(unique, key), len(unique) - 1)] != key]
    out[at] += 1
    out[at + window] -= 1
    return np.cumsum(out)[:-1] > 0


def _pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(h) ^ w


def cut_repeats(docs: DataFrame, finish: Callable[[bytes | None, list[bytes], np.ndarray], tuple], schema: StructType, window: int = WINDOW,
                phrase: int = PHRASE, text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Rows of `schema`, one per row of docs: its first columns are those of docs that have their
    names, the others come from finish(text, words, cut), where cut marks the words to remove.

    Words are runs of bytes between ASCII white space. Null and empty texts have none; texts of fewer
    words than a window lose none. Equal rows are different places, so both lose their words. The rows
    are dealt into buckets by id and text; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    # other columns travel under names of our own, so that theirs cannot clash
    carried = [f for f in schema if f.name in docs.columns and f.name != text or f.name == "doc_id"]
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = int(size // bucket_bytes) + 1
    spread = docs.select(
        F.pmod(F.xxhash64("doc_id", text), F.lit(buckets)).cast("int").alias("bucket"), utf8(F.col(text)).alias("body"),
        F.col(text).isNull().alias("missing"), *(F.col(f.name).alias(f"c{i}") for i, f in enumerate(carried)))
    places = anchor_places(spread, window, phrase)
    confirmed = confirmed_windows(spread, places, window, phrase)
    made = [f for f in schema if f not in carried]
    made_types = [arrow_type(f.dataType) for f in made]

    def cut(rows: pa.Table, patterns: pa.Table) -> pa.Table:
        texts = rows["body"].to_pylist()
        hits: dict[int, list[tuple[int, int]]] = {}
        phrases = patterns["phrase"].to_pylist()
        for automaton in _automata(phrases):
            for i, body in enumerate(texts):
                if len(body) < window:
                    continue
                line = " " + b" ".join(body.split()).decode("latin-1") + " "
                here = [(end, which) for end, which in automaton.iter(line)]
                if here:
                    hits.setdefault(i, []).extend(here)
        h = patterns["h"].to_numpy().view(np.uint64)
        w = patterns["w"].combine_chunks() if patterns.num_rows else None
        keys = np.sort(_pair(np.repeat(h, w.value_lengths().to_numpy()), w.flatten().to_numpy().view(np.uint64))) if patterns.num_rows else h
        sizes = np.array([len(p) for p in phrases], dtype=np.int64)
        out = []
        for i, (body, missing) in enumerate(zip(texts, rows["missing"].to_pylist(), strict=True)):
            split = body.split()
            mask = np.zeros(len(split), dtype=bool)
            if i in hits:
                words = Words([split])
                end, which = np.array(hits[i], dtype=np.int64).T
                # the occurrence has a space before and behind, and the line one in front
                at = np.searchsorted(words.start, end - sizes[which] - 1)
                mask = _covered(words, at, which, h, keys, window, phrase)
            out.append(finish(None if missing else body, split, mask))
        columns = list(zip(*out, strict=True)) if out else [()] * len(made)
        by_name = {f.name: rows[f"c{i}"] for i, f in enumerate(carried)}
        by_name |= {f.name: pa.array(list(c), t) for f, c, t in zip(made, columns, made_types, strict=True)}
        return pa.Table.from_arrays([by_name[n] for n in schema.names], names=schema.names)

    return spread.groupBy("bucket").cogroup(confirmed.groupBy("bucket")).applyInArrow(cut, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """docs with the words of every repeated window removed from the text; the words that stay are
    joined by single spaces. Documents that lose no word keep their text as it is, nulls too; every row
    stays. A column n_chars, if there, is counted anew for changed texts."""
    counted = "n_chars" in docs.columns
    before, changed = (unused(n, docs.columns) for n in ("_n_chars", "_changed"))
    flagged = docs.withColumnRenamed("n_chars", before) if counted else docs
    schema = StructType([f for f in flagged.schema if f.name != text] + [StructField(text, StringType()), StructField(changed, LongType())])

    def finish(body: bytes | None, words: list[bytes], cut: np.ndarray) -> tuple:
        if not cut.any():
            return (None if body is None else body.decode(), None)
        kept = b" ".join(w for w, c in zip(words, cut, strict=True) if not c).decode()
        return (kept, len(kept))

    out = cut_repeats(flagged, finish, schema, window, text=text)
    if counted:
        out = out.withColumn("n_chars", F.coalesce(F.col(changed).cast(docs.schema["n_chars"].dataType), F.col(before)))
    return out.select(*docs.columns)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = StructType([docs.schema["doc_id"], StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())])

    def finish(body: bytes | None, words: list[bytes], cut: np.ndarray) -> tuple:
        kept = b" ".join(w for w, c in zip(words, cut, strict=True) if not c) if cut.any() else b" ".join(words)
        return len(words), int(cut.sum()), hashlib.sha256(kept).hexdigest()

    return cut_repeats(docs, finish, schema)


ORACLE_OP8 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT rid, i, md5(array_to_string(list_slice(ws, i, i + 34), ' ')) AS h
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)
), again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1
), gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM win JOIN again USING (h)
), per AS (SELECT rid, count(*) AS n_removed FROM gone GROUP BY rid
), words AS (SELECT rid, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS w FROM d
), kept AS (SELECT rid, string_agg(w, ' ' ORDER BY p) AS body FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(per.n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.body, '')) AS kept_sha256
FROM d LEFT JOIN per USING (rid) LEFT JOIN kept USING (rid)
"""
