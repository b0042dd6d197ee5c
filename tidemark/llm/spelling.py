"""Spelling variants: words of a corpus grouped under their most frequent near word.

Two words are near if one inserted, deleted or replaced letter makes them equal. Then one half of the
first, its left or its right, stands unchanged at that end of the second. So each half is looked up exactly and
the search goes on across the other half with one error allowed, in a bidirectional FM-index
of the delimited words: an interval of suffixes that start with what has been read, kept for the text and for
the text reversed, which grows by a symbol at either end. Read up to both delimiters, the interval is one
word, by its rank.

The vocabulary is spread by the halves. A word lies with the words that begin like it, and once more with
those that end like it, so a query is answered where its half belongs and nowhere else. Ranges of halves
make indexes of a bounded number of symbols. A half that very many words share is dealt to several
indexes, each of which gets the queries of that half.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.common import arrow_type, materialise, prepare, table

LEAST_LETTERS = 5
LEAST_COUNT = 3
#: a form is at least so many times as frequent
RATIO = 2
MODULUS = 97
#: symbols that one index holds, about; words of one half beyond HALF_WORDS go to several indexes
INDEX_SYMBOLS = 1 << 20
HALF_WORDS = 50_000
#: words that a task counts before it sends the counts on
HELD_WORDS = 200_000
#: texts from this length are not split into words at once
LONG_TEXT = 4 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


# ---- words -------------------------------------------------------------------------------


class _Ids(dict):
    """Numbers of words, given out in turn, and the words by number."""

    def __init__(self):
        super().__init__()
        self.words: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


def _runs(text: bytes) -> Iterator[list[str]]:
    """Lower-cased runs of a text that are long enough, in lists of bounded length."""
    whole = text.translate(_LOWER).decode()
    if len(whole) < LONG_TEXT:
        yield _RUN.findall(whole)
        return
    held = []
    for match in _RUN.finditer(whole):
        held.append(match.group())
        if len(held) == HELD_WORDS:
            yield held
            held = []
    yield held


class WordCounts:
    """Counts of the edited runs of texts.

    The checksum of `<id>:<run>` is that of the id's bytes moved on by the run's length, combined with that
    of the run alone: so runs are hashed once each, however often they occur.
    """

    SHORT = 64

    def __init__(self):
        self.blank = [b"\0" * n for n in range(self.SHORT)]
        self.zeros = np.array([zlib.crc32(b) for b in self.blank], dtype=np.uint32)
        self._clear()

    def _clear(self) -> None:
        self.ids = _Ids()
        self.own = np.zeros(0, dtype=np.uint32)
        self.size = np.zeros(0, dtype=np.int64)
        self.counts = np.zeros(0, dtype=np.int64)

    def _hash_new(self) -> None:
        data = [w.encode() for w in self.ids.words[len(self.own) :]]
        self.own = np.concatenate([self.own, np.array([zlib.crc32(w) for w in data], dtype=np.uint32)])
        self.size = np.concatenate([self.size, np.array([len(w) if len(w) < self.SHORT else 0 for w in data], dtype=np.int64)])
        self.counts = np.concatenate([self.counts, np.zeros(len(data), dtype=np.int64)])

    def add(self, ids: list[str], texts: list[bytes | None]) -> None:
        """Count the runs of some texts; texts are cut into blocks, so that few runs are held at a time."""
        found: list[int] = []
        bases: list[int] = []
        lengths: list[int] = []
        number = self.ids.__getitem__
        for i, text in zip(ids, texts, strict=True):
            for runs in _runs(text) if text else ():
                found.extend(map(number, runs))
                bases.append(zlib.crc32(f"{i}:".encode()))
                lengths.append(len(runs))
                if len(found) >= HELD_WORDS:
                    self._count(found, bases, lengths)
                    found, bases, lengths = [], [], []
        if found:
            self._count(found, bases, lengths)

    def _count(self, numbers: list[int], bases: list[int], lengths: list[int]) -> None:
        self._hash_new()
        found, owner = np.array(numbers, dtype=np.int64), np.repeat(np.arange(len(bases)), lengths)
        moved = np.array([[zlib.crc32(zeros, base) for zeros in self.blank] for base in bases], dtype=np.uint32) ^ self.zeros
        size = self.size[found]
        checks = moved[owner, size] ^ self.own[found]
        odd = np.flatnonzero((checks % MODULUS == 0) | (size == 0))
        edited = []
        for i in odd.tolist():
            run, check = self.ids.words[numbers[i]], int(checks[i])
            if not size[i]:
                check = zlib.crc32(run.encode(), bases[owner[i]])
            if check % MODULUS == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1 :]
            if len(run) >= LEAST_LETTERS:
                edited.append(self.ids[run])
        plain = np.ones(len(found), dtype=bool)
        plain[odd] = False
        self._hash_new()
        self.counts += np.bincount(np.concatenate([found[plain], np.array(edited, dtype=np.int64)]), minlength=len(self.counts))

    def take(self) -> pa.RecordBatch:
        """What has been counted; counting starts anew."""
        used = self.counts > 0
        words = pa.array(self.ids.words, pa.string()).filter(pa.array(used))
        batch = pa.RecordBatch.from_arrays([words, pa.array(self.counts[used])], names=["word", "n"])
        self._clear()
        return batch


def corpus_words(docs: DataFrame, least_count: int = LEAST_COUNT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of every word that occurs often enough, written once.

    Whole texts are read; null and empty texts have no words, a null id counts as an empty one, repeated
    rows count again. Other columns take no part.
    """
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = WordCounts()
        for batch in batches:
            held.add(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())
            if len(held.ids) > HELD_WORDS:
                yield held.take()
        yield held.take()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialise(counted.where(F.col("n") >= least_count))


# ---- the index ---------------------------------------------------------------------------

#: symbols: end of text, delimiter, a-z, U+00C0 to U+00FF, all in code-point order
END, DELIMITER, FIRST_LETTER = 0, 1, 2
SYMBOLS = 2 + 26 + 64
_CODE = np.zeros(256, dtype=np.uint8)
_CODE[ord("$")] = DELIMITER
_CODE[97:123] = np.arange(2, 28)
_CODE[0xC0:0x100] = np.arange(28, 92)


def codes(words: list[str]) -> np.ndarray:
    """Symbols of words with a delimiter before each and after the last."""
    return _CODE[np.frombuffer(("$" + "$".join(words) + "$").encode("latin-1"), dtype=np.uint8)]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a text and its end, in order: by their first symbols, packed into integers,
    then by twice as many symbols each time."""
    n, reach = len(text) + 1, 9
    packed = np.zeros(n, dtype=np.int64)
    for i in range(reach):
        packed <<= 7
        packed[: max(0, n - 1 - i)] += text[i:]
    order = np.argsort(packed, kind="stable")
    rank = np.zeros(n, dtype=np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(np.diff(packed[order]) != 0)])
    while rank.max() < n - 1:
        key = rank * (n + 1)
        key[: max(0, n - reach)] += rank[reach:] + 1
        order = np.argsort(key, kind="stable")
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        reach *= 2
    return order


class Ranks:
    """How often symbols occur before a place of the Burrows-Wheeler transform of a text."""

    STEP = 32

    def __init__(self, text: np.ndarray):
        order = suffix_order(text)
        last = np.where(order > 0, text[order - 1], END).astype(np.uint8)
        total = np.bincount(last, minlength=SYMBOLS)
        total[END] = 1
        self.first = np.concatenate([[0], np.cumsum(total)])[:SYMBOLS]
        n = len(last) // self.STEP + 1
        self.rows = np.full(n * self.STEP, 255, dtype=np.uint8)
        self.rows[: len(last)] = last
        self.rows = self.rows.reshape(n, self.STEP)
        at = np.repeat(np.arange(n), self.STEP)[: len(last)]
        counts = np.bincount(at * SYMBOLS + last, minlength=n * SYMBOLS).reshape(n, SYMBOLS)
        # below[b, c]: symbols less than c before block b
        self.below = np.zeros((n, SYMBOLS + 1), dtype=np.int32)
        np.cumsum(np.cumsum(counts, axis=0)[:-1], axis=1, out=self.below[1:, 1:])
        self._inside = np.arange(self.STEP)

    def of(self, at: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of one symbol, and of all lesser ones, before each place."""
        block, rest = at // self.STEP, at % self.STEP
        rows, inside = self.rows[block], self._inside < rest[:, None]
        wanted = symbol[:, None]
        less = self.below[block, symbol]
        return (self.below[block, symbol + 1] - less + ((rows == wanted) & inside).sum(axis=1), less + ((rows < wanted) & inside).sum(axis=1))

    def all(self, at: np.ndarray) -> np.ndarray:
        """Occurrences of every symbol before each place."""
        block, rest = at // self.STEP, at % self.STEP
        inside = self._inside < rest[:, None]
        owner = np.nonzero(inside)[0]
        near = np.bincount(owner * SYMBOLS + self.rows[block][inside], minlength=len(at) * SYMBOLS).reshape(-1, SYMBOLS)
        return np.diff(self.below[block], axis=1) + near


class Spans:
    """Intervals of suffixes, of the text and of the text reversed, and how far their queries have been read."""

    __slots__ = ("query", "read", "errors", "ahead", "back", "size")

    def __init__(self, query, read, errors, ahead, back, size):
        self.query, self.read, self.errors, self.ahead, self.back, self.size = query, read, errors, ahead, back, size

    def pick(self, which: np.ndarray) -> Spans:
        return Spans(*(getattr(self, n)[which] for n in self.__slots__))

    @staticmethod
    def joined(parts: list[Spans]) -> Spans:
        return Spans(*(np.concatenate([getattr(p, n) for p in parts]) for n in Spans.__slots__))


class WordIndex:
    """A bidirectional FM-index of distinct words in code-point order."""

    def __init__(self, words: list[str]):
        self.words = words
        self.text = codes(words)

    @cached_property
    def forward(self) -> Ranks:
        return Ranks(self.text)

    @cached_property
    def reverse(self) -> Ranks:
        return Ranks(self.text[::-1])

    def grow(self, spans: Spans, symbol: np.ndarray, right: bool) -> Spans:
        """What is left of intervals with a symbol more, at the right or left end; empty ones leave.

        The interval at that end narrows as by its own transform. The other keeps its place among
        the lesser symbols that might have come instead.
        """
        ranks = self.reverse if right else self.forward
        here, there = (spans.back, spans.ahead) if right else (spans.ahead, spans.back)
        low, low_less = ranks.of(here, symbol)
        high, high_less = ranks.of(here + spans.size, symbol)
        size = high - low
        here, there = ranks.first[symbol] + low, there + high_less - low_less
        ahead, back = (there, here) if right else (here, there)
        return Spans(spans.query, spans.read, spans.errors, ahead, back, size).pick(size > 0)

    def near(self, queries: list[str], right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of all words one error away whose left half (`right`: the search goes on to the
        right) or right half is that of the query. Each pair once."""
        sizes = np.array([len(q) for q in queries], dtype=np.int64)
        symbols = codes([q if right else q[::-1] for q in queries])
        start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1] + 1
        # symbols[start + size] is the delimiter that ends a query
        exact = sizes // 2 if right else sizes - sizes // 2
        n = len(queries)
        zero = np.zeros(n, dtype=np.int64)
        delimiters = len(self.words) + 1
        spans = Spans(np.arange(n), zero, zero, zero + 1, zero + 1, zero + delimiters)
        found: list[tuple[np.ndarray, np.ndarray]] = []

        while True:  # the exact half
            open_ = spans.read < exact[spans.query]
            if not open_.any():
                break
            grown = self.grow(spans.pick(open_), symbols[start[spans.query[open_]] + spans.read[open_]], right)
            grown.read = grown.read + 1
            spans = Spans.joined([spans.pick(~open_), grown])

        while len(spans.query):  # the other half, one symbol at a time
            at = start[spans.query] + spans.read
            symbol = symbols[at]
            ended = spans.read == sizes[spans.query]
            parts = []
            # the next symbol as it stands; a query that ends without an error is the word itself
            goes = (spans.errors == 1) | ~ended
            plain = spans.pick(goes)
            plain.read = plain.read + 1
            plain = self.grow(plain, symbol[goes], right)
            done = plain.read > sizes[plain.query]
            found.append((plain.query[done], plain.ahead[done] - 2))
            parts.append(plain.pick(~done))
            clean = np.flatnonzero(spans.errors == 0)
            if len(clean):
                whole, own, over = spans.pick(clean), symbol[clean], ended[clean]
                # a symbol of the query left out: of equal ones in a row the last
                skip = ~over & (symbols[np.minimum(at[clean] + 1, len(symbols) - 1)] != own)
                left = whole.pick(skip)
                parts.append(Spans(left.query, left.read + 1, left.errors + 1, left.ahead, left.back, left.size))
                # any other letter, in place of the next symbol or before it
                ranks = self.reverse if right else self.forward
                here = whole.back if right else whole.ahead
                there = whole.ahead if right else whole.back
                for a in range(0, len(clean), 8192):
                    b = a + 8192
                    low = ranks.all(here[a:b])
                    n_of = ranks.all(here[a:b] + whole.size[a:b]) - low
                    lesser = np.cumsum(n_of, axis=1) - n_of
                    other = n_of > 0
                    other[:, :FIRST_LETTER] = False
                    other[np.arange(len(low)), own[a:b]] = False
                    row, letter = np.nonzero(other)
                    new_here, new_there = ranks.first[letter] + low[row, letter], there[a:b][row] + lesser[row, letter]
                    ahead, back = (new_there, new_here) if right else (new_here, new_there)
                    one = np.ones(len(row), dtype=np.int64)
                    added = Spans(whole.query[a:b][row], whole.read[a:b][row], one, ahead, back, n_of[row, letter])
                    parts.append(added)
                    swapped = added.pick(~over[a:b][row])
                    swapped.read = swapped.read + 1
                    parts.append(swapped)
            spans = Spans.joined(parts)
        query = np.concatenate([q for q, _ in found]) if found else zero[:0]
        word = np.concatenate([w for _, w in found]) if found else zero[:0]
        return query, word


# ---- Spark -------------------------------------------------------------------------------


def _halves(word: Column, size: Column) -> dict[str, tuple[Column, Column]]:
    """Per route the half of a query, and the halves of queries that a word may answer. Right halves are
    read backwards, so that both sort by the symbols that are matched first."""
    left, back = F.floor(size / 2).cast("int"), F.reverse(word)

    def both(text: Column, *lengths: Column) -> Column:
        return F.array_distinct(F.array(*[F.substring(text, F.lit(1), n) for n in lengths]))

    right = (size - left).cast("int")
    return {
        "A": (F.substring(word, F.lit(1), left), both(word, F.floor((size - 1) / 2).cast("int"), left, F.floor((size + 1) / 2).cast("int"))),
        "B": (F.substring(back, F.lit(1), right), both(back, *[(n - F.floor(n / 2)).cast("int") for n in (size - 1, size, size + 1)])),
    }


NEAR = StructType([StructField("word", StringType()), StructField("n", LongType()), StructField("near", LongType()),
                   StructField("best_n", LongType()), StructField("best", StringType())])


def _placed(words: DataFrame, half_words: int) -> DataFrame:
    """(route, half, piece, query, word, n): every word as a query and as an entry of the indexes that may answer
    for it. Halves that more than half_words entries share are cut into pieces; their queries go to each."""
    size = F.length("word")
    queries, entries = [], []
    for route, (own, others) in _halves(F.col("word"), size).items():
        queries.append(words.select(F.lit(route).alias("route"), own.alias("half"), "word", "n"))
        entries.append(words.select(F.lit(route).alias("route"), F.explode(others).alias("half"), "word", "n"))
    query, entry = queries[0].unionByName(queries[1]), entries[0].unionByName(entries[1])
    crowded = (entry.groupBy("route", "half").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > half_words)
               .select("route", "half", F.ceil(F.col("held") / half_words).cast("int").alias("pieces")))
    crowded = materialise(crowded)  # at most 4 / half_words of the vocabulary
    entry = entry.join(crowded, ["route", "half"], "left").withColumn(
        "piece", F.coalesce(F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int"), F.lit(-1)))
    query = query.join(crowded, ["route", "half"], "left").withColumn(
        "piece", F.explode(F.when(F.col("pieces").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("pieces") - 1))))
    columns = ["route", "half", "piece", "query", "word", "n"]
    return query.withColumn("query", F.lit(True)).select(*columns).unionByName(entry.withColumn("query", F.lit(False)).select(*columns))


def _indexes(batches: Iterator[pa.RecordBatch], symbols: int) -> Iterator[tuple[str, list, list]]:
    """(route, queries, entries) of one index after the other, of whole halves or of one piece. Rows come by
    half and piece, entries before queries; the queries of a piece come in blocks."""
    group, queries, entries, held = None, [], [], 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("route", "half", "piece", "query", "word", "n"))
        for route, half, piece, query, word, n in zip(*columns, strict=True):
            key = (route, half, piece)
            if key != group:
                if group is not None and (held >= symbols or group[0] != route or group[2] >= 0 or piece >= 0):
                    yield group[0], queries, entries
                    queries, entries, held = [], [], 0
                group = key
            if query:
                queries.append((word, n))
                if piece >= 0 and len(queries) >= HALF_WORDS:
                    yield route, queries, entries
                    queries = []
            else:
                entries.append((word, n))
                held += len(word) + 1
    if group is not None:
        yield group[0], queries, entries


def near_counts(words: DataFrame, index_symbols: int = INDEX_SYMBOLS, half_words: int = HALF_WORDS) -> DataFrame:
    """(word, n, near, best_n, best) of distinct words (word, n) in a-z and U+00C0 to U+00FF: how many words are near, and the
    one of largest n, of equal ones the first in code-point order. Words of one letter or none have
    no near words. An empty table gives no rows."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for route, queries, entries in _indexes(batches, index_symbols):
            if not queries:
                continue
            counts = dict(entries)
            names = sorted(counts)
            n_of = np.array([counts[w] for w in names], dtype=np.int64)
            asked = [w for w, _ in queries]
            query, word = WordIndex(names).near(asked, right=route == "A") if names else (np.zeros(0, int),) * 2
            if route == "B":  # those that begin like the query are found by its left half
                halves = [w[: len(w) // 2] for w in asked]
                fresh = np.array([not names[v].startswith(halves[q]) for q, v in zip(query.tolist(), word.tolist(), strict=True)], dtype=bool)
                query, word = query[fresh], word[fresh]
            near = np.bincount(query, minlength=len(asked))
            order = np.lexsort((word, -n_of[word], query))
            query, word = query[order], word[order]
            best = np.full(len(asked), -1)
            leads = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, int)
            best[query[leads]] = word[leads]
            at = best.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked, pa.string()), pa.array([n for _, n in queries], pa.int64()), pa.array(near, pa.int64()),
                 pa.array([None if i < 0 else counts[names[i]] for i in at], pa.int64()),
                 pa.array([None if i < 0 else names[i] for i in at], pa.string())], names=NEAR.names)

    placed = _placed(words, half_words)
    dealt = placed.repartitionByRange("route", "half", "piece").sortWithinPartitions("route", "half", "piece", "query")
    found = dealt.mapInArrow(search, NEAR)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))))
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("near"), best.alias("b")).select(
        "word", "n", "near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: the end of the chain. Chains double in frequency with each step,
    so there are few rounds, each of which halves what is left of the chains."""
    ends = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(ends.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        ends = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return ends


def variants(words: DataFrame, ratio: int = RATIO, **options) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n): its form is the near word of largest n
    if that is at least `ratio` times its own, its root the end of the chain of forms, or the word itself."""
    near = near_counts(words, **options)
    shows = F.col("best_n") >= ratio * F.col("n")
    near = materialise(near.select("word", F.when(shows, F.col("best")).alias("form"), "n", F.col("near").alias("n_near"), F.when(shows, F.col("best_n")).alias("form_n")))
    roots = _roots(near.where(F.col("form").isNotNull()))
    joined = near.join(roots, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(corpus_words(table(spark, sf_dir, "documents")))
