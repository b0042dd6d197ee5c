"""Document quality by Bradley-Terry pairwise ranking.

Every document gets a strength: the sum of weights of its features. In a pair of a preferred (label 1)
and a rejected (label 0) document, the preferred one wins with the logistic probability of the
difference of strengths; the weights minimise that logistic loss over pairs of a bounded labelled
sample. The acceptance threshold is a quantile of the strengths of all documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidemark.llm.common import prepare, is_held_out, materialise, table, utf8_list
from tidemark.llm.learn import fit_logistic, label_sample, sigmoid

#: bounds of what is learnt from labelled rows
SAMPLE_PER_CLASS = 4000
PAIRS = 60_000
BINS = 12
RIDGE = 2.0
ACCEPT = 0.3

_UPPER, _LOWER, _DIGIT = (np.arange(256)[list(r)] for r in (range(65, 91), range(97, 123), range(48, 58)))
_HIGH = np.arange(128, 256)
_STOPS, _BLANK = np.frombuffer(b".,;:?'\"()-", np.uint8), np.frombuffer(b" \t\r\n\x0b\x0c", np.uint8)
_SYMBOLS = np.array([b for b in range(33, 127) if not (chr(b).isalnum() or b in _STOPS)])

FEATURES = ("chars", "words", "word_length", "word_spread", "upper", "digit", "stops", "symbols", "blank", "high", "entropy",
            "distinct", "top_word", "doubled", "short_words", "marked_words", "lines", "distinct_lines", "line_words", "ended_lines", "bars", "shouts",
            "capital_words", "distinct_pairs")


def features(data: bytes) -> list[float]:
    """Shape of a text: characters, words, lines and their repetition. All zero for an empty one."""
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, w = len(data), len(words)
    histogram = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    share = histogram[histogram > 0] / n
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=w)
    count = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    letters = max(1, int(histogram[_UPPER].sum() + histogram[_LOWER].sum() + histogram[_HIGH].sum()))
    return [
        float(np.log1p(n)), float(np.log1p(w)), float(lengths.mean()), float(lengths.std()),
        float(histogram[_UPPER].sum() / letters), float(histogram[_DIGIT].sum() / n), float(histogram[_STOPS].sum() / n),
        float(histogram[_SYMBOLS].sum() / n), float(histogram[_BLANK].sum() / n), float(histogram[_HIGH].sum() / n), float(-(share * np.log(share)).sum()),
        len(count) / w, max(count.values()) / w, sum(map(bytes.__eq__, words, words[1:])) / w,
        float((lengths <= 3).mean()), sum(not word[-1:].isalpha() and word[-1] < 128 for word in words) / w,
        float(np.log1p(len(lines))), len(set(lines)) / len(lines), w / len(lines), sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines) / len(lines),
        float(histogram[124] / w), float(histogram[33] / w),
        sum(word.isupper() for word in words) / w, len(set(zip(words, words[1:], strict=False))) / w,
    ]


def text_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, features) of every row; a null text is empty."""
    prepare(docs.sparkSession)
    schema = StructType([docs.schema["doc_id"], StructField("features", ArrayType(DoubleType()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in utf8_list(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=schema.names)

    return docs.select("doc_id", text).mapInArrow(measure, schema)


class Ranking:
    """Strengths: a weight for the quantile bin of each feature."""

    def __init__(self, x: np.ndarray, bins: int = BINS):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
        self.offsets = np.concatenate([[0], np.cumsum([len(e) + 1 for e in self.edges])])
        self.weights = np.zeros(self.offsets[-1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="right") + o for e, c, o in zip(self.edges, x.T, self.offsets, strict=False)], axis=1)

    def one_hot(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.weights)), dtype=np.float32)
        np.put_along_axis(out, self.cells(x), 1, axis=1)
        return out

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.cells(x)].sum(axis=1)

    def fit(self, preferred: np.ndarray, rejected: np.ndarray, pairs: int = PAIRS) -> None:
        """Logistic loss of feature differences over pairs drawn evenly from both sides."""
        draw = np.random.default_rng(7)
        n = min(pairs, len(preferred) * len(rejected))
        a = np.concatenate([draw.permutation(len(preferred)) for _ in range(-(-n // len(preferred)))])[:n]
        b = np.concatenate([draw.permutation(len(rejected)) for _ in range(-(-n // len(rejected)))])[:n]
        good, bad = self.one_hot(preferred), self.one_hot(rejected)
        # a document in many pairs is one observation, so a pair weighs less than one
        weight = np.full(n, (len(preferred) + len(rejected)) / n if n else 0.0)
        self.weights = fit_logistic(good[a] - bad[b], np.ones(n), weight, RIDGE, steps=25)


def train(measured: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[Ranking, float, float, float]:
    """Ranking, slope of the score, quantile of the threshold, share of preferred documents."""
    chosen, totals = label_sample(labels, "quality", per_class)
    joined = measured.join(F.broadcast(chosen), "doc_id")  # at most 2 * SAMPLE_PER_CLASS rows
    rows = joined.groupBy("doc_id").agg(F.min("features").alias("features"), F.first("label").alias("label"), F.first("fold").alias("fold")).collect()
    x = np.array([r.features for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    y, fold = np.array([r.label for r in rows]), np.array([r.fold for r in rows])
    share = (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)
    ranking = Ranking(x)
    if not 0 < y.sum() < len(y):
        return ranking, 1.0, 0.0, share
    out_of_fold = np.zeros(len(y))
    for f in np.unique(fold):
        here, part = fold == f, Ranking(x[fold != f])
        if 0 < y[~here].sum() < (~here).sum():
            part.fit(x[~here & (y == 1)], x[~here & (y == 0)])
            out_of_fold[here] = part.strength(x[here])
    weight = np.where(y == 1, totals[1] / (y == 1).sum(), totals[0] / (y == 0).sum())
    slope, shift = fit_logistic(np.stack([out_of_fold, np.ones(len(y))], axis=1), y.astype(float), weight / weight.mean(), 1e-3)
    accepted = sigmoid(slope * out_of_fold + shift) >= ACCEPT
    ranking.fit(x[y == 1], x[y == 0])
    return ranking, max(float(slope), 1e-3), float((weight * ~accepted).sum() / weight.sum()), share


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, strength, score) of every row of docs.

    The score is 0.3 where the strength equals the threshold: the quantile, over all of docs, below
    which the labelled sample's out-of-fold strengths give less than 0.3 of preference. Above it the
    score rises logistically to 1. Empty and null texts have all features 0; equal texts have equal
    scores; repeated rows and rows without id are scored like others. Without labels of both classes
    all scores equal the share of preferred labels. An empty table gives no rows. Labels, ids and
    other columns never enter a score.
    """
    measured = materialise(text_features(docs, text))
    ranking, slope, quantile, share = train(measured, labels)
    shared = docs.sparkSession.sparkContext.broadcast(ranking)
    schema = StructType([docs.schema["doc_id"], StructField("strength", DoubleType())])

    def strength(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.strength(x))], names=schema.names)

    strengths = measured.mapInArrow(strength, schema)
    if not quantile and not ranking.weights.any():
        return strengths.withColumn("score", F.lit(float(share)))
    threshold = strengths.agg(F.percentile_approx("strength", float(quantile), 10_000)).first()[0]
    level = float(np.log(ACCEPT / (1 - ACCEPT)))
    # the threshold itself is accepted: keep rounding from taking it below
    score = F.when(F.col("strength") == F.lit(threshold), F.lit(ACCEPT)).otherwise(
        1 / (1 + F.exp(-(F.lit(slope) * (F.col("strength") - F.lit(threshold)) + F.lit(level)))))
    return strengths.withColumn("score", score)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"), "strength")
