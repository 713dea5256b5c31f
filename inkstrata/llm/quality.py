"""Document quality: counts of words, lines and repeats, and a hashed n-gram classifier.

The classifier is Spark's logistic regression on hashed word and character n-grams,
each kind as shares of its own total, fitted on a bounded sample of labelled rows and
calibrated on a part of it that it has not seen. Documents are scored in Arrow
batches: the score is the mean weight of the n-grams of each kind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.llm.common import hold, schema_with, slices, texts_of
from inkstrata.session import materialize

WORD_BITS = CHAR_BITS = 16
CHAR_N = 4
# Labelled rows to fit on: all up to this number, beyond it a hash sample of about as many.
MAX_ROWS = 2000
# Rules: fewest words, largest share of words in repeated runs, least probability of quality.
MIN_WORDS, MAX_REPEATED, MIN_PROBABILITY = 50, 0.5, 0.5
# Steps of the regression and its quadratic penalty.
MAX_ITER, PENALTY = 100, 1e-6
# Rows of the sample in a partition: gradients of few partitions are added up without a shuffle.
PART_ROWS = 500
_RUN = 3

_WORDS, _CHARS = 1 << WORD_BITS, 1 << CHAR_BITS
_SPACE = " \t\n\x0b\f\r"
# Signs that are counted.
_SYMBOLS = b"#*$%&|<>"


def words_of(text: str) -> list[bytes]:
    """Words parted by ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split()


def hashed(data: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the word n-grams (one and two words) and of the character n-grams (bytes)."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    single = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    pairs = single[:-1] * np.uint64(0x9E3779B1) ^ single[1:] * np.uint64(0x85EBCA77)
    mixed = np.concatenate([single, pairs]) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - WORD_BITS)
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    width = max(len(b) - CHAR_N + 1, 1)
    grams = np.zeros(width, np.uint32)
    for at in range(min(CHAR_N, len(b))):
        grams = grams << np.uint32(8) | b[at : at + width]
    return mixed.astype(np.int64), (grams * np.uint32(0x9E3779B1) >> np.uint32(32 - CHAR_BITS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Weights by n-gram number, and the calibration of their sum."""

    words: np.ndarray
    chars: np.ndarray
    slope: float
    offset: float

    def probability(self, data: bytes, words: list[bytes]) -> float:
        """Probability of quality; 0 without words."""
        if not words:
            return 0.0
        w, c = hashed(data, words)
        z = self.slope * (self.words[w].mean() + self.chars[c].mean()) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """``word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    data_symbols = text.encode("utf-8", "surrogatepass")
    symbols = len(data_symbols) - len(data_symbols.translate(None, _SYMBOLS))
    chars = len(text) - sum(text.count(c) for c in _SPACE)
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    repeated = 0
    if len(words) > _RUN:
        # hashes of one process are enough to tell the runs of one text apart
        h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).astype(np.uint64)
        size = len(words) - _RUN + 1
        runs = np.zeros(size, np.uint64)
        for at in range(_RUN):
            runs = (runs ^ h[at : at + size]) * np.uint64(0x9E3779B97F4A7C15)
            runs ^= runs >> np.uint64(29)
        values, times = np.unique(runs, return_counts=True)
        if len(values) < size:
            often = np.flatnonzero(np.isin(runs, values[times > 1]))
            covered = np.zeros(len(words), dtype=bool)
            for at in range(_RUN):
                covered[often + at] = True
            repeated = int(covered.sum())
    return chars, symbols, len(lines) - len(set(lines)), repeated


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``label, part`` and the shares of the n-grams of each text, by ascending number."""
    for batch in slices(batches):
        numbers, shares = [], []
        for text in texts_of(batch.column(1)):
            data = text.encode("utf-8", "surrogatepass")
            w, c = hashed(data, data.split())
            own, values = [], []
            for part, base in ((w, 0), (c, _WORDS)):
                which, times = np.unique(part, return_counts=True)
                own.append(which + base)
                values.append(times / max(len(part), 1))
            numbers.append(np.concatenate(own).astype(np.int32))
            shares.append(np.concatenate(values).astype(np.float64))
        lists = [pa.array(numbers, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *lists], names=["label", "part", "numbers", "shares"])


@F.udf(VectorUDT())
def _vector(numbers: list[int], shares: list[float]) -> SparseVector:
    return SparseVector(_WORDS + _CHARS, numbers, shares)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _calibrated(z: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, with smoothed targets, by Newton steps."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = max(float(np.abs(z).mean()), 1e-9)
    x = np.stack([z / scale, np.ones_like(z)])
    theta = np.zeros(2)
    for _ in range(50):
        p = _logistic(theta @ x)
        hessian = (x * (p * (1 - p))) @ x.T + 1e-4 * np.eye(2)
        theta -= np.linalg.solve(hessian, x @ (p - target) + 1e-4 * theta)
    return float(theta[0] / scale), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model | None:
    """The classifier from ``labels`` (``doc_id, quality``); None where both kinds are not there.

    One row for each id (any label of quality counts); rows without an id or a label
    are left out. A quarter of the sample is for calibration.
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    own = materialize(own.groupBy("doc_id").agg(F.max(F.col("quality").cast("double")).alias("label")), "labels")
    share = min(1.0, max_rows / max(own.count(), 1))
    drawn = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(round(share * 1_000_000)))
    drawn = drawn.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)).cast("int"))
    # bounded by max_rows: of rows that repeat an id, the least text
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "label", "part").agg(F.min("text").alias("text"))
    made = rows.select("label", "text", "part").mapInArrow(_sample, "label double, part int, numbers array<int>, shares array<double>")
    made = materialize(made, "training").select("label", "part", _vector("numbers", "shares").alias("ngrams"))
    if made.select(F.col("part") > 0, "label").distinct().count() < 4:
        return None
    regression = LogisticRegression(featuresCol="ngrams", labelCol="label", maxIter=MAX_ITER, regParam=PENALTY, standardization=False)
    found = regression.fit(made.where("part > 0").repartition(max(1, max_rows // PART_ROWS)))
    margins = found.transform(made.where("part = 0")).select(vector_to_array("rawPrediction")[1].alias("z"), "label").collect()
    z, y = (np.array([r[i] for r in margins]) for i in (0, 1))
    slope, offset = _calibrated(z, y)
    weights = found.coefficients.toArray().copy()
    # the bias goes into the word weights: their shares add up to one
    weights[:_WORDS] += found.intercept
    return Model(weights[:_WORDS].astype(np.float32), weights[_WORDS:].astype(np.float32), slope, offset)


def judge(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the counts, ``base_failed``, ``quality`` and ``kept`` for each row of ``docs``.

    A document fails the base rules with fewer than 50 words or with more than half of
    its words in repeated runs of three; otherwise it is kept if its probability of
    quality is at least ``MIN_PROBABILITY``. A null text has no words. Without labels of
    both kinds the base rules decide alone, and ``quality`` is null. A kept column
    named as one of the new ones is an error; columns that are not kept may have any name.
    """
    clash = sorted(set(map(str.lower, keep)) & set(_COLUMNS))
    if clash:
        raise ValueError(f"kept columns have the names given here: {', '.join(clash)}")
    model = fit(docs, labels, max_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("quality")
        model = shared.value
        for batch in slices(batches):
            rows = []
            for text in texts_of(batch.columns[-1]):
                data = text.encode("utf-8", "surrogatepass")
                words = data.split()
                found = counts(text, words)
                failed = len(words) < MIN_WORDS or found[3] > MAX_REPEATED * len(words)
                quality = None if model is None else model.probability(data, words)
                rows.append((len(words), *found, failed, quality, not failed and (quality is None or quality >= MIN_PROBABILITY)))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=[*batch.schema.names[:-1], *_COLUMNS])

    schema = schema_with(docs, list(keep), _DDL)
    return docs.select(*keep, "text").mapInArrow(run, schema)


_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality", "kept"]
_DDL = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, quality double, kept boolean"
