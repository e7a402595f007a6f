"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

``score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``. The
pairwise part is computed in linear time from
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)``.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_class, pieces, utf8

WORD_BUCKETS = 1 << 15
BINS = 16
RANK = 8
#: Labelled documents used for fitting, at most about this many (chosen by a
#: hash of the id among all labelled rows that may be learned from).
FIT_DOCUMENTS = 8_000
EPOCHS = 12
THRESHOLD = 0.7
HELD_OUT = 2                                   # crc32(id) mod 4 of held-out rows

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SYMBOL = b"#*$%&|<>@^~_=+{}[]\\/"
_STOP = b".,;:?\"'()-"
_SPACE = b" \t\n\x0b\x0c\r"
N_STATISTICS = 18
N_META = 1
SIZE = WORD_BUCKETS + BINS * (N_STATISTICS + N_META)


def _fraction(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def statistics(text: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """Structure statistics of a text, each scaled to 0..1."""
    n, nw = len(text), len(words)
    count = [n - len(text.translate(None, c)) for c in (_UPPER, _LOWER, _DIGIT, _SYMBOL, _STOP, _SPACE, b"!")]
    upper, lower, digit, symbol, stop, space, bang = count
    ink = n - space
    lines = [x for x in text.split(b"\n") if x.strip()]
    same_next = sum(map(operator.eq, words, islice(words, 1, None)))
    top = max(counts.values(), default=0)
    log = lambda x, top=20.0: min(1.0, float(np.log2(1 + x)) / top)
    return [
        _fraction(upper, upper + lower), _fraction(digit, ink), _fraction(symbol, ink),
        _fraction(stop, ink), _fraction(bang, ink), _fraction(ink - upper - lower - digit - symbol - stop - bang, ink),
        log(symbol), log(bang), log(upper), log(digit), log(nw), log(same_next),
        _fraction(same_next, nw), _fraction(len(counts), nw), _fraction(top, nw),
        min(1.0, _fraction(ink, nw) / 32), _fraction(len(lines) - len(set(lines)), len(lines)),
        log(_fraction(n, len(lines)), 16.0),
    ]


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a document's features.

    Words are lower-cased (A-Z) and hashed; a bucket's value grows with the
    logarithm of its count and the words together have length one. Each
    statistic and the metadata (``n_chars``, null counts as the text's bytes)
    set one bin.
    """
    raw = text.split()
    counts = Counter(text.lower().split())
    stats = statistics(text, raw, counts)
    size = len(text) if n_chars is None else max(0, int(n_chars))
    stats.append(min(1.0, float(np.log2(1 + size)) / 24))
    bins = np.minimum(np.array(stats) ** 0.5 * BINS, BINS - 1).astype(np.int64)
    bins += WORD_BUCKETS + BINS * np.arange(len(stats))
    crc = zlib.crc32
    hashed = np.fromiter((crc(w) for w in counts), dtype=np.int64, count=len(counts)) % WORD_BUCKETS
    value = 1 + np.log(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
    if len(hashed):
        value /= np.linalg.norm(value)
    return np.concatenate([hashed, bins]), np.concatenate([value, np.full(len(bins), 0.5)]).astype(np.float32)


@dataclass
class Machine:
    """A fitted factorisation machine."""

    bias: float
    linear: np.ndarray          # SIZE
    factors: np.ndarray         # SIZE x RANK

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid of documents given as one ragged array."""
        weighted = self.factors[index] * value[:, None]
        total = np.add.reduceat(weighted, starts, axis=0)
        squares = np.add.reduceat(weighted * weighted, starts, axis=0)
        return (self.bias + np.add.reduceat(self.linear[index] * value, starts)
                + 0.5 * (total * total - squares).sum(axis=1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def _ragged(rows: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(i) for i, _ in rows])
    return (np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]),
            np.cumsum(sizes) - sizes)


def fit(rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS,
        rank: int = RANK, rate: float = 0.1, decay: float = 1e-4, batch: int = 64,
        seed: int = 7) -> Machine:
    """Logistic loss, both classes weighted alike, by AdaGrad on mini-batches.

    No rows, or rows of one class only, give a constant machine.
    """
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(SIZE, np.float32), rng.normal(0, 0.02, (SIZE, rank)).astype(np.float32))
    positive = float(labels.sum()) if len(labels) else 0.0
    if positive in (0.0, float(len(labels))):
        m.bias = 0.0 if not len(labels) else (5.0 if positive else -5.0)
        m.factors[:] = 0
        return m
    weight = np.where(labels == 1, 0.5 / positive, 0.5 / (len(labels) - positive)) * len(labels)
    g_bias, g_linear, g_factors = 1e-6, np.full(SIZE, 1e-6, np.float32), np.full((SIZE, rank), 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            pick = order[i:i + batch]
            index, value, starts = _ragged([rows[j] for j in pick])
            doc = np.repeat(np.arange(len(pick)), np.diff(np.append(starts, len(index))))
            v = m.factors[index]
            weighted = v * value[:, None]
            total = np.add.reduceat(weighted, starts, axis=0)
            squares = np.add.reduceat(weighted * weighted, starts, axis=0)
            score = (m.bias + np.add.reduceat(m.linear[index] * value, starts)
                     + 0.5 * (total * total - squares).sum(axis=1))
            error = (_sigmoid(score) - labels[pick]) * weight[pick] / len(pick)
            touched, place = np.unique(index, return_inverse=True)
            scaled = (error[doc] * value).astype(np.float32)
            d_linear = np.bincount(place, scaled, len(touched)) + decay * m.linear[touched]
            slope = scaled[:, None] * (total[doc] - weighted)
            d_factors = np.stack([np.bincount(place, slope[:, f], len(touched)) for f in range(rank)], axis=1)
            d_factors += decay * m.factors[touched]
            d_bias = float(error.sum())
            g_bias += d_bias ** 2
            g_linear[touched] += d_linear ** 2
            g_factors[touched] += d_factors ** 2
            m.bias -= rate * d_bias / g_bias ** 0.5
            m.linear[touched] -= rate * d_linear / np.sqrt(g_linear[touched])
            m.factors[touched] -= 0.3 * rate * d_factors / np.sqrt(g_factors[touched])
    return m


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          meta_col: str = "n_chars", label_col: str = "quality",
          documents: int = FIT_DOCUMENTS) -> Machine:
    """Fit on at most about ``documents`` labelled rows that are not held out.

    Rows of null id or label are not learned from; an id labelled more than
    once counts with its mean label (0.5 and over: 1), an id with several
    texts with one of them. Features are made on the executors; the driver
    receives the bounded sample's features only.
    """
    known = (labels.select(F.col(id_col).alias("_ll_id"), F.col(label_col).cast("double").alias("y"))
             .where(F.col("_ll_id").isNotNull() & F.col("y").isNotNull() & (crc_class(F.col("_ll_id")) != HELD_OUT))
             .groupBy("_ll_id").agg(F.avg("y").alias("y")))
    share = min(1.0, documents / max(1, known.count()))
    spread = 1 << 20
    sample = known.where(F.pmod(F.xxhash64(F.lit("fit"), "_ll_id"), F.lit(spread)) < int(share * spread))
    # about ``documents`` ids by construction, whatever the size of the table
    rows = docs.select(F.col(id_col).alias("_ll_id"), F.col(text_col).alias("text"),
                       F.col(meta_col).cast("bigint").alias("meta")).join(F.broadcast(sample), "_ll_id")
    rows = rows.select(F.col("_ll_id").cast("string").alias("id"), "text", "meta", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch):
                texts = utf8(b.column(1))
                made = [features(t, n) for t, n in zip(texts, b.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([zlib.crc32(t) for t in texts], pa.int64()), b.column(3),
                     pa.array([i.astype("<i4").tobytes() for i, _ in made], pa.binary()),
                     pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())],
                    names=["id", "crc", "y", "index", "value"])

    made = rows.mapInArrow(run, "id string, crc bigint, y double, index binary, value binary")
    one = made.groupBy("id").agg(F.min_by(F.struct("y", "index", "value"), "crc").alias("r"))
    got = sorted(one.select("id", "r.*").collect(), key=lambda r: r["id"])
    return fit([(np.frombuffer(r["index"], "<i4").astype(np.int64), np.frombuffer(r["value"], "<f4")) for r in got],
               np.array([float(r["y"] >= 0.5) for r in got]))


def scorer(machine: Machine, docs: DataFrame):
    """Column function ``score(text, metadata)`` of a fitted machine (0 to 1)."""
    held = docs.sparkSession.sparkContext.broadcast(
        (machine.bias, machine.linear.astype(np.float32), machine.factors.astype(np.float32)))

    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m = Machine(*held.value)
        for text, meta in texts:
            out = np.empty(len(text))
            for i in range(0, len(text), 256):
                made = [features(b"" if t is None else t, None if pd.isna(n) else int(n))
                        for t, n in zip(text.iloc[i:i + 256], meta.iloc[i:i + 256])]
                out[i:i + 256] = _sigmoid(m.raw(*_ragged(made)))
            yield pd.Series(out)

    def column(text: Column, meta: Column) -> Column:
        return score(text.cast("binary"), meta.cast("bigint"))

    return column


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             meta_col: str = "n_chars", label_col: str = "quality",
             threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Every text is scored, null and empty ones too; repeated rows each keep
    theirs; a null id is never held out (it cannot be labelled). An empty
    table gives no rows; empty labels a score of 0.5 for all.
    """
    score = scorer(train(docs, labels, id_col, text_col, meta_col, label_col), docs)
    return (docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col), F.col(meta_col)).alias("score"))
            .select("doc_id", F.coalesce(crc_class(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              meta_col: str = "n_chars", label_col: str = "quality",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, decided row by row."""
    score = scorer(train(docs, labels, id_col, text_col, meta_col, label_col), docs)
    return docs.where(score(F.col(text_col), F.col(meta_col)) >= threshold)
