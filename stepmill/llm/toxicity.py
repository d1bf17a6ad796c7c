"""Toxicity grades by cumulative-link ordinal regression on hashed words.

One weight vector serves all thresholds: P(grade >= k) = sigmoid(w.x - theta_k) with rising theta, fitted
to labelled rows by gradient descent. Features are the distinct words of a text, hashed. The fit is small
and bounded; scoring goes over whole texts in the tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmill.llm.common import fresh, lowest_by_hash, text_of
from stepmill.session import quoted

_WORD = re.compile(r"\w+")
#: Words whose buckets a task remembers at most.
REMEMBERED = 1_000_000
#: Words of learning texts handled at once.
RUN = 1 << 20


class Buckets(dict):
    """Word to bucket, remembered."""

    def __init__(self, bits: int):
        super().__init__()
        self.bits = bits

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = bucket = zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << self.bits) - 1)
        return bucket

    def of(self, text: str) -> np.ndarray:
        """The distinct buckets of a text's words, a long text in parts."""
        found: set[int] = set()
        for at, end in _parts(text):
            found.update(map(self.__getitem__, set(_WORD.findall(text[at:end].lower()))))
        return np.fromiter(found, np.int64, len(found))


def _parts(text: str, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and (text[end].isalnum() or text[end] == "_"):
            end += 1
        yield at, end
        at = end


@dataclass
class Model:
    bits: int
    weights: np.ndarray
    thresholds: np.ndarray  # rising, one for each grade from 1 on

    def above(self, rows: list[np.ndarray]) -> np.ndarray:
        """P(grade >= k) for k from 1 on, [row, threshold]."""
        sizes = np.array([len(r) for r in rows])
        of = np.repeat(np.arange(len(rows)), sizes)
        score = np.bincount(of, self.weights[np.concatenate(rows)] if len(of) else None, len(rows)) if len(of) else np.zeros(len(rows))
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -40, 40)))


def fit(rows: list[np.ndarray], grades: np.ndarray, bits: int, *, support: float = 6.0, rounds: int = 300, rate: float = 0.05) -> Model:
    """Adam on the ordinal log likelihood with an L1 penalty. Grades are 0, 1, ...

    ``support`` is the penalty in rows: a word gets a weight only if what it explains is worth that many
    rows, so words that happen to stand in a few toxic texts stay at 0. The words so chosen are then
    fitted again with a thousandth of the penalty, which would else hold their weights down. Weights are never
    negative: a word can raise the grade, but much harmless text around it can't lower it.
    """
    first = _descend(rows, grades, bits, support, rounds, rate)
    chosen = first.weights != 0
    return _descend([r[chosen[r]] for r in rows], grades, bits, support / 1000, 2 * rounds, rate)


def _descend(rows: list[np.ndarray], grades: np.ndarray, bits: int, support: float, rounds: int, rate: float) -> Model:
    top = int(grades.max()) if len(grades) else 0
    if not top:
        return Model(bits, np.zeros(1 << bits), np.array([40.0]))
    sizes = np.array([len(r) for r in rows])
    there = np.zeros(1 << bits, bool)
    for row in rows:
        there[row] = True
    used = np.flatnonzero(there)
    number = np.cumsum(there, dtype=np.int32) - 1
    # Rows and words in runs of a million or so, so a step's arrays stay small.
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // RUN, prepend=-1))
    runs = [
        (begin, end, np.repeat(np.arange(end - begin, dtype=np.int32), sizes[begin:end]), number[np.concatenate(rows[begin:end])])
        for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(rows)], strict=True)
    ]
    share = [max(np.mean(grades >= k), 1e-6) for k in range(1, top + 1)]
    # Thresholds are the first one and positive steps, kept apart by their logarithms.
    theta = -np.log(np.array(share) / (1 - np.minimum(share, 1 - 1e-6)))
    x = np.r_[np.zeros(len(used)), theta[0], np.log(np.maximum(np.diff(theta), 1e-3))]
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, rounds + 1):
        w, t = x[: len(used)], np.cumsum(np.r_[x[len(used)], np.exp(x[len(used) + 1 :])])
        score = np.concatenate([np.bincount(of, w[at], end - begin) for begin, end, of, at in runs])
        p = np.c_[np.ones(len(rows)), 1 / (1 + np.exp(-(score[:, None] - t).clip(-40, 40))), np.zeros(len(rows))]
        slope = p * (1 - p)
        own = np.arange(len(rows))
        upper, lower = p[own, grades], p[own, grades + 1]
        chance = np.maximum(upper - lower, 1e-9)
        d_score = -(slope[own, grades] - slope[own, grades + 1]) / chance / len(rows)
        d_t = np.zeros(top)
        for k in range(1, top + 1):
            d_t[k - 1] = (np.sum((slope[:, k] / chance)[grades == k]) - np.sum((slope[:, k] / chance)[grades == k - 1])) / len(rows)
        tail = np.cumsum(d_t[::-1])[::-1]
        d_words = sum(np.bincount(at, d_score[begin:end][of], len(used)) for begin, end, of, at in runs)
        g = np.r_[d_words, tail[0], tail[1:] * np.exp(x[len(used) + 1 :])]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        pace = rate / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        x -= pace * (m / (1 - 0.9**step))
        words = x[: len(used)]
        words[:] = np.maximum(words - pace[: len(used)] * support / len(rows), 0)
    weights = np.zeros(1 << bits)
    weights[used] = x[: len(used)]
    return Model(bits, weights, np.cumsum(np.r_[x[len(used)], np.exp(x[len(used) + 1 :])]))


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", grade: str = "grade", bits: int = 18, max_rows: int = 20_000) -> Model:
    """Fit on at most ``max_rows`` labelled keys, picked by hash; rows without a key or grade are left out.

    Of a key with several grades the highest counts; of several documents of a key the one whose text has the
    smallest hash is taken, so every run learns the same. Only bucket numbers come to the driver. Without a
    graded row above 0 nothing is toxic. Grades are those of the labels: of labels that say only toxic or not there
    is one threshold, and the severity is the probability.
    """
    graded_keys = labels.select(F.col(quoted(key)).alias("key"), F.col(quoted(grade)).cast("int").alias("grade")).dropna().groupBy("key").agg(F.max("grade").alias("grade"))
    picked = lowest_by_hash(graded_keys, ["key"], max_rows, "key")
    texts = docs.select(F.col(quoted(key)).alias("key"), text_of(text).alias("text")).join(F.broadcast(picked), "key")

    @F.pandas_udf("binary")
    def hashed(found: pd.Series) -> pd.Series:
        buckets = Buckets(bits)
        return found.map(lambda t: buckets.of(t).astype(np.int32).tobytes())

    first = texts.select("key", F.struct(F.xxhash64("text").alias("mark"), "grade", hashed("text").alias("buckets")).alias("of")).groupBy("key").agg(F.min("of").alias("of"))
    found = first.select("key", "of.grade", "of.buckets").orderBy(F.xxhash64("key"), "key").toPandas()
    rows, grades = [np.frombuffer(b, np.int32) for b in found["buckets"]], found["grade"].to_numpy(np.int64)
    return fit(rows, grades, bits, support=support_of(grades))


def support_of(grades: np.ndarray) -> float:
    """The penalty in rows: one in a hundred of the rows above grade 0, from 3 to 6."""
    return float(np.clip(0.01 * np.count_nonzero(grades), 3, 6))


def graded(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All rows with ``severity`` (expected grade), ``grade`` (the most likely one) and ``p_toxic`` (grade above 0).

    A null or wordless text is scored without features, by the thresholds alone. Existing columns of
    these names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2^bits weights
    added = ["severity", "grade", "p_toxic"]
    others = [c for c in docs.columns if c.lower() not in added]
    source = fresh(docs, "_text")
    schema = docs.select(*[quoted(c) for c in others]).schema.add("severity", "double").add("grade", "integer").add("p_toxic", "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(held.value.bits)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                above = held.value.above([buckets.of(t) for t in batch.column(len(others)).to_pylist()])
                each = -np.diff(np.c_[np.ones(len(above)), above, np.zeros(len(above))], axis=1)
                columns = [pa.array(above.sum(1)), pa.array(each.argmax(1).astype(np.int32)), pa.array(above[:, 0])]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *columns], names=others + added)

    return docs.select(*[quoted(c) for c in others], text_of(text).alias(source)).mapInArrow(scored, schema)
