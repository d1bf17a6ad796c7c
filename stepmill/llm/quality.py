"""Text quality by a generalised additive model with pairwise interactions.

Each text is described by some numbers that need no vocabulary (lengths, shares of kinds of characters, words
and lines, repetition). The model is an intercept, one lookup table for each number over its bins, and
a small two-way table for each of the strongest pairs. The tables grow by cyclic boosting: in every round each
number in turn gets a shallow tree of its own bins, fitted to what is still unexplained, at a low rate; then
the pairs do. Rounds stop where a held-back fifth of the learning rows says so. Scoring adds bins up.

The fit is bounded (``max_rows``); describing and scoring texts runs in the tasks, without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmill.llm.common import lowest_by_hash, text_of
from stepmill.session import quoted

#: Bytes of a text described at once; texts are cut at blanks.
PIECE = 1 << 20
NAMES = (
    "words word_length sentence_length line_length letters upper digits marks other blanks upper_words "
    "bare_words mark_ends stop_ends distinct top_word doubled repeated_lines spread"
).split()

_BYTE = np.arange(256)
_BLANK = np.isin(_BYTE, list(b" \t\n\v\f\r"))
_UPPER, _DIGIT = (_BYTE >= 65) & (_BYTE <= 90), (_BYTE >= 48) & (_BYTE <= 57)
# Bytes beyond ASCII are parts of letters, nearly always.
_LETTER = _UPPER | (_BYTE >= 97) & (_BYTE <= 122) | (_BYTE >= 128)
_STOP = np.isin(_BYTE, list(b".!?"))
_MARK = np.isin(_BYTE, list(b".,;:!?'\"()-"))
_OTHER = ~(_BLANK | _LETTER | _DIGIT | _MARK)


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and not _BLANK[text[end]]:
            end += 1
        yield text[at:end]
        at = end


def described(text: bytes) -> np.ndarray:
    """The numbers of ``NAMES`` for a whole text; all zero without a word."""
    histogram = np.zeros(256, np.int64)
    kinds: Counter[bytes] = Counter()
    lines: Counter[bytes] = Counter()
    upper_words = bare_words = mark_ends = stop_ends = doubled = 0
    last = None
    for piece in _pieces(text):
        values = np.frombuffer(piece, np.uint8)
        histogram += np.bincount(values, minlength=256)
        words = piece.split()
        if not words:
            continue
        kinds.update(words)
        lines.update(filter(None, map(bytes.strip, piece.split(b"\n"))))
        doubled += sum(map(eq, words, words[1:])) + (words[0] == last)
        last = words[-1]
        blank = _BLANK[values]
        edge = np.diff(np.r_[True, blank, True].astype(np.int8))
        begins, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        letters, uppers = (np.r_[0, np.cumsum(kind[values], dtype=np.int32)] for kind in (_LETTER, _UPPER))
        in_word = letters[ends] - letters[begins]
        bare_words += int(np.count_nonzero(in_word == 0))
        upper_words += int(np.count_nonzero((uppers[ends] - uppers[begins] == in_word) & (in_word > 1)))
        final = values[ends - 1]
        mark_ends += int(np.count_nonzero(_OTHER[final]))
        stop_ends += int(np.count_nonzero(_STOP[final]))
    count = sum(kinds.values())
    if not count:
        return np.zeros(len(NAMES))
    # Bytes that only continue a letter aren't counted as characters.
    characters = max(int(histogram.sum() - histogram[128:192].sum()), 1)
    solid = max(int(histogram[~_BLANK].sum()), 1)
    shares = histogram[histogram > 0] / histogram.sum()
    row = [
        np.log1p(count), (characters - histogram[_BLANK].sum()) / count, np.log(count / max(stop_ends, 1)), np.log(count / max(lines.total(), 1)),
        histogram[_LETTER].sum() / solid, histogram[_UPPER].sum() / max(histogram[_LETTER].sum(), 1), histogram[_DIGIT].sum() / solid, histogram[_MARK].sum() / solid,
        histogram[_OTHER].sum() / solid, histogram[_BLANK].sum() / characters, upper_words / count, bare_words / count, mark_ends / count, stop_ends / count,
        len(kinds) / count, max(kinds.values()) / count, doubled / count, 1 - len(lines) / max(lines.total(), 1), -(shares * np.log2(shares)).sum(),
    ]
    return np.array(row, float)


@dataclass
class Model:
    """Lookup tables: ``cuts`` and ``tables`` for each number, and ``pairs`` (two numbers, their coarse cuts, a table)."""

    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """P(label 1) of described texts: bins looked up and added."""
        total = np.full(len(rows), self.intercept)
        for i, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, rows[:, i], "right")]
        for i, j, first, second, table in self.pairs:
            total += table[np.searchsorted(first, rows[:, i], "right"), np.searchsorted(second, rows[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Places between the values' quantiles, at most ``bins - 1``."""
    kinds = np.unique(values)
    if len(kinds) <= bins:
        return (kinds[1:] + kinds[:-1]) / 2
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray, ridge: float, least: int) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins; 0 and 0 where there is none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain[(nl < least) | (nr < least)] = 0
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, ridge: float, least: int, depth: int = 2) -> np.ndarray:
    """A value for each bin: a tree of ``depth`` cuts on one number, by Newton steps."""
    _, at = _split(g, h, n, ridge, least) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), -g.sum() / (h.sum() + ridge))
    return np.r_[_tree(g[:at], h[:at], n[:at], ridge, least, depth - 1), _tree(g[at:], h[at:], n[at:], ridge, least, depth - 1)]


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, ridge: float, least: int) -> tuple[float, np.ndarray]:
    """Gain and values of a tree that cuts one number, then the other on both sides; the better order of the two."""
    best = (0.0, np.full(g.shape, -g.sum() / (h.sum() + ridge)))
    for turn in (False, True):
        a, b, c = (x.T if turn else x for x in (g, h, n))
        for at in range(1, len(a)):
            gain, halves = -(g.sum() ** 2) / (h.sum() + ridge), []
            for part in (slice(0, at), slice(at, None)):
                gs, hs, ns = a[part].sum(0), b[part].sum(0), c[part].sum(0)
                more, place = _split(gs, hs, ns, ridge, least)
                gain += more + gs.sum() ** 2 / (hs.sum() + ridge)
                values = _tree(gs, hs, ns, ridge, least, 1) if place else np.full(len(gs), -gs.sum() / (hs.sum() + ridge))
                halves.append(np.tile(values, (a[part].shape[0], 1)))
                if ns.sum() < least:
                    gain = 0.0
                    break
            if gain > best[0]:
                values = np.concatenate(halves)
                best = (gain, values.T if turn else values)
    return best


def _loss(score: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, score) - y * score))


def fit(rows: np.ndarray, labels: np.ndarray, *, bins: int = 32, pair_bins: int = 8, pairs: int = 6, rounds: int = 300, pair_rounds: int = 100, rate: float = 0.1, ridge: float = 1.0, least: int = 5, patience: int = 25) -> Model:
    """Boost the tables on described texts and labels from 0 to 1. Every fifth row is held back to choose the number of rounds."""
    if not len(labels):
        return Model(0.0, [np.zeros(0)] * len(NAMES), [np.zeros(1)] * len(NAMES))
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    start = float(np.log(share / (1 - share)))
    held = np.arange(len(labels)) % 5 == 4 if len(labels) >= 50 else np.zeros(len(labels), bool)
    cuts = [_cuts(x, bins) for x in rows.T]
    coarse = [_cuts(x, pair_bins) for x in rows.T]
    binned = [np.searchsorted(c, x, "right") for c, x in zip(cuts, rows.T, strict=True)]
    broad = [np.searchsorted(c, x, "right") for c, x in zip(coarse, rows.T, strict=True)]
    # Held-back rows carry no weight in the trees.
    weight = np.where(held, 0.0, 1.0)
    score = np.full(len(labels), start)

    def sums(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return tuple(np.bincount(at, w * weight, size) for w in (p - labels, np.maximum(p * (1 - p), 1e-6), np.ones(len(p))))

    def boosted(places: list[np.ndarray], tables: list[np.ndarray], most: int, grown) -> list[np.ndarray]:
        """Cyclic rounds over all tables; the tables of the best round."""
        nonlocal score
        best, kept, kept_score, since = _loss(score[held], labels[held]) if held.any() else np.inf, [t.copy() for t in tables], score, 0
        for _ in range(most):
            for at, table in zip(places, tables, strict=True):
                step = rate * grown(*(x.reshape(table.shape) for x in sums(at, table.size)))
                table += step
                score = score + step.ravel()[at]
            now = _loss(score[held], labels[held]) if held.any() else _loss(score, labels)
            since += 1
            if now < best - 1e-6:
                best, kept, kept_score, since = now, [t.copy() for t in tables], score, 0
            if since >= patience:
                break
        score = kept_score
        return kept

    tables = boosted(binned, [np.zeros(len(c) + 1) for c in cuts], rounds, lambda g, h, n: _tree(g, h, n, ridge, least))
    ranked = []
    for i, j in combinations(range(len(cuts)), 2):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        at = broad[i] * shape[1] + broad[j]
        gain, _ = _pair_tree(*(x.reshape(shape) for x in sums(at, shape[0] * shape[1])), ridge, least)
        ranked.append((-gain, i, j, shape, at))
    chosen = [r for r in sorted(ranked, key=lambda r: r[:3])[:pairs] if r[0] < 0]
    two_way = boosted([r[4] for r in chosen], [np.zeros(r[3]) for r in chosen], pair_rounds if chosen else 0, lambda g, h, n: _pair_tree(g, h, n, ridge, least)[1])
    # Main tables are centred on the learning rows; the intercept takes what they lose.
    for at, table in zip(binned, tables, strict=True):
        mean = table[at].mean()
        table -= mean
        start += mean
    return Model(start, cuts, tables, [(i, j, coarse[i], coarse[j], t) for (_, i, j, _, _), t in zip(chosen, two_way, strict=True)])


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 20_000) -> Model:
    """Fit on at most ``max_rows`` labelled keys, those with the smallest hash.

    A key with several labels counts with their mean; of several documents of a key the one whose text has the
    smallest hash is taken, so every run learns the same. Rows without a key or label are left out; an
    empty or null text is a text. Only the numbers of the texts come to the driver.
    """
    of_key = labels.select(F.col(quoted(key)).alias("key"), F.col(quoted(label)).cast("double").alias("label")).dropna().groupBy("key").agg(F.avg("label").alias("label"))
    known = of_key.join(docs.select(F.col(quoted(key)).alias("key")).distinct(), "key", "left_semi")
    picked = lowest_by_hash(known, ["key"], max_rows, "key")
    texts = docs.select(F.col(quoted(key)).alias("key"), text_of(text).alias("text")).join(F.broadcast(picked), "key")

    @F.pandas_udf("array<double>")
    def numbers(found: pd.Series) -> pd.Series:
        return found.map(lambda t: described(t.encode("utf-8", "surrogatepass")))

    first = texts.withColumn("mark", F.xxhash64("text")).select("key", "label", "mark", numbers("text").alias("row")).groupBy("key").agg(F.min(F.struct("mark", "label", "row")).alias("of"))
    found = first.select("key", "of.label", "of.row").orderBy(F.xxhash64("key"), "key").toPandas()
    rows = np.array(found["row"].tolist(), float).reshape(len(found), len(NAMES))
    return fit(rows, np.clip(found["label"].to_numpy(float), 0, 1))


def scored(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` (P(label 1), 0 to 1) and ``predicted`` (1 from 0.5 on) of every row.

    A null text counts as empty; a text without a word is scored by all-zero numbers. Null keys and repeated
    rows all come back; other columns of ``docs`` play no part. A model that saw no label says 0.5.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers
    source = docs.select(F.col(quoted(key)).alias("key"), text_of(text).cast("binary").alias("text"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [described(batch.column(1)[i].as_py()) for i in range(batch.num_rows)]
            score = held.value.score(np.array(rows).reshape(len(rows), len(NAMES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["key", "score", "predicted"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(judged, f"key {kind}, score double, predicted int").withColumnRenamed("key", key)
