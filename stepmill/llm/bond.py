"""Hard negatives of anchors by BOND: branch and bound over vertically stored vectors.

Vectors become whole numbers and are stored in blocks by column: a block holds some thousand rows, one
array for each dimension, and the least and greatest value of each. An anchor reads a block's columns
in the order of its own components, largest magnitude first, and adds up partial scores. What the unread columns
can still add is bounded by their least and greatest values; rows whose bounds can't matter any more leave
the candidate bitmap, and what stays is read on to exact scores. Once the positives are sought (rows of
the anchor's label, bound: the k-th best lower bound so far), then the negatives (rows of other labels, bounds:
the score windows of all positives, and the k-th best lower bound inside each).

Every anchor block meets every block of rows, as any exact search must. The pairs are spread over stripes of
rows, so no task gets more than a few blocks of rows, whatever the number of anchors; they stream through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepmill.llm.vectors import matrix, met
from stepmill.session import materialise, quoted

#: Bytes of a block's columns, and the rows it has at most.
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 8192
#: Columns read before the bounds are tested, at first; twice as many each time after.
STEP = 4
_BLOCK = "dim int, block bigint, keys binary, labels array<string>, columns binary, lows binary, highs binary"


def vertical(rows: DataFrame) -> DataFrame:
    """(key, label, vec, dim) to blocks by column; a task's rows fill blocks of their dimension, without a shuffle."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[pa.Table]] = {}
        numbers = count(TaskContext.get().partitionId() << 33)

        def block(dim: int, table: pa.Table) -> pa.RecordBatch:
            columns = np.ascontiguousarray(matrix(table["vec"]).T)
            blobs = [table["key"].to_numpy(), columns, columns.min(1), columns.max(1)]
            keys, *vecs = [pa.array([b.tobytes()], pa.binary()) for b in blobs]
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([next(numbers)]), keys, pa.array([table["label"].to_pylist()], pa.list_(pa.string())), *vecs], names=["dim", "block", "keys", "labels", "columns", "lows", "highs"])

        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims).tolist():
                waiting.setdefault(dim, []).append(pa.Table.from_batches([batch]).filter(pa.array(dims == dim)))
                size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dim)))
                if sum(t.num_rows for t in waiting[dim]) >= size:
                    table = pa.concat_tables(waiting[dim])
                    whole = table.num_rows // size * size
                    for at in range(0, whole, size):
                        yield block(dim, table.slice(at, size))
                    waiting[dim] = [table.slice(whole)]
        for dim, tables in waiting.items():
            table = pa.concat_tables(tables)
            if table.num_rows:
                yield block(dim, table)

    return rows.select("key", "label", "vec", "dim").mapInArrow(blocks, _BLOCK)


def anchors_of(blocks: DataFrame, every: int) -> DataFrame:
    """(dim, home, place, key, label, vec) of the rows whose key divides by ``every``: block, and place in it."""

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.frombuffer(batch.column(2)[i].as_buffer(), np.int64)
                at = np.flatnonzero(keys % every == 0)
                columns = np.frombuffer(batch.column(4)[i].as_buffer(), np.float64).reshape(-1, len(keys))
                dim, home = ([batch.column(c)[i].as_py()] * len(at) for c in (0, 1))
                labels = batch.column(3)[i].values.take(pa.array(at))
                vecs = pa.array(list(columns.T[at]), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(dim, pa.int32()), pa.array(home, pa.int64()), pa.array(at), pa.array(keys[at]), labels, vecs], names=["dim", "home", "place", "key", "label", "vec"])

    return blocks.mapInArrow(picked, "dim int, home bigint, place bigint, key bigint, label string, vec array<double>")


def _kth(values: np.ndarray, k: int):
    """The ``k``-th largest value, or None where there are fewer."""
    if len(values) < k:
        return None
    # Python's own whole numbers can be sorted, not partitioned.
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, len(values) - k)[-k]


class Descent:
    """One anchor's way through the columns of a block."""

    def __init__(self, vec: np.ndarray, columns: np.ndarray, lows: np.ndarray, highs: np.ndarray):
        self.order = np.argsort(-np.abs(vec), kind="stable")
        if np.abs(vec) @ np.maximum(np.abs(lows), np.abs(highs)) >= 2.0**53:  # doubles wouldn't be exact
            vec, columns, lows, highs = (np.array([int(x) for x in a.flat], object).reshape(a.shape) for a in (vec, columns, lows, highs))
        self.vec, self.columns = vec, columns
        ends = np.stack([vec * lows, vec * highs])[:, self.order]
        # What the columns from the m-th on can add at least and at most.
        self.least, self.most = (np.append(np.cumsum(e[::-1])[::-1], 0) for e in (ends.min(0), ends.max(0)))

    def survivors(self, bitmap: np.ndarray, bounds) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the rows that stay; ``bounds(low, high)`` says which can still matter."""
        bitmap = bitmap.copy()
        scores = np.zeros(len(bitmap), self.vec.dtype)
        bitmap[bitmap] = bounds(scores[bitmap] + self.least[0], scores[bitmap] + self.most[0])
        at, step = 0, STEP
        while at < len(self.order) and bitmap.any():
            read = self.order[at : at + step]
            if bitmap.mean() > 0.5:
                scores += self.vec[read] @ self.columns[read]
            else:
                alive = np.flatnonzero(bitmap)
                scores[alive] += self.vec[read] @ self.columns[np.ix_(read, alive)]
            at, step = at + len(read), 2 * step
            bitmap[bitmap] = bounds(scores[bitmap] + self.least[at], scores[bitmap] + self.most[at])
        places = np.flatnonzero(bitmap)
        return places, scores[places]


def _leading(k: int, known):
    """Bounds of the ``k`` best rows; ``known`` is a score that ``k`` rows elsewhere reach."""

    def bounds(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        reached = [b for b in (known, _kth(low, k)) if b is not None]
        return high >= max(reached) if reached else np.ones(len(high), bool)

    return bounds


def _windowed(k: int, windows: list[tuple[int, int]], known: list):
    """Bounds of the ``k`` best rows inside each window of scores, both ends included."""

    def bounds(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        wanted = np.zeros(len(low), bool)
        for (bottom, top), before in zip(windows, known, strict=True):
            sure = low[(low >= bottom) & (high <= top)]
            floor = max(b for b in (bottom, before, _kth(sure, k)) if b is not None)
            wanted |= (high >= floor) & (low <= top)
        return wanted

    return bounds


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """The scores from ``low`` to ``high`` percent of a positive's score, as whole numbers."""
    return -(-low * positive // 100), high * positive // 100


_FOUND = "home bigint, place bigint, key bigint, goal bigint, found_block bigint, found_place bigint, found_key bigint, score bigint"


def _searched(pairs: DataFrame, k: int, low: int = 0, high: int = 0, negatives: bool = False) -> DataFrame:
    """Of each pair of an anchor group and a block the rows that can be among the ``k`` best of an anchor (and goal)."""
    columns = ["home", "members", "block", "keys", "labels", "columns", "lows", "highs"]
    limit = 2**63 - 1

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members, best = None, [], {}
        for batch in batches:
            for i in range(batch.num_rows):
                home, block = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                if home != group:
                    # A group's pairs mostly follow one another: what it found so far bounds the next block.
                    group, best = home, {}
                    members = [(m["place"].as_py(), m["key"].as_py(), m["label"].as_py(), m["vec"].values.to_numpy(), m["goals"].as_py()) for m in batch.column(1)[i]]
                keys = np.frombuffer(batch.column(3)[i].as_buffer(), np.int64)
                names: dict[str, int] = {}
                labels = np.array([names.setdefault(x, len(names)) for x in batch.column(4)[i].as_py()])
                vertical_, lows, highs = (np.frombuffer(batch.column(c)[i].as_buffer(), np.float64) for c in (5, 6, 7))
                vertical_ = vertical_.reshape(-1, len(keys))
                rows: list[tuple] = []
                for place, key, label, vec, goals in members:
                    mine = labels == names.get(label, -1)
                    if negatives:
                        windows = [window_of(g, low, high) for g in goals]
                        known = [best.get((place, g)) for g in goals]
                        places, scores = Descent(vec, vertical_, lows, highs).survivors(~mine, _windowed(k, windows, known))
                    else:
                        if home == block:
                            mine[place] = False
                        goals, windows = [0], [(None, None)]
                        places, scores = Descent(vec, vertical_, lows, highs).survivors(mine, _leading(k, best.get((place, 0))))
                    for goal, (bottom, top) in zip(goals, windows, strict=True):
                        inside = np.flatnonzero((scores >= bottom) & (scores <= top)) if negatives else np.arange(len(scores))
                        inside = inside[np.lexsort((keys[places[inside]], -scores[inside]))][:k]
                        if len(inside) == k:
                            reached = scores[inside[-1]]
                            best[place, goal] = max(reached, best.get((place, goal), reached))
                        rows += [(home, place, key, goal, block, int(places[j]), int(keys[places[j]]), min(max(int(scores[j]), -limit - 1), limit)) for j in inside]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[f.split()[0] for f in _FOUND.split(", ")])

    return pairs.select(*columns).mapInArrow(search, _FOUND)


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "found_key", "found_block", "found_place")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _grouped(anchors: DataFrame) -> DataFrame:
    """One row for the anchors of a block: ``members``."""
    member = F.struct("place", "key", "label", "vec", "goals")
    return anchors.groupBy("dim", "home").agg(F.collect_list(member).alias("members"))


def hard_negatives(
    table: DataFrame, *, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows whose key divides by ``every``.

    An anchor's positives are its ``positives`` best other rows of its label. For each one the ``negatives`` best rows
    of other labels whose score is ``low`` to ``high`` percent of the positive's are returned, best first;
    a pair without one has no row. Scores are inner products of floor(``scale`` * component); beyond 64 bits the nearest
    end. Ties go to the smaller key. Rows with a null key, label or vector, an empty vector, or a null or
    non-finite component (also once scaled) take no part; rows meet those of their own dimension. Repeated
    keys are rows of their own, as anchors and as finds. Other columns play no part; without anchors there are no rows.
    """
    scaled = F.transform(F.col(quoted(vector)).cast("array<double>"), lambda x: x * scale)
    rows = table.select(F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(label)).cast("string").alias("label"), scaled.alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("key").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0) & ~odd)
    # From 2^52 on a double is whole; floor to a long would overflow further up.
    whole = F.transform("vec", lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x))
    blocks = materialise(vertical(rows.withColumn("vec", whole).withColumn("dim", F.size("vec"))), "bond-blocks")
    anchors = materialise(anchors_of(blocks, every), "bond-anchors")
    seeking = _grouped(anchors.withColumn("goals", F.lit(None).cast("array<bigint>")))
    near = _first(_searched(met(seeking, blocks), positives), ["home", "place"], positives)
    near = materialise(near.select("home", "place", F.col("found_key").alias("positive_id"), F.col("rank").alias("positive_rank"), F.col("score").alias("goal")), "bond-positives")
    goals = near.groupBy("home", "place").agg(F.collect_set("goal").alias("goals"))
    aimed = _grouped(anchors.join(goals, ["home", "place"]))
    far = _first(_searched(met(aimed, blocks), negatives, low, high, negatives=True), ["home", "place", "goal"], negatives)
    return (
        near.join(far, ["home", "place", "goal"])
        .select(F.col("key").alias("anchor_id"), "positive_id", "rank", F.col("found_key").alias("negative_id"), F.col("goal").alias("positive_score"), F.col("score").alias("negative_score"))
    )
