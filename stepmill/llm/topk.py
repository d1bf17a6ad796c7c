"""Exact top-k by integer inner product: norm-sorted blocks, and partial sums after an SVD rotation.

Vectors become whole numbers (floor of ``scale`` times a component). They are sorted by length, longest
first, and cut into blocks. Each query first meets the longest block of its dimension; its k-th score there
is a bound. By Cauchy-Schwarz a block whose longest vector times the query's length stays below the bound
can't add anything, so a query block meets only the leading blocks. In a pair of blocks the first quarter
of the coordinates, rotated so that they carry most of the length, is multiplied first; pairs whose
partial sum plus product of the residual lengths stays below the bound are dropped. The rest is scored
exactly, in whole numbers.

Blocks of queries and of candidates meet in the cells of a grid, some megabytes of each to a cell. A cell gets
each of its blocks once, and each query leaves it with its k best; the k-th of them bounds the next block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmill.llm.common import with_position
from stepmill.llm.vectors import CANDIDATES, QUERIES, best, clean, div, first_of, in_blocks, matrix, ranked
from stepmill.session import materialise

#: Bytes of rotations that the driver gathers and every task gets.
ROTATION_BYTES = 16 << 20
#: Bytes of query blocks, and of candidate blocks, that a cell gets at most (as doubles).
CELL_BYTES = 64 << 20


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, vec) to the summed products of coordinates, a row for each dimension and coordinate."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for dim in np.unique(batch.column(0).to_numpy()):
            part = matrix(table.filter(pc.equal(table["dim"], dim))["vec"])
            sums[int(dim)] = sums.get(int(dim), 0) + part.T @ part
    for dim, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["dim", "i", "line"]
        )


def _head(dim: int) -> int:
    """How many rotated coordinates are multiplied first."""
    return max(1, dim // 4)


def rotations(rows: DataFrame, max_dim: int = 4096) -> dict[int, np.ndarray]:
    """For each dimension the strongest right singular vectors of all vectors, a quarter of them; from the summed products.

    Sums and singular vectors are worked out in tasks. Beyond ``ROTATION_BYTES`` dimensions of fewer rows go without.
    """
    sizes = rows.filter(F.col("dim") <= max_dim).groupBy("dim").count().collect()
    chosen, room = [], ROTATION_BYTES
    for dim, _ in sorted(sizes, key=lambda r: (-r["count"], r["dim"])):
        if 4 * dim * _head(dim) <= room:
            room -= 4 * dim * _head(dim)
            chosen.append(dim)
    if not chosen:
        return {}

    def added(group: tuple, table: pa.Table) -> pa.Table:
        return pa.table({"dim": [group[0].as_py()], "i": [group[1].as_py()], "line": [matrix(table["line"]).sum(0)]}, schema=pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("line", pa.list_(pa.float64()))]))

    def turned(group: tuple, table: pa.Table) -> pa.Table:
        dim, total = group[0].as_py(), matrix(table.sort_by("i")["line"])
        # Shrunk a little: rounded, it must not lengthen a vector, or the bound wouldn't hold.
        turn = [((1 - 1e-5) * np.linalg.eigh(total)[1][:, ::-1][:, : _head(dim)]).astype(np.float32).tobytes()] if np.isfinite(total).all() else []
        return pa.table({"dim": pa.array([dim] * len(turn), pa.int32()), "turn": pa.array(turn, pa.binary())})

    lines = rows.select("dim", "vec").filter(F.col("dim").isin(chosen)).mapInArrow(_products, "dim int, i int, line array<double>")
    summed = lines.groupBy("dim", "i").applyInArrow(added, "dim int, i int, line array<double>")
    turns = summed.groupBy("dim").applyInArrow(turned, "dim int, turn binary").collect()
    return {r["dim"]: np.frombuffer(r["turn"], np.float32).reshape(r["dim"], -1) for r in turns}


def _narrow(vecs: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them."""
    most = np.abs(vecs).max(initial=0)
    return np.ascontiguousarray(vecs, np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64)


class _Block:
    """A block of rows of one dimension: keys, row numbers, vectors, lengths, and the rotated part, its last column what that leaves of the length."""

    def __init__(self, table: pa.Table, at: int, prefix: str, dim: int, turns: dict[int, np.ndarray]):
        keys, rows, self._vecs = (table[f"{prefix}_{n}"][at].as_buffer() for n in ("keys", "rows", "vecs"))
        self.keys, self.rows, self._dim = np.frombuffer(keys, np.int64), np.frombuffer(rows, np.int64), dim
        vecs = self.vecs()
        with np.errstate(over="ignore", invalid="ignore"):
            self.lengths = np.linalg.norm(vecs, axis=1)
            self.head = None
            if dim in turns:
                head = vecs @ turns[dim]
                # A little more than is left, as the difference is rounded.
                self.head = np.c_[head, np.sqrt(np.maximum(self.lengths**2 - (head**2).sum(1), 0) + 1e-10 * self.lengths**2)]

    def vecs(self) -> np.ndarray:
        kind = {2: np.int16, 4: np.int32, 8: np.float64}[self._vecs.size // (len(self.keys) * self._dim)]
        return np.frombuffer(self._vecs, kind).reshape(len(self.keys), -1).astype(np.float64)


def _exact(q: np.ndarray, c: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of chosen pairs of whole-numbered vectors, exact; beyond 64 bits the nearest end."""
    if not len(a):
        return np.zeros(0, np.int64)
    if np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1] < 2**53:
        return np.concatenate([np.einsum("ij,ij->i", q[a[i : i + 8192]], c[b[i : i + 8192]]) for i in range(0, len(a), 8192)]).astype(np.int64)
    whole = [sum(int(x) * int(y) for x, y in zip(q[i], c[j], strict=True)) for i, j in zip(a, b, strict=True)]
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in whole], np.int64)


def _score(k: int, q: _Block, q_vecs: np.ndarray, c: _Block, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries and of candidates, and scores: for each query the ``k`` best of the block that reach ``least``. A row never finds itself."""
    _, mine, theirs = np.intersect1d(q.rows, c.rows, assume_unique=True, return_indices=True)
    with np.errstate(over="ignore", invalid="ignore"):
        slack = 1 + 1e-9 * q.lengths * c.lengths.max(initial=0)
        floor = (least - slack)[:, None]
        alive = rough = None
        if q.head is not None and (least > -np.inf).any():
            alive = q.head @ c.head.T >= floor
            alive[mine, theirs] = False
        if alive is None or np.count_nonzero(alive) > 0.05 * alive.size:
            rough = q_vecs @ c.vecs().T
            if not np.isfinite(q.lengths.max(initial=0) * c.lengths.max(initial=0)):
                rough = np.nan_to_num(rough, nan=np.inf, posinf=np.inf, neginf=-np.inf)
            rough[mine, theirs] = -np.inf
            alive = rough >= floor
            if np.isneginf(floor).any():
                alive &= rough > -np.inf
    if rough is not None and np.count_nonzero(alive) > 4 * k * len(least):
        a, b = best(np.where(alive, rough, -np.inf), k, float(np.nan_to_num(slack.max(initial=0), posinf=1e300)))
    else:  # a search of all places at once is several times faster than one by rows
        a, b = np.divmod(np.flatnonzero(alive), len(c.keys))
    s = _exact(q_vecs, c.vecs() if len(a) else q_vecs, a, b)
    use = first_of(a, b, s, k)
    return a[use], b[use], s[use]


def _reach(lengths: np.ndarray, least: np.ndarray) -> float:
    """The shortest candidate that could still matter to a query of the block."""
    with np.errstate(divide="ignore", invalid="ignore"):
        needed = np.where(least <= 0, 0.0, np.where(lengths > 0, (least - 1) / lengths, np.inf)) * (1 - 1e-9)
    return float(needed.min(initial=np.inf))


_FOUND = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])


def _cell(k: int, turns: dict[int, np.ndarray]) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """The query blocks and the candidate blocks of a cell to (query row, query key, key, row, score), the ``k`` best of each query."""

    def meet(group: tuple, asking: pa.Table, blocks: pa.Table) -> pa.Table:
        dim, out = group[0].as_py(), []
        there = [_Block(blocks, i, "c", dim, turns) for i in range(blocks.num_rows)] if asking.num_rows else []
        there.sort(key=lambda c: -c.lengths.max(initial=0))  # the longest first: the others need not be met
        for i in range(asking.num_rows if there else 0):
            q = _Block(asking, i, "q", dim, turns)
            vecs, known = q.vecs(), asking["q_least"][i].as_buffer()
            least = np.array(np.frombuffer(known, np.float64)) if known.size else np.full(len(q.keys), -np.inf)
            a, keys, rows, s = (np.zeros(0, np.int64) for _ in range(4))
            for c in there:
                if c.lengths.max(initial=0) < _reach(q.lengths, least):
                    break
                more, b, scores = _score(k, q, vecs, c, least)
                if len(more):
                    a, keys, rows, s = (np.concatenate(x) for x in ((a, more), (keys, c.keys[b]), (rows, c.rows[b]), (s, scores)))
                    order = np.lexsort((rows, keys))
                    a, keys, rows, s = (x[order] for x in (a, keys, rows, s))
                    use = first_of(a, np.arange(len(a)), s, k)
                    a, keys, rows, s = (x[use] for x in (a, keys, rows, s))
                    full = np.flatnonzero(np.bincount(a, minlength=len(least)) >= k)
                    last = np.searchsorted(a, full, "right") - 1  # by query, best first
                    least[full] = np.maximum(least[full], s[last].astype(np.float64))
            out.append(pa.RecordBatch.from_arrays([pa.array(x) for x in (q.rows[a], q.keys[a], keys, rows, s)], schema=_FOUND))
        return pa.Table.from_batches(out, _FOUND)

    return meet


def _met(asking: DataFrame, blocks: DataFrame, shape: DataFrame, k: int, turns: dict[int, np.ndarray]) -> DataFrame:
    """Every query block with every candidate block of its dimension, in a grid of cells.

    ``shape`` has a row a dimension: the numbers of query blocks and of candidate blocks. Candidate blocks are dealt to
    stripes and query blocks to bands. A stripe's share of the candidates grows with their square root, so what is
    moved grows far slower than the pairs; a cell's blocks stay within ``CELL_BYTES``.
    """
    stripes = F.least("n_c", F.ceil(F.greatest(1.5 * F.sqrt("n_c"), F.col("n_c") * F.col("dim") * (8 * CANDIDATES / CELL_BYTES))))
    bands = F.least("n_q", F.ceil(F.greatest(F.sqrt(F.col("n_q") / F.col("stripes")), F.col("n_q") * F.col("dim") * (8 * QUERIES / CELL_BYTES))))
    grid = shape.withColumn("stripes", stripes).withColumn("bands", bands).select("dim", "stripes", "bands")
    cells = grid.agg(F.sum(F.col("stripes") * F.col("bands"))).first()[0] or 1
    by, count = ["dim", "band", "stripe"], min(cells, 10_000)
    q, c = asking.join(F.broadcast(grid), "dim"), blocks.join(F.broadcast(grid), "dim")
    q = q.withColumn("band", F.col("q_block") % F.col("bands")).withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.col("stripes") - 1)))
    c = c.withColumn("stripe", F.col("block") % F.col("stripes")).withColumn("band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bands") - 1)))
    q, c = q.select(*by, "q_keys", "q_rows", "q_vecs", "q_least"), c.select(*by, "c_keys", "c_rows", "c_vecs")
    found = "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint"
    return q.repartition(count, *by).groupBy(*by).cogroup(c.repartition(count, *by).groupBy(*by)).applyInArrow(_cell(k, turns), found)


def top_k(table: DataFrame, k: int, every: int, *, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose key divides by ``every`` the ``k`` best other rows; ties to the smaller key.

    Rows with a null key or vector, an empty vector, or a null or non-finite component take no part; vectors
    meet only those of their own dimension. Repeated keys are rows of their own. A query without candidates has no row.
    """
    rows = clean(table, key, vector)
    whole = F.transform("vec", lambda x: F.when(F.abs(x * scale) < 2.0**52, F.floor(x * scale).cast("double")).otherwise(x * scale))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    base = rows.withColumn("vec", whole).withColumn("length", length).withColumn("asked", F.col("key") % every == 0)
    sorted_rows = with_position(base, [F.col("dim"), F.desc("length"), F.col("key")], "row").withColumn("block", div("row", CANDIDATES))
    turns = rotations(sorted_rows)
    blocks = materialise(in_blocks(sorted_rows.select("dim", "block", "key", "row", "vec"), ["dim", "block"], "c", pack=_narrow), "blocks")
    queries = with_position(sorted_rows.filter("asked").select("dim", "key", "row", "vec", "length"), [F.col("dim"), F.desc("length"), F.col("row")], "place").withColumn("q_block", div("place", QUERIES))
    # A row a dimension. Rows are numbered by dimension, so its blocks follow one another.
    sizes = blocks.groupBy("dim").agg(F.min("block").alias("lead"), (F.count("*") - 1).alias("n_c"))
    sizes = materialise(sizes.join(queries.groupBy("dim").agg((F.max("q_block") - F.min("q_block") + 1).alias("n_q")), "dim"), "sizes")
    placed = blocks.join(F.broadcast(sizes.select("dim", "lead")), "dim")
    q_blocks = in_blocks(queries.select("dim", "q_block", "key", "row", "vec"), ["dim", "q_block"], "q", pack=_narrow)
    start = materialise(_met(q_blocks, placed.filter("block = lead"), sizes.withColumn("n_c", F.lit(1).cast("long")), k, turns), "first-scores")
    known = start.groupBy("query_row").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bounded = queries.join(known, F.col("row") == F.col("query_row"), "left").withColumn("least", F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf"))))
    later = in_blocks(bounded.select("dim", "q_block", "key", "row", "vec", "least"), ["dim", "q_block"], "q", pack=_narrow)
    rest = _met(later, placed.filter("block > lead"), sizes.filter("n_c > 0"), k, turns)
    return ranked(start.unionByName(rest), k)
