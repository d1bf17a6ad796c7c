"""Blocks of vectors, and the search of query blocks against candidate blocks, for the two vector searches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepmill.session import quoted

#: Rows of a candidate block and of a query block: a pair of blocks is some megabytes of numbers.
CANDIDATES, QUERIES = 2048, 512


def clean(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``key``, ``vec`` (doubles) and ``dim`` of rows whose key isn't null and whose components are all finite."""
    rows = table.select(F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(vector)).cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("key").isNotNull() & (F.size("vec") > 0) & ~odd).withColumn("dim", F.size("vec"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equal-sized lists of doubles as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def in_blocks(
    rows: DataFrame, by: list[str], prefix: str, extra: dict[str, Callable[[pa.Table], float]] | None = None, pack: Callable[[np.ndarray], np.ndarray] = np.ascontiguousarray
) -> DataFrame:
    """One row for each distinct ``by``: keys, row numbers, vectors (and limits) as bytes, the vectors as ``pack`` gives them. Groups must be bounded."""
    extra = extra or {}
    names = [f"{prefix}_{n}" for n in ("keys", "rows", "vecs", "least")] + list(extra)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in by] + [f"`{n}` binary" for n in names[:4]] + [f"`{n}` double" for n in extra])
    limited = "least" in rows.columns

    def fold(group: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("row", "ascending")])
        blobs = [table.column(c).to_numpy().tobytes() for c in ("key", "row")]
        blobs.append(pack(matrix(table.column("vec"))).tobytes())
        blobs.append(table.column("least").to_numpy().tobytes() if limited else b"")
        arrays = [pa.array([g.as_py()], g.type) for g in group] + [pa.array([b], pa.binary()) for b in blobs]
        return pa.Table.from_arrays(arrays + [pa.array([float(f(table))]) for f in extra.values()], names=by + names)

    return rows.groupBy(*by).applyInArrow(fold, schema)


def met(asking: DataFrame, blocks: DataFrame, by: str = "dim") -> DataFrame:
    """Every row of ``asking`` with every block of its dimension (or of the same ``by``).

    Blocks are dealt to stripes, about four to each; the asking rows go to all stripes. So the join's keys
    are as many as the table asks for, and even, though all rows may have one dimension.
    """
    counted = blocks.groupBy(by).agg(F.ceil(F.count("*") / 4).cast("int").alias("stripes"))
    left = asking.join(counted, by).withColumn("stripe", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1))).drop("stripes")
    right = blocks.join(counted, by).withColumn("stripe", F.pmod(F.hash("block"), "stripes")).drop("stripes")
    return left.join(right, [by, "stripe"])


def searched(pairs: DataFrame, score: Callable[..., tuple[np.ndarray, np.ndarray, list]], kind: str) -> DataFrame:
    """Block pairs to (query row, query key, key, row, score): what ``score`` picks of each pair.

    ``score(queries, candidates, least)`` gives places of queries, places of candidates and their scores. A row
    never finds itself.
    """
    columns = ["q_keys", "q_rows", "q_vecs", "q_least", "c_keys", "c_rows", "c_vecs"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                qk, qr, qv, least, ck, cr, cv = (batch.column(c)[i].as_buffer() for c in range(7))
                qk, qr, ck, cr = (np.frombuffer(x, np.int64) for x in (qk, qr, ck, cr))
                q, c = (np.frombuffer(x, np.float64).reshape(n, -1) for x, n in ((qv, len(qk)), (cv, len(ck))))
                a, b, s = score(q, c, np.frombuffer(least, np.float64), np.equal.outer(qr, cr))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(qr[a]), pa.array(qk[a]), pa.array(ck[b]), pa.array(cr[b]), pa.array(s)],
                    schema=pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64() if kind == "long" else pa.float64())]),
                )

    # Two megabytes a row: few rows a batch.
    return pairs.select(*columns).mapInArrow(meet, f"query_row bigint, query_id bigint, vec_id bigint, row bigint, score {kind}")


def best(scores: np.ndarray, k: int, slack: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Places of all scores that can be among the ``k`` best of their row, within ``slack``; -inf never is."""
    if scores.shape[1] > k:
        bound = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    else:
        bound = np.full(len(scores), -np.inf)
    return np.nonzero((scores >= (bound - slack)[:, None]) & (scores > -np.inf))


def first_of(rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Of picked places the ``k`` best of each row; ties to the smaller column."""
    down = ~scores if scores.dtype.kind == "i" else -scores  # -scores would overflow at the smallest integer
    order = np.lexsort((columns, down, rows))
    ranked = rows[order]
    start = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, int)
    rank = np.arange(len(ranked)) - np.repeat(start, np.diff(np.r_[start, len(ranked)]))
    return order[rank < k]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query row, ties to the smaller key: query_id, rank, vec_id, score."""
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def div(column: str, size: int) -> Column:
    return F.expr(f"`{column}` div {size}")
