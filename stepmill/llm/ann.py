"""Approximate nearest neighbours by learned partitions.

A bounded sample gets a graph of nearest neighbours, which is halved again and again into partitions of equal
size with few edges between them (spectral halves, evened by exchanges). A softmax classifier learns
the partition from the vector. Every row is filed under its most probable partition; a query goes to its
``probes`` most probable ones and is ranked there by the true inner product. ``probes`` is the smallest
number that finds ``recall`` of the neighbours in the sample. Partitions are read in blocks, so one with a third of all
rows is as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmill.llm.common import lowest_by_hash, with_position
from stepmill.llm.vectors import CANDIDATES, QUERIES, best, clean, div, first_of, in_blocks, matrix, met, ranked, searched
from stepmill.session import materialise


#: Rows a partition should hold.
PART_ROWS = 2048


@dataclass
class Router:
    """Partition probabilities are softmax(vec @ weights + bias); ``probes`` partitions are searched."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """Partitions of each vector, most probable first."""
        return np.argsort(-(vectors @ self.weights + self.bias), axis=1, kind="stable")


def neighbour_graph(vectors: np.ndarray, k: int, of: np.ndarray | None = None) -> np.ndarray:
    """For each vector (or those at the places ``of``) the places of its ``k`` largest inner products with others."""
    of = np.arange(len(vectors)) if of is None else of
    out = []
    for at in range(0, len(of), 64):  # a few megabytes at once
        some = of[at : at + 64]
        near = vectors[some] @ vectors.T
        near[np.arange(len(some)), some] = -np.inf
        out.append(np.argpartition(near, len(vectors) - k, axis=1)[:, -k:].copy())  # not a view of all columns
    return np.concatenate(out)


def balanced_partition(graph: np.ndarray, parts: int, rounds: int = 60, seed: int = 7) -> np.ndarray:
    """Partition numbers of equal frequency (to one), with few edges between partitions. ``parts`` is a power of two."""
    label = np.zeros(len(graph), np.int64)
    random = np.random.default_rng(seed)
    a = np.repeat(np.arange(len(graph)), graph.shape[1])
    b = graph.ravel()
    for _ in range(parts.bit_length() - 1):
        inside = label[a] == label[b]  # halves of all partitions at once: only their own edges count
        x, y = np.r_[a[inside], b[inside]], np.r_[b[inside], a[inside]]
        degree = np.maximum(np.bincount(x, minlength=len(graph)), 1)
        value = random.standard_normal(len(graph))
        for _ in range(rounds):  # power iterations towards the smoothest split
            value = 0.5 * value + 0.5 * np.bincount(x, value[y], len(graph)) / degree
            means = np.bincount(label, value) / np.maximum(np.bincount(label), 1)
            value -= means[label]
            value /= max(np.abs(value).max(), 1e-300)
        for _ in range(5):
            side = _upper_half(label, value)
            # Exchanges: each goes where most of its neighbours are, as far as the halves stay equal.
            value = np.bincount(x, 2.0 * side[y] - 1, len(graph)) / degree + 0.3 * (2 * side - 1)
        label = 2 * label + _upper_half(label, value)
    return label


def _upper_half(label: np.ndarray, value: np.ndarray) -> np.ndarray:
    order = np.lexsort((value, label))
    starts = np.flatnonzero(np.r_[True, np.diff(label[order]) > 0])
    sizes = np.diff(np.r_[starts, len(label)])
    rank = np.arange(len(label)) - np.repeat(starts, sizes)
    side = np.zeros(len(label), np.int64)
    side[order] = rank >= np.repeat((sizes + 1) // 2, sizes)
    return side


def learned_router(vectors: np.ndarray, label: np.ndarray, parts: int, rounds: int = 200) -> Router:
    """Softmax regression by gradient descent with momentum."""
    scale = max(float(np.sqrt((vectors**2).mean())), 1e-300)
    x = np.c_[vectors / scale, np.ones(len(vectors))]
    w, speed = np.zeros((x.shape[1], parts)), np.zeros((x.shape[1], parts))
    target = np.eye(parts)[label]
    for _ in range(rounds):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - 0.5 * (x.T @ (p - target) / len(x) + 1e-4 * w)
        w += speed
    return Router(w[:-1] / scale, w[-1], parts)


def fitted(sample: np.ndarray, *, parts: int, recall: float, neighbours: int = 20) -> Router:
    """Partition, learn, and find the number of probes that gives ``recall`` within the sample."""
    while parts > 1 and len(sample) < 32 * parts:
        parts //= 2
    if parts == 1:
        width = sample.shape[1] if sample.ndim == 2 else 0
        return Router(np.zeros((width, 1)), np.zeros(1), 1)
    label = balanced_partition(neighbour_graph(sample, 10), parts)
    router = learned_router(sample, label, parts)
    order = router.order(sample)
    filed = order[:, 0]
    asked = np.arange(0, len(sample), max(1, len(sample) // 500))
    true = neighbour_graph(sample, min(neighbours, len(sample) - 1), asked)
    place = np.argsort(order[asked], axis=1)  # at which probe each partition comes
    at = np.take_along_axis(place, filed[true], axis=1)
    shares = [(at < n).mean() for n in range(1, parts + 1)]
    router.probes = 1 + next(i for i, s in enumerate(shares) if s >= recall or i == parts - 1)
    return router


def _routed(batches: Iterator[pa.RecordBatch], router: Router, dim: int) -> Iterator[pa.RecordBatch]:
    """Adds the partitions to visit, the row's own first. Vectors of other dimensions have a partition of their own."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        parts: list[list[int]] = [[-1 - int(d)] for d in dims]
        fits = np.flatnonzero(dims == dim)
        if len(fits):
            order = router.order(matrix(batch.column("vec").take(pa.array(fits))))[:, : router.probes]
            for i, line in zip(fits.tolist(), order.tolist(), strict=True):
                parts[i] = line
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.list_(pa.int64()))], names=[*batch.schema.names, "parts"])


def _scorer(k: int):
    def score(q: np.ndarray, c: np.ndarray, least: np.ndarray, own: np.ndarray):
        with np.errstate(over="ignore", invalid="ignore"):
            rough = np.where(own, -np.inf, np.nan_to_num(q @ c.T, nan=-np.inf))
            a, b = best(rough, k, 1e-9 * max(1.0, float(np.abs(rough[rough > -np.inf]).max(initial=0))))
            # The score of a pair doesn't depend on its place in the block.
            s = np.concatenate([(q[a[i : i + 8192]] * c[b[i : i + 8192]]).sum(1) for i in range(0, len(a), 8192)]) if len(a) else np.zeros(0)
        use = first_of(a, b, s, k)
        return a[use], b[use], s[use]

    return score


def nearest(table: DataFrame, k: int, every: int, *, key: str = "vec_id", vector: str = "embedding", parts: int | None = None, sample_rows: int = 8192, recall: float = 0.97) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose key divides by ``every`` the ``k`` nearest others found.

    Nearness is the largest inner product, in double precision; ties to the smaller key. Rows with a null key or
    vector, an empty or zero vector, or a null or non-finite component take no part; vectors meet only
    those of their own dimension. The index is fitted on at most ``sample_rows`` vectors picked by hash and files every row.
    There are ``parts`` partitions, by default one for some 2,048 rows, as far as the sample has 32 vectors for each.
    A query whose partitions hold fewer than ``k`` others is searched against all rows.
    """
    rows = clean(table, key, vector).filter(F.exists("vec", lambda x: x != 0))
    sample = lowest_by_hash(rows, ["key", "vec"], sample_rows, "key").select("dim", "vec").toArrow()
    if parts is None:
        parts = max(32, 1 << (max(rows.count(), 1) // PART_ROWS).bit_length())
    dims = sample.column("dim").to_numpy()
    dim = int(np.bincount(dims).argmax()) if len(dims) else 0
    # Copies of one vector would fill whole partitions of the sample's graph; one of each is enough to learn from.
    vectors = np.unique(matrix(sample.column("vec").filter(pa.array(dims == dim))), axis=0) if dim else np.zeros((0, 0))
    del sample
    router = fitted(vectors, parts=parts, recall=recall, neighbours=k)
    routed = rows.mapInArrow(lambda b: _routed(b, router, dim), "key bigint, vec array<double>, dim int, parts array<bigint>")
    filed = materialise(with_position(routed.withColumn("part", F.col("parts")[0]), [F.col("part"), F.col("key")], "row"), "filed").withColumn("block", div("row", CANDIDATES))
    blocks = materialise(in_blocks(filed.select("part", "block", "key", "row", "vec"), ["part", "block"], "c"), "blocks")
    sizes = filed.groupBy("part").agg(F.count("*").alias("n"))  # a row a partition or dimension
    asked = filed.filter(F.col("key") % every == 0).select("key", "row", "vec", "dim", F.explode("parts").alias("part"))
    thin = asked.join(F.broadcast(sizes), "part", "left").groupBy("row").agg(F.sum("n").alias("n")).filter(F.col("n") <= k).select("row")
    every_part = F.array(*[F.lit(p).cast("long") for p in range(len(router.bias))])
    widened = (
        filed.filter((F.col("key") % every == 0) & (F.col("dim") == dim)).join(thin, "row", "left_semi")
        .select("key", "row", "vec", "dim", F.explode(F.array_except(every_part, "parts")).alias("part"))
    )
    visits = with_position(asked.unionByName(widened), [F.col("part"), F.col("row")], "place").withColumn("q_block", div("place", QUERIES))
    q_blocks = in_blocks(visits.select("part", "q_block", "key", "row", "vec"), ["part", "q_block"], "q")
    return ranked(searched(met(q_blocks, blocks, "part"), _scorer(k), "double"), k)
