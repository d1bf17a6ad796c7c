"""SimHash near-duplicates: fingerprints of word shingles, linked by a self-join of their binary trie.

A fingerprint that differs in at most ``budget`` (2) of 64 bits from another agrees with it on at least one
of three blocks of bits, and again on one of three parts of what remains. So each distinct fingerprint is
placed under nine keys of about 35 fixed bits, and rows with equal keys meet in one partition. There, all
keys at once, pairs of trie nodes are followed bit by bit from the fixed bits down: the differing bits
add up, and a pair beyond the budget is dropped with everything below it. A key can't hold more than
2^29 fingerprints, whatever the texts are, and equal fingerprints have been merged before.

Links leave a partition as a star for each component found there, not as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepmill.llm.common import components, fresh, text_of
from stepmill.session import materialise, quoted

#: Fingerprints handled at once in a task, and node pairs followed at once.
SLICE, PAIRS = 1 << 18, 1 << 21
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, words: int = 3) -> int:
    """64-bit SimHash of a text; 0 without a word. A bit is set if over half the shingles' hashes set it."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()  # bytes.split() knows the same six blanks
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))
    hashes = np.fromiter(map(_hash, shingles), np.uint64, max(1, len(found) - words + 1))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        ones += np.unpackbits(hashes[at : at + 65_536].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _hash(shingle: bytes) -> int:
    return xxhash.xxh64_intdigest(shingle, 42)


def with_fingerprint(docs: DataFrame, *, text: str = "text", words: int = 3, name: str = "fp") -> DataFrame:
    """All rows with their fingerprint as a signed long. A null text counts as empty."""

    # Only texts go to Python, and only numbers come back.
    @F.pandas_udf("long")
    def marked(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(name, marked(text_of(text)))


def _layouts(bits: int = 64) -> list[tuple[int, list[int]]]:
    """For each of the nine keys: how many bits are fixed, and the order in which the bits are then read."""

    def cut(places: list[int]) -> list[list[int]]:
        third = -(-len(places) // 3)
        return [places[i : i + third] for i in range(0, len(places), third)]

    found = []
    for block in cut(list(range(bits))):
        rest = [b for b in range(bits) if b not in block]
        for part in cut(rest):
            fixed = block + part
            found.append((len(fixed), fixed + [b for b in rest if b not in part]))
    return found


LAYOUTS = _layouts()


def _reordered(fp: Column, order: list[int]) -> Column:
    """The fingerprint with its bits in another order, the first one highest; whole runs move at once."""
    out, at = None, 0
    while at < 64:
        run = 1
        while at + run < 64 and order[at + run] == order[at] + run:
            run += 1
        # Bit 0 is the highest one.
        piece = F.shiftrightunsigned(fp, 64 - order[at] - run).bitwiseAND(F.lit((1 << run) - 1 if run < 64 else -1))
        piece = F.shiftleft(piece, 64 - at - run)
        out = piece if out is None else out.bitwiseOR(piece)
        at += run
    return out


def _joined(values: np.ndarray, fixed: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in the sorted ``values`` that agree on the ``fixed`` high bits and differ in 1 to ``budget`` others."""
    top = values >> np.uint64(64 - fixed)
    starts = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    ends = np.r_[starts[1:], len(values)]
    several = ends - starts > 1
    # A node is a range of places with a common prefix; the roots are the keys, each paired with itself.
    work = [(fixed, starts[several], ends[several], starts[several], ends[several], np.zeros(int(several.sum()), np.int8))]
    while work:
        depth, a0, a1, b0, b1, off = work.pop()
        if not len(a0):
            continue
        if len(a0) > PAIRS:  # bounded memory: one half waits
            half = len(a0) // 2
            work.append((depth, *(x[half:] for x in (a0, a1, b0, b1, off))))
            a0, a1, b0, b1, off = (x[:half] for x in (a0, a1, b0, b1, off))
        if depth == 64:
            yield a0[a0 != b0], b0[a0 != b0]
            continue
        bit = np.uint64(63 - depth)
        ones = (values >> bit & np.uint64(1)).astype(np.int64)
        before = np.r_[0, np.cumsum(ones)]

        def split(low, high, before=before):
            return high - (before[high] - before[low])  # zeros come first in a sorted range

        am, bm = split(a0, a1), split(b0, b1)
        same = (a0 == b0) & (a1 == b1)
        children = [
            (a0, am, b0, bm, off, np.ones(len(a0), bool)),
            (am, a1, bm, b1, off, np.ones(len(a0), bool)),
            (a0, am, bm, b1, off + 1, np.ones(len(a0), bool)),
            (am, a1, b0, bm, off + 1, ~same),  # a node paired with itself needs the mixed pair once
        ]
        parts = []
        for l0, l1, r0, r1, o, wanted in children:
            use = wanted & (o <= budget) & (l0 < l1) & (r0 < r1) & ((l1 - l0 > 1) | (l0 != r0))
            parts.append(tuple(x[use] for x in (l0, l1, r0, r1, o.astype(np.int8))))
        work.append((depth + 1, *(np.concatenate(x) for x in zip(*parts, strict=True))))


def _stars(count: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each place the smallest place of its component."""
    root = np.arange(count)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _links(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Rows (layout, value, fp), sorted by layout and value, to links between fingerprints."""

    def found(layout: int, values: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        root = _stars(len(values), _joined(values, LAYOUTS[layout][0], budget))
        use = root != np.arange(len(root))
        return pa.RecordBatch.from_arrays([pa.array(prints[use]), pa.array(prints[root[use]])], names=["a", "b"])

    held: list[tuple[int, np.ndarray, np.ndarray]] = []

    def flushed(last: bool) -> Iterator[pa.RecordBatch]:
        """Hand over whole keys; what may go on in the next batch stays."""
        nonlocal held
        layout = held[0][0]
        values, prints = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        end = len(values)
        if not last:
            key = values >> np.uint64(64 - LAYOUTS[layout][0])
            end = int(np.searchsorted(key, key[-1]))
        held = [(layout, values[end:], prints[end:])] if end < len(values) else []
        if end:
            yield found(layout, values[:end], prints[:end])

    for batch in batches:
        layouts = batch.column(0).to_numpy()
        values = batch.column(1).to_numpy().view(np.uint64)
        prints = batch.column(2).to_numpy()
        cuts = np.flatnonzero(np.r_[True, layouts[1:] != layouts[:-1]]) if len(layouts) else []
        for i, at in enumerate(cuts):
            to = cuts[i + 1] if i + 1 < len(cuts) else len(layouts)
            if held and held[0][0] != layouts[at]:
                yield from flushed(True)
            held.append((int(layouts[at]), values[at:to], prints[at:to]))
            if sum(len(h[1]) for h in held) >= SLICE:
                yield from flushed(False)
    if held:
        yield from flushed(True)


def linked(prints: DataFrame, *, fp: str = "fp", budget: int = 2) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints; their components are those of all pairs within the budget."""
    if not 0 <= budget <= 2:
        raise ValueError("the nine keys prove pairs of at most 2 differing bits")
    kinds = prints.select(F.col(quoted(fp)).alias("fp")).dropna().distinct()
    placed = kinds.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(i).alias("layout"), _reordered(F.col("fp"), order).alias("value"), F.lit(fixed).alias("fixed")) for i, (fixed, order) in enumerate(LAYOUTS)])).alias("p"),
    ).select("p.layout", "p.value", "fp", F.expr("shiftrightunsigned(p.value, 64 - p.fixed)").alias("key"))
    # Sorted as unsigned numbers, so the trie's zeros come before its ones.
    return (
        placed.repartition("layout", "key")
        .sortWithinPartitions("layout", F.col("value").bitwiseXOR(F.lit(-(1 << 63))))
        .select("layout", "value", "fp")
        .mapInArrow(lambda batches: _links(batches, budget), "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 3, budget: int = 2) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (the smallest key reachable by links) of every row.

    Rows of equal fingerprints are one node. A null text counts as empty; texts without a word share
    fingerprint 0 and link like others. A null key never is a component's name unless it has no other;
    repeated rows all come back. Other columns of ``docs`` play no part.
    """
    rows = materialise(with_fingerprint(docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")), words=words).select("key", "fp"), "prints")
    return grouped(rows, budget).withColumnRenamed("key", key)


def grouped(rows: DataFrame, budget: int = 2) -> DataFrame:
    """Rows with ``key`` and ``fp`` get their ``component_id``."""
    nodes = rows.groupBy("fp").agg(F.min("key").alias("least"))
    roots = materialise(components(linked(nodes, budget=budget)), "components")
    labelled = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    names = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(labelled.join(names, "root").select("fp", "component_id"), "fp")


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 3, budget: int = 2) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest key (null last; of ties any one)."""
    number, fp = fresh(docs, "_row"), fresh(docs, "_fp")
    held = materialise(with_fingerprint(docs, text=text, words=words, name=fp).withColumn(number, F.monotonically_increasing_id()), "near-dedup")
    rows = held.select(F.col(quoted(key)).alias("key"), F.col(fp).alias("fp"), F.col(number).alias("number"))
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "number"))
    nodes = rows.groupBy("fp").agg(first.alias("first"))
    roots = materialise(components(linked(nodes, budget=budget)), "components")
    kept = (
        nodes.join(roots, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("component", "fp").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.number").alias(number))
    )
    return held.join(kept, number, "left_semi").select(*[quoted(c) for c in docs.columns])


def brute_components(prints: list[int], budget: int = 2) -> list[int]:
    """For tests: by comparing every pair, the smallest place of each place's component."""

    def root(places: list[int], i: int) -> int:
        return i if places[i] == i else root(places, places[i])

    places = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= budget:
                x, y = sorted((root(places, i), root(places, j)))
                places[y] = x
    return [root(places, i) for i in places]
