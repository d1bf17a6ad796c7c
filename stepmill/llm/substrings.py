"""Exact removal of repeated substrings, with suffix arrays refined by bucket pointers.

A byte goes if a string of ``length`` (200) bytes that covers it also starts anywhere else, in any text.

1. Every string of 200 bytes is put in the care of one anchor: its 32-byte gram with the smallest hash.
   Equal strings have equal anchors at equal places, so only strings of equal anchors can be equal.
   An anchor cares for a run of some 80 strings; what it sees of the text is their ``context``.
2. Anchors are counted by hash. Those that come once are done. Equal contexts (128 bits of anchor and
   context hash) repeat whole: this settles copies and the inside of shared passages by counting.
3. Where an anchor has different contexts (edges of passages, edited copies), one of each goes to a
   suffix array: positions are put in buckets by their first 8 bytes, and buckets with several positions
   are refined by sorting on the bucket pointers of later offsets, which doubles the depth each time up
   to 200 bytes. Strings left in a bucket with others are repeated.
4. An anchor with more than ``crowd`` different contexts (a passage in very many texts, each with another
   neighbourhood) isn't brought into one task: its strings are counted by digest over the cluster. Both
   ways give the same strings.

Texts are moved once, into a table bucketed by row number; the rest are anchors of some 40 bytes each,
about one for every 85 bytes of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stepmill.llm.common import bucketed, fresh, text_of
from stepmill.session import materialise, quoted

GRAM = 32
#: Bytes of text hashed at once, and bytes of contexts in one suffix array.
PIECE, ARRAY = 1 << 20, 1 << 21
_MIX = [np.uint64(int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=8).digest(), "little") | 1) for i in range(5)]
_BYTES = np.array([int.from_bytes(hashlib.blake2b(b"byte" + bytes([i]), digest_size=8).digest(), "little") for i in range(256)], np.uint64)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the 32 bytes from each position on, by joining halves."""
    x = _BYTES[data]
    for i in range(5):
        x = x[: -(1 << i)] * _MIX[i] + x[1 << i :]
        x ^= x >> np.uint64(29)
    return x


def _smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes the place of the smallest, the first of equal ones."""
    low = hashes & ~np.uint64(0xFFFFFF) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    return (low & np.uint64(0xFFFFFF)).astype(np.int64)


def _pieces(rows: list[int], texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Texts joined to pieces: bytes, and (row, start in text, start in piece, number of strings that start there)."""
    parts, places, size = [], [], 0
    for row, text in zip(rows, texts, strict=True):
        for at in range(0, len(text) - length + 1, PIECE):
            part = text[at : at + PIECE + length - 1]
            parts.append(part)
            places.append((row, at, size, len(part) - length + 1))
            size += len(part)
            if size >= PIECE:
                yield b"".join(parts), places
                parts, places, size = [], [], 0
    if parts:
        yield b"".join(parts), places


def _anchors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(row, text) to (row, first start, last start, anchor hash, context hash)."""
    for batch in batches:
        for data, places in _pieces(batch.column(0).to_pylist(), batch.column(1).to_pylist(), length):
            hashes = _gram_hashes(np.frombuffer(data, np.uint8))
            least = _smallest(hashes, length - GRAM + 1)
            rows, first, last, anchor, context = [], [], [], [], []
            for row, begin, at, count in places:
                own = least[at : at + count]
                starts = np.r_[0, np.flatnonzero(own[1:] != own[:-1]) + 1]
                stops = np.r_[starts[1:], count] - 1
                rows.append(np.full(len(starts), row))
                first.append(starts + begin)
                last.append(stops + begin)
                anchor.append(hashes[own[starts]])
                context += [
                    xxhash.xxh3_64_intdigest(data[at + s : at + e + length], g)
                    for s, e, g in zip(starts.tolist(), stops.tolist(), (own[starts] - at - starts).tolist(), strict=True)
                ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(rows)),
                    pa.array(np.concatenate(first).astype(np.int32)),
                    pa.array(np.concatenate(last).astype(np.int32)),
                    pa.array(np.concatenate(anchor).view(np.int64)),
                    pa.array(np.array(context, np.uint64).view(np.int64)),
                ],
                names=["row", "first", "last", "anchor", "context"],
            )


def repeated_starts(data: bytes, begins: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """For contexts joined to ``data``, whether the string from each start occurs at another start too.

    Context i begins at ``begins[i]`` and has ``counts[i]`` starts and ``length - 1`` bytes more.
    """
    x = np.frombuffer(data + bytes(length), np.uint8).astype(np.uint64)
    for bits in (8, 16, 32):
        step = bits // 8
        x = (x[:-step] << np.uint64(bits)) | x[step:]
    size = len(data)
    order = np.argsort(x[:size], kind="stable")
    bucket = np.zeros(size + length, np.int64)
    active = _point(bucket, order, x[order], np.arange(size))
    depth = 8
    while depth * 2 <= length and len(active):
        active = _refine(bucket, active, depth)
        depth *= 2
    starts = np.concatenate([np.arange(b, b + c) for b, c in zip(begins, counts, strict=True)])
    is_start = np.zeros(size, bool)
    is_start[starts] = True
    active = active[is_start[active]]
    if depth < length and len(active):
        active = _refine(bucket, active, length - depth)
    again = np.zeros(size, bool)
    again[active] = True
    return again[starts]


def _refine(bucket: np.ndarray, active: np.ndarray, offset: int) -> np.ndarray:
    """Sort the positions of each bucket by the pointers at ``offset``; those still sharing a bucket come back."""
    key = bucket[active].astype(np.uint64) << np.uint64(32) | bucket[active + offset].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    return _point(bucket, active[order], key[order], None)


def _point(bucket: np.ndarray, positions: np.ndarray, keys: np.ndarray, slots: np.ndarray | None) -> np.ndarray:
    """Give positions, sorted by ``keys``, the place of their bucket's first slot; return those in buckets of several."""
    if not len(positions):
        return positions
    head = np.r_[True, keys[1:] != keys[:-1]]
    group = np.cumsum(head) - 1
    sizes = np.bincount(group)
    at = np.arange(len(positions))
    if slots is None:  # within its old bucket a position moves by its rank there
        old = bucket[positions]
        outer = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
        bucket[positions] = old + np.maximum.accumulate(np.where(head, at, 0)) - outer
    else:
        bucket[positions] = np.maximum.accumulate(np.where(head, at, 0))
    return positions[sizes[group] > 1]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of true flags."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(row, text, wanted contexts) to a row with its bytes for each context."""
    for batch in batches:
        for row, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for at in range(0, len(wanted), 20_000):
                some = wanted[at : at + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * len(some), pa.int64()),
                        pa.array([w["anchor"] for w in some], pa.int64()),
                        pa.array([w["kinds"] for w in some], pa.int64()),
                        pa.array([w["copies"] for w in some], pa.int64()),
                        pa.array([w["first"] for w in some], pa.int32()),
                        pa.array([text[w["first"] : w["last"] + length] for w in some], pa.binary()),
                    ],
                    names=["row", "anchor", "kinds", "copies", "first", "bytes"],
                )


def _arrays(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(anchor, row, copies, first, bytes), sorted by anchor, to runs of repeated starts."""

    def found(held: list[tuple]) -> pa.RecordBatch:
        data = b"".join(h[4] for h in held)
        sizes = np.array([len(h[4]) for h in held])
        counts = sizes - length + 1
        again = repeated_starts(data, np.cumsum(sizes) - sizes, counts, length)
        rows, first, last = [], [], []
        at = 0
        for (_, row, copies, begin, _), count in zip(held, counts.tolist(), strict=True):
            if copies == 1:
                a, b = _runs(again[at : at + count])
                rows += [row] * len(a)
                first += (a + begin).tolist()
                last += (b + begin).tolist()
            at += count
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32())], names=["row", "first", "last"]
        )

    held, size = [], 0
    for batch in batches:
        for item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= ARRAY and item[0] != held[-1][0]:
                yield found(held)
                held, size = [], 0
            held.append(item)
            size += len(item[4])
    if held:
        yield found(held)


def _strings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(row, copies, first, bytes) to a digest for each string."""
    for batch in batches:
        for row, copies, first, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            count = len(data) - length + 1
            digests = [xxhash.xxh3_128_digest(data[i : i + length]) for i in range(count)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row] * count, pa.int64()),
                    pa.array(range(first, first + count), pa.int32()),
                    pa.array([copies] * count, pa.int64()),
                    pa.array(digests, pa.binary()),
                ],
                names=["row", "first", "copies", "digest"],
            )


def _looked_up(rows: DataFrame, found: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """``rows`` with ``found`` (a row for each key, with the key's ``count`` among ``total`` rows) on ``keys``.

    Keys that hold more than a two-thousandth of the rows, fewer than 2,000 by their nature, meet their rows by a broadcast;
    the others by a shuffle, in which no key is large.
    """
    frequent = F.broadcast(found.filter(F.col(count) > total / 2000))
    others = rows.join(frequent.select(*keys), keys, "left_anti").join(found.filter(F.col(count) <= total / 2000), keys)
    return rows.join(frequent, keys).unionByName(others)


def repeated_runs(table: DataFrame, length: int = 200, crowd: int = 4096) -> DataFrame:
    """(row, first, last): runs of starts of repeated strings. ``table`` is bucketed and has ``row`` and binary ``text``."""
    anchors = materialise(
        table.select("row", "text").mapInArrow(lambda b: _anchors(b, length), "row bigint, first int, last int, anchor bigint, context bigint"),
        "anchors",
    )
    total = anchors.count()
    several = materialise(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "several")
    shared = materialise(_looked_up(anchors, several, ["anchor"], "n", total).drop("n"), "shared-anchors")
    place = F.min(F.struct("row", "first", "last")).alias("place")
    classes = materialise(shared.groupBy("anchor", "context").agg(F.count("*").alias("copies"), place), "contexts")
    copied = classes.filter("copies > 1").select("anchor", "context", "copies")
    whole = _looked_up(shared, copied, ["anchor", "context"], "copies", total).select("row", "first", "last")
    kinds = classes.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    wanted = (
        _looked_up(classes, kinds, ["anchor"], "kinds", classes.count())
        .groupBy(F.col("place.row").alias("row"))
        .agg(F.collect_list(F.struct("anchor", "kinds", "copies", "place.first", "place.last")).alias("wanted"))  # bounded by the text
    )
    contexts = materialise(
        table.join(wanted, "row").select("row", "text", "wanted").mapInArrow(lambda b: _contexts(b, length), "row bigint, anchor bigint, kinds bigint, copies bigint, first int, bytes binary"),
        "context-bytes",
    )
    sorted_out = (
        contexts.filter(F.col("kinds") <= crowd)
        .select("anchor", "row", "copies", "first", "bytes")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(lambda b: _arrays(b, length), "row bigint, first int, last int")
    )
    strings = contexts.filter(F.col("kinds") > crowd).select("row", "copies", "first", "bytes").mapInArrow(lambda b: _strings(b, length), "row bigint, first int, copies bigint, digest binary")
    twice = strings.groupBy("digest").agg(F.sum("copies").alias("n")).filter("n > 1").select("digest")
    crowded = strings.filter("copies = 1").join(twice, "digest", "left_semi").select("row", "first", F.col("first").alias("last"))
    return whole.unionByName(sorted_out).unionByName(crowded)


#: What ``remove_repeats`` adds.
ADDED = ("n_bytes", "n_removed", "spans", "kept")


def remove_repeats(docs: DataFrame, *, text: str = "text", length: int = 200, crowd: int = 4096, as_text: bool = False) -> DataFrame:
    """All rows with ``n_bytes``, ``n_removed``, ``spans`` (removed byte ranges, end exclusive) and ``kept`` (bytes).

    Strings are judged on the input: every copy goes, also the first. Matches never cross rows; repeated
    rows are copies of each other. A null text counts as empty, and texts below ``length`` bytes
    stay whole. With ``as_text`` the kept bytes come as text, without characters of which a part was cut.
    Existing columns of these names are replaced.
    """
    added = list(ADDED)
    others = [c for c in docs.columns if c.lower() not in added]
    row, data, runs = fresh(docs, "row"), fresh(docs, "_bytes"), fresh(docs, "_runs")
    if row != "row":  # the inner steps use plain names
        renamed = docs.withColumnsRenamed({c: f"{c}_" for c in docs.columns if c.lower() == "row"})
        back = {f"{c}_": c for c in docs.columns if c.lower() == "row"}
        return remove_repeats(renamed, text=f"{text}_" if text.lower() == "row" else text, length=length, crowd=crowd, as_text=as_text).withColumnsRenamed(back)
    table = bucketed(
        docs.select(*[quoted(c) for c in others], text_of(text).cast("binary").alias(data)).withColumn(row, F.monotonically_increasing_id()),
        row, "texts",
    )
    found = repeated_runs(table.select("row", F.col(data).alias("text")), length, crowd)
    by_row = found.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias(runs))  # bounded by the text
    new = StructType.fromDDL("n_bytes bigint, n_removed bigint, spans array<struct<begin: bigint, end: bigint>>, kept " + ("string" if as_text else "binary"))
    schema = StructType(table.select(*[quoted(c) for c in others]).schema.fields + new.fields)

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                texts, found = batch.column(len(others)).to_pylist(), batch.column(len(others) + 1).to_pylist()
                spans = [merged([(r["first"], r["last"] + length) for r in f or ()]) for f in found]
                kept = [without(t, s) for t, s in zip(texts, spans, strict=True)]
                sizes = [len(t) for t in texts]
                columns = [
                    pa.array(sizes, pa.int64()),
                    pa.array([n - len(k) for n, k in zip(sizes, kept, strict=True)], pa.int64()),
                    pa.array([[{"begin": b, "end": e} for b, e in s] for s in spans], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                    pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *columns], names=others + added)

    return table.join(by_row, "row", "left").select(*[quoted(c) for c in others], data, runs).mapInArrow(removed, schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for begin, end in spans:
        parts.append(text[at:begin])
        at = end
    return b"".join([*parts, text[at:]])
