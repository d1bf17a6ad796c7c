"""Operators that need a row order: numbering, page slices, record caps.

Nothing here sends the table through one task, and ordinary keys need no table written aside. A sample of the
keys gives bounds, which enter the plan as literals; they cut the rows into even buckets, whose counts, one
aggregation over the key columns alone, say how many rows come before each bucket.

* Numbering sorts inside the buckets and adds what comes before.
* A cap or a slice looks for the key at its rank: the bucket that holds it is cut again until it is small,
  and its sorted keys give the exact key. The rows are then found by comparing with that literal, a filter
  that is pushed to the scan; nothing else is sorted or shuffled.

Keys that aren't unique together, or of types without literals, go the long way: the sorted rows are landed.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stepmill.plans.pipeline import Step
from stepmill.session import materialise, quoted, require_batch, require_columns, small_table

#: Rows a bucket should hold, and rows among which a rank is looked up by sorting.
BUCKET_ROWS = 1_000_000
#: Bounds in one plan at most; a larger table is numbered by landing it sorted.
MAX_BUCKETS = 2048
#: Buckets of one round of a search for a rank, and keys sampled for each bound.
ROUND_BUCKETS, SAMPLED = 64, 24

_PART, _SEQ = "__part", "__seq"
# monotonically_increasing_id keeps the position within the partition in its lower 33 bits.
_POSITION_MASK = (1 << 33) - 1

#: A key as text, column by column (None for null), from which the same literal can be made again.
Bound = tuple[str | None, ...]


class Key:
    """The order columns of a table, nulls last, and comparisons of its rows with literal keys."""

    def __init__(self, df: DataFrame, names: Sequence[str]):
        self.columns = [F.col(quoted(n)) for n in names]
        self.types = [df.schema[n].dataType for n in names]
        plain = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
        self.has_literals = all(isinstance(t, plain) for t in self.types)

    def order(self) -> list[Column]:
        return [c.asc_nulls_last() for c in self.columns]

    def as_text(self) -> list[Column]:
        out = []
        for c, t in zip(self.columns, self.types, strict=True):
            c = F.hex(c) if isinstance(t, T.BinaryType) else F.unix_micros(c) if isinstance(t, T.TimestampType) else c
            out.append(c.cast("string"))
        return out

    def _literal(self, i: int, text: str | None) -> Column:
        if text is not None and isinstance(self.types[i], T.BinaryType):
            return F.unhex(F.lit(text))
        if text is not None and isinstance(self.types[i], T.TimestampType):
            return F.timestamp_micros(F.lit(int(text)))
        return F.lit(text).cast(self.types[i])

    def sortable(self) -> Column:
        """One value that sorts as the key does."""
        return F.struct(*[part.alias(f"k{n}{i}") for i, c in enumerate(self.columns) for n, part in enumerate((c.isNull(), c))])

    def up_to(self, bound: Bound) -> Column:
        """True where the key is at most the bound, column by column; else false or null. Scans understand it."""
        out = F.lit(True)
        for i in reversed(range(len(bound))):
            c, value = self.columns[i], self._literal(i, bound[i])
            # Nulls come last: before one lies all that is no null.
            before, same = (c < value, c == value) if bound[i] is not None else (c.isNotNull(), c.isNull())
            if i == len(bound) - 1:
                out = c <= value if bound[i] is not None else F.lit(True)
            else:
                out = before | (same & out)
        return out

    def beyond(self, bound: Bound) -> Column:
        return F.coalesce(~self.up_to(bound), F.lit(True))

    def bucket(self, bounds: Sequence[Bound]) -> Column:
        """How many bounds lie before the key: a tree of comparisons."""

        def tree(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(self.up_to(bounds[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

        return tree(0, len(bounds))


def _bounds(rows: DataFrame, key: Key, count: int, buckets: int) -> list[Bound]:
    """Keys that cut ``count`` rows into about even buckets, from a sample of a fixed number of keys."""
    if buckets < 2 or not count:
        return []
    share = SAMPLED * buckets / count
    picked = rows if share >= 1 else rows.sample(share, seed=7)
    texts = F.struct(*[t.alias(f"t{i}") for i, t in enumerate(key.as_text())])
    ranked = picked.agg(F.sort_array(F.collect_list(F.struct(key.sortable().alias("key"), texts.alias("text")))).alias("keys"))
    at = F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)), lambda i: F.get(F.col("keys"), F.floor(i * F.size("keys") / buckets).cast("int")))
    found = ranked.select(F.transform(at, lambda k: k["text"]).alias("texts")).first()["texts"]
    return list(dict.fromkeys(tuple(t) for t in found if t is not None))


def _counts(rows: DataFrame, key: Key, bounds: Sequence[Bound]) -> list[int]:
    """Rows of each bucket, by one aggregation."""
    found = {r["at"]: r["count"] for r in rows.groupBy(key.bucket(bounds).alias("at")).count().collect()}
    return [found.get(i, 0) for i in range(len(bounds) + 1)]


def with_row_index(order_by: Sequence[str], name: str = "index") -> Step:
    """Add a 0-based row number in the order of ``order_by``, which must be unique together.

    The key columns are read three times (count, sample, bucket counts) and the rows once, when they are
    used: materialise a costly input first.
    """

    def step(df: DataFrame) -> DataFrame:
        _check_order(df, order_by, "with_row_index")
        key = Key(df, order_by)
        total = df.select(*key.columns).count()
        return _numbered(df, key, name, total, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_ROWS)))

    return step


def _numbered(df: DataFrame, key: Key, name: str, total: int, buckets: int) -> DataFrame:
    if not key.has_literals or buckets > MAX_BUCKETS:
        return _landed_index(df, key, name)
    keys = df.select(*key.columns)
    bounds = _bounds(keys, key, total, buckets)
    counts = _counts(keys, key, bounds) if bounds else [total]
    if max(counts) > 4 * max(BUCKET_ROWS, total // buckets):  # one key fills a bucket
        return _landed_index(df, key, name)
    before = F.element_at(F.array(*[F.lit(n) for n in accumulate(counts[:-1], initial=0)]).cast("array<bigint>"), F.col(_PART) + 1)
    place = F.row_number().over(Window.partitionBy(_PART).orderBy(*key.order()))
    return (
        df.withColumn(_PART, key.bucket(bounds))
        .withColumn(_SEQ, place)
        .select(*[quoted(c) for c in df.columns], (before + F.col(_SEQ) - 1).alias(name))
    )


def _landed_index(df: DataFrame, key: Key, name: str) -> DataFrame:
    """Rows sorted by range over the cluster, landed in the shared folder, and shifted by the rows of earlier partitions."""
    placed = materialise(
        df.repartitionByRange(*key.order())
        .sortWithinPartitions(*key.order())
        .withColumns({
            _PART: F.spark_partition_id(),
            _SEQ: F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)),
        }),
        "row-index",
    )
    # One row per partition, at most spark.sql.shuffle.partitions of them.
    counts = placed.groupBy(_PART).count().collect()
    parts = sorted((r[_PART], r["count"]) for r in counts)
    starts = list(accumulate((rows for _, rows in parts), initial=0))[:-1]
    offsets = small_table(
        df.sparkSession,
        {_PART: [part for part, _ in parts], "__start": starts},
        {_PART: pa.int32(), "__start": pa.int64()},
    )
    return (
        placed.join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col("__start") + F.col(_SEQ))
        .select(*[quoted(c) for c in df.columns], quoted(name))
    )


def key_at(df: DataFrame, key: Key, rank: int, total: int) -> tuple[Bound, bool]:
    """The key that ``rank`` (1 to ``total``) rows reach, and whether no more rows do, as with unique keys.

    Each round cuts the bucket that holds the rank into smaller ones; only key columns are read.
    """
    keys, before, rows = df.select(*key.columns), 0, total
    while rows > BUCKET_ROWS:
        bounds = _bounds(keys, key, rows, min(ROUND_BUCKETS, 1 + rows // (BUCKET_ROWS // 2)))
        counts = _counts(keys, key, bounds)
        if max(counts) == rows:  # one key, as far as sampling can tell
            break
        ends = list(accumulate(counts))
        at = next(i for i, end in enumerate(ends) if before + end >= rank)
        if at:
            keys = keys.filter(key.beyond(bounds[at - 1]))
        if at < len(bounds):
            keys = keys.filter(key.up_to(bounds[at]))
        before, rows = before + ends[at] - counts[at], counts[at]
    found = keys.orderBy(*key.order()).offset(rank - before - 1).limit(2).select(*[t.alias(f"t{i}") for i, t in enumerate(key.as_text())])
    bound, *after = (tuple(r) for r in found.collect())
    return bound, bound not in after


def _check_order(df: DataFrame, order_by: Sequence[str], step: str) -> None:
    require_batch(df, step)
    if not order_by:
        raise ValueError(f"{step} needs order_by columns that are unique together")
    require_columns(df, order_by)


def page_plan(
    spark: SparkSession, offset: int, seed_limit: int, chunk_limit: int, concurrent_batch_limit: int
) -> DataFrame:
    """The pages of a pull: ``page``, ``offset``, ``limit`` and the ``batch`` a page belongs to."""
    page = F.floor((F.col("id") - F.lit(offset)) / F.lit(chunk_limit)).cast("bigint")
    return spark.range(offset, offset + seed_limit, chunk_limit).select(
        page.alias("page"),
        F.col("id").alias("offset"),
        F.lit(chunk_limit).cast("bigint").alias("limit"),
        F.floor(page / F.lit(concurrent_batch_limit)).cast("bigint").alias("batch"),
    )


def paged_slice(
    order_by: Sequence[str],
    *,
    offset: int = 0,
    seed_limit: int = 100_000,
    chunk_limit: int = 1_000,
) -> Step:
    """Rows ``offset`` up to ``offset + pages * chunk_limit`` of the ordered table.

    Every page has ``chunk_limit`` rows, the last one too, so up to a page more than ``seed_limit``
    rows can come back. Adds ``row_index`` and ``page``. Only the slice itself is sorted.
    """

    def step(df: DataFrame) -> DataFrame:
        _check_order(df, order_by, "paged_slice")
        pages = -(-seed_limit // chunk_limit)
        end = offset + pages * chunk_limit
        key = Key(df, order_by)
        sliced, skipped, rows = _between(df, key, max(0, offset), max(0, end))
        rows = sliced.count() if rows is None else rows
        index = F.col("row_index")
        return (
            _numbered(sliced, key, "row_index", rows, max(1, -(-rows // BUCKET_ROWS)))
            .withColumn("row_index", index + skipped)
            .filter((index >= offset) & (index < end))
            .withColumn("page", F.floor((index - F.lit(offset)) / F.lit(chunk_limit)).cast("bigint"))
        )

    return step


def _between(df: DataFrame, key: Key, start: int, end: int) -> tuple[DataFrame, int, int | None]:
    """Rows that hold the ranks ``start`` up to ``end`` (0-based, exclusive), how many come before them, and their number if known.

    More rows come back where several share the key at an end.
    """
    total = df.select(*key.columns).count()
    if start >= total or end <= start:
        return df.filter(F.lit(False)), 0, 0
    if not key.has_literals:
        return df, 0, total
    skipped = 0
    if start:
        bound, alone = key_at(df, key, start, total)
        if alone:
            df, skipped = df.filter(key.beyond(bound)), start
    if end >= total:
        return df, skipped, total - skipped
    bound, alone = key_at(df, key, end - skipped, total - skipped)
    return df.filter(key.up_to(bound)), skipped, end - skipped if alone else None


def record_cap(max_records: int | None, order_by: Sequence[str]) -> Step:
    """The first ``max_records`` rows in order; ``None`` keeps all, zero or less keeps none.

    The cap becomes a comparison with the key at its rank, looked up when the step is applied; that reads the key
    columns two times and more, so materialise a costly input first. The rows come in any order. Where several
    rows share that key, some of them are taken.
    """

    def step(df: DataFrame) -> DataFrame:
        if max_records is None:
            return df
        if max_records <= 0:
            return df.filter(F.lit(False))
        _check_order(df, order_by, "record_cap")
        key = Key(df, order_by)
        if not key.has_literals:
            return with_row_index(order_by, "__row")(df).filter(F.col("__row") < max_records).drop("__row")
        total = df.select(*key.columns).count()
        if total <= max_records:
            return df
        bound, alone = key_at(df, key, max_records, total)
        kept = df.filter(key.up_to(bound))
        if alone:
            return kept
        return with_row_index(order_by, "__row")(kept).filter(F.col("__row") < max_records).drop("__row")

    return step
