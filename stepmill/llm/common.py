"""Helpers the operators of this folder share: row numbers, text keys, and distributed components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stepmill.session import catalogued, materialise, quoted, scratch_path

# monotonically_increasing_id keeps the position within the partition in its lower 33 bits.
_POSITION_MASK = (1 << 33) - 1


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (compared as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def apart(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with other names for its columns called like ``names``, and what picks its own columns again from a result."""
    clashing = {n.lower() for n in names}
    aside: dict[str, str] = {}
    for i, c in enumerate(df.columns):
        if c.lower() in clashing:
            aside[c] = fresh(df, f"_own_{i}")
    return df.withColumnsRenamed(aside), lambda out: out.select(*[F.col(quoted(aside.get(c, c))).alias(c) for c in df.columns])


def text_of(name: str) -> Column:
    """The text column with null as empty text."""
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def text_key(text: Column) -> Column:
    """128-bit digest of a text, for grouping equal texts without moving them."""
    return F.unhex(F.md5(text.cast("binary")))


def lowest_by_hash(rows: DataFrame, columns: Sequence[str], limit: int, then: str) -> DataFrame:
    """The ``limit`` rows whose columns have the smallest hash (ties by ``then``): a sample that is the same in every run.

    A sort's limit takes ``limit`` rows of every split to one task. So rows whose hash is far too large for
    the table's number of rows are left out before; if too few stay (many equal rows), all rows are sorted.
    """
    mark = F.xxhash64(*[quoted(c) for c in columns])
    count = rows.count()
    if count > 8 * limit:
        low = rows.filter(mark < F.lit(-(1 << 63) + (4 * limit << 64) // count))
        if low.limit(limit).count() == limit:
            rows = low
    return rows.orderBy(mark, quoted(then)).limit(limit)


def with_position(df: DataFrame, order: Sequence[Column], name: str, sums: dict[str, str] | None = None) -> DataFrame:
    """Number the rows from 0 in the given order; ties come in any order, once and for all.

    ``sums`` adds running totals (``{new column: summed column}``, own row included). The sorted rows
    are landed in the shared folder, so that later jobs see the same numbers. Only per-partition
    counts and totals are gathered, one row for each partition; no row goes through a single task. Columns
    of the new names are replaced.
    """
    part, seq, of, start, sums = *(fresh(df, n) for n in ("_part", "_seq", "_of", "_start")), sums or {}
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({
            part: F.spark_partition_id(),
            seq: F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)),
        }),
        "position",
    )
    totals = {fresh(df, f"_total{i}"): F.sum(quoted(c)) for i, c in enumerate(sums.values())}
    rows = fresh(df, "_rows")
    before = Window.orderBy(of).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(F.col(part).alias(of))
        .agg(F.count("*").alias(rows), *[c.alias(n) for n, c in totals.items()])
        .select(of, *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(b) for a, b in ((rows, start), *((n, n) for n in totals))])
    )
    out = placed.join(F.broadcast(starts), F.col(part) == F.col(of))
    running = Window.partitionBy(part).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    added = {name: F.col(start) + F.col(seq)}
    for total, (new, column) in zip(totals, sums.items(), strict=True):
        added[new] = F.col(total) + F.sum(quoted(column)).over(running)
    kept = [quoted(c) for c in df.columns if c.lower() not in {n.lower() for n in added}]
    return out.select(*kept, *[c.alias(n) for n, c in added.items()])


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Connected components: ``node``, ``component`` (the smallest node), for every node of an edge.

    Rounds of large-star and small-star: each node sends its larger, then its smaller neighbours to the
    smallest one it knows, until nothing changes. A round is two grouped minimums (combined before
    the shuffle) and two joins; it is landed, so lineage stays short and lost executors cost one round.
    """
    a, b = F.col(left), F.col(right)
    now = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("low").alias("w")), F.struct(F.col("v").alias("u"), F.col("low").alias("w")))).alias("e"))
        later = materialise(small.select("e.u", F.col("e.w").alias("v")).filter("u <> v").distinct(), "edges")
        changed = later.exceptAll(now).limit(1).count() + now.exceptAll(later).limit(1).count()
        now = later
        if not changed:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """Land ``df`` in the shared folder as a table bucketed by ``key``: joins on it move only the other side.

    The table is registered in the session's catalog under a fresh name, until it is released.
    """
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, label)
    name = f"stepmill_{path.rsplit('-', 1)[1]}"
    df.repartition(count, key).write.bucketBy(count, key).options(path=path, compression="zstd").format("parquet").saveAsTable(name)
    catalogued(path, name)
    # The shuffle moved all texts; its files go when the driver drops the finished plan.
    spark._jvm.System.gc()
    return spark.table(name)
