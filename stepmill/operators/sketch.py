"""Column profiles that can be merged: exact counts, and distinct counts kept as HyperLogLog registers.

A profile has one row a column: how many rows and values there were, and for each of 4,096 registers the highest
rank of a value's hash seen there. Merging takes sums and maxima, so the profile of a table does not depend on how the
table came in parts: merged profiles equal the profile of the union, register by register.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill.functions.text import as_text
from stepmill.operators.nulls import is_missing
from stepmill.session import quoted, require_columns
from stepmill.sources.union import union_tree

#: Bits of a hash that choose the register: a standard error of 1.6 percent.
REGISTER_BITS = 12
_SCHEMA = "column_name string, rows bigint, non_null bigint, registers array<struct<register:int,rank:int>>"


def _hash(c: Column, dtype: T.DataType) -> Column:
    plain = isinstance(dtype, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.BinaryType))
    return F.when(~is_missing(c, dtype), F.xxhash64(c if plain else as_text(c, dtype)))


def _folded(parts: DataFrame) -> DataFrame:
    """(column_name, register, rank, rows) to one row a column; a null register stands for missing values."""
    entry = F.when(F.col("register").isNotNull(), F.struct("register", "rank"))
    return parts.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("register").isNotNull(), F.col("rows"))), F.lit(0)).alias("non_null"),
        F.array_sort(F.collect_list(entry)).alias("registers"),  # at most 4,096
    )


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, rows, non_null, registers``: one aggregation, whose shuffle has a row a register and task."""
    require_columns(df, columns or ())
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    if not fields:
        return df.sparkSession.createDataFrame([], _SCHEMA)
    cells = [cell for i, f in enumerate(fields) for cell in (F.lit(i), _hash(F.col(quoted(f.name)), f.dataType))]
    long = df.select(F.stack(F.lit(len(fields)), *cells).alias("at", "hash"))
    rest = F.shiftleft("hash", REGISTER_BITS)
    # One more than the leading zeros of what is left of the hash.
    rank = F.when(rest == 0, 65 - REGISTER_BITS).otherwise(65 - F.length(F.bin(rest)))
    ranked = long.select("at", F.shiftrightunsigned("hash", 64 - REGISTER_BITS).cast("int").alias("register"), rank.cast("int").alias("rank"))
    names = F.array(*[F.lit(f.name) for f in fields])
    counted = ranked.groupBy("at", "register").agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("rows"))
    return _folded(counted.select(names[F.col("at")].alias("column_name"), "register", "rank", "rows"))


def merge_profiles(profiles: Sequence[DataFrame]) -> DataFrame:
    """The profile of all rows of all profiled tables. A column that some tables lack counts where it was."""
    together = union_tree(profiles)
    entries = together.select("column_name", F.explode("registers").alias("e")).groupBy("column_name", "e.register").agg(F.max("e.rank").alias("rank"))
    merged = entries.groupBy("column_name").agg(F.array_sort(F.collect_list(F.struct("register", "rank"))).alias("registers"))
    sums = together.groupBy("column_name").agg(F.sum("rows").alias("rows"), F.sum("non_null").alias("non_null"))
    none = F.array().cast("array<struct<register:int,rank:int>>")
    return sums.join(merged, "column_name", "left").select("column_name", "rows", "non_null", F.coalesce("registers", none).alias("registers"))


def profile_counts(profile: DataFrame) -> DataFrame:
    """``column_name, rows, non_null, distinct_estimate`` of a profile."""
    size = float(1 << REGISTER_BITS)
    empty = F.lit(size) - F.size("registers")
    harmonic = F.aggregate("registers", empty, lambda s, r: s + F.pow(F.lit(2.0), -r["rank"]))
    raw = F.lit(0.7213 / (1 + 1.079 / size) * size * size) / harmonic
    # Few values: counted by the registers that stay empty.
    estimate = F.when((raw <= 2.5 * size) & (empty > 0), F.lit(size) * F.ln(F.lit(size) / empty)).otherwise(raw)
    return profile.select("column_name", "rows", "non_null", F.round(estimate).cast("bigint").alias("distinct_estimate"))
