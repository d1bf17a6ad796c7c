"""Whole-table column statistics and what is decided from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill.functions.text import as_text
from stepmill.operators.nulls import is_missing
from stepmill.operators.order import with_row_index
from stepmill.operators.sketch import column_profile, profile_counts
from stepmill.plans.fitted import MarkColumns, WholeTableStep
from stepmill.plans.pipeline import Step
from stepmill.session import MAX_BROADCAST_ROWS, materialise, quoted, require_batch, require_columns

#: Longer texts are compared by digest, so that distinct counts do not shuffle whole documents.
_DIGEST_ABOVE_BYTES = 64


def _fields(df: DataFrame, columns: Sequence[str] | None) -> list[T.StructField]:
    require_columns(df, columns or ())
    return [f for f in df.schema.fields if columns is None or f.name in columns]


def null_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, null_share``: share of missing values, all columns in one aggregation."""
    fields = _fields(df, columns)
    row = df.agg(
        *[
            F.avg(is_missing(F.col(quoted(f.name)), f.dataType).cast("double")).alias(f"s{i}")
            for i, f in enumerate(fields)
        ]
    )
    pairs = [
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"s{i}").alias("null_share"))
        for i, f in enumerate(fields)
    ]
    return row.select(F.inline(F.array(*pairs)))


# For one value of at most 64 bits, xxhash64 is a chain of one-to-one steps: equal hashes mean equal
# values. It also joins 0.0 and -0.0.
_FIXED_WIDTH = (
    T.BooleanType,
    T.IntegralType,
    T.DoubleType,
    T.FloatType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.DayTimeIntervalType,
    T.YearMonthIntervalType,
)


def _distinct_key(c: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """A number or a text that is equal exactly when the values are; the other one is null."""
    no_number, no_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    if isinstance(dtype, _FIXED_WIDTH):
        return F.when(~is_missing(c, dtype), F.xxhash64(c)), no_text
    return no_number, _short_key(F.hex(c) if isinstance(dtype, T.BinaryType) else as_text(c, dtype))


def _short_key(text: Column) -> Column:
    """The text, or its digest when it is long, so that no shuffle or broadcast carries whole
    documents. A digest has 65 bytes, so it cannot meet a text that is kept as it is.
    """
    digest = F.concat(F.lit("\x00"), F.sha2(text.cast("binary"), 256))
    return F.when(F.octet_length(text) <= _DIGEST_ABOVE_BYTES, text).otherwise(digest)


def column_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, non_null, distinct_values``, exact.

    The columns are turned into narrow (column, value) rows that are counted on the map side before
    the one shuffle, so a value that fills a third of the table travels once per task.
    """
    fields = _fields(df, columns)
    if not fields:
        return df.sparkSession.createDataFrame(
            [], "column_name string, non_null bigint, distinct_values bigint"
        )
    cells = []
    for i, f in enumerate(fields):
        cells += [F.lit(i), *_distinct_key(F.col(quoted(f.name)), f.dataType)]
    long = df.select(F.stack(F.lit(len(fields)), *cells).alias("at", "number", "text"))
    missing = F.col("number").isNull() & F.col("text").isNull()
    names = F.array(*[F.lit(f.name) for f in fields])
    return (
        long.groupBy("at", "number", "text")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("at")
        .agg(
            F.coalesce(F.sum(F.when(~missing, F.col("rows"))), F.lit(0)).alias("non_null"),
            F.count(F.when(~missing, 1)).alias("distinct_values"),
        )
        .select(names[F.col("at")].alias("column_name"), "non_null", "distinct_values")
    )


def categorical_decision(
    df: DataFrame, ignore_columns: Sequence[str] | None = None, pct_threshold: float = 0.05
) -> DataFrame:
    """``column_name, non_null, distinct_values, ratio, is_categorical`` of every text column."""
    counts = column_counts(df, _text_columns(df, ()))
    ratio = F.try_divide(F.col("distinct_values").cast("double"), F.col("non_null").cast("double"))
    ignored = F.col("column_name").isin(list(ignore_columns or ()))
    return counts.withColumn("ratio", ratio).withColumn(
        "is_categorical",
        F.coalesce((F.col("non_null") > 0) & (F.col("ratio") <= pct_threshold), F.lit(False)) & ~ignored,
    )


def _text_columns(df: DataFrame, ignore: Sequence[str]) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in ignore
    ]


def cast_categorical(
    ignore_columns: Sequence[str] | None = None, pct_threshold: float = 0.05, exact: bool = True
) -> WholeTableStep:
    """Mark text columns with few distinct values as categorical, in the column metadata.

    The metadata holds ``categorical`` and, when it was counted exactly, ``categories``. ``fit`` gives the
    decision alone, for later batches and streams.

    ``exact=False`` settles columns that are far from the threshold by a sketch, without a shuffle of their
    values, and counts only the others exactly. All columns so settled, marked or not, carry ``estimated`` in
    their metadata, and the decision names them.
    """

    def decide(df: DataFrame) -> MarkColumns:
        candidates = _text_columns(df, ignore_columns or ())
        settled = {} if exact or not candidates else settled_by_profile(column_profile(df, candidates), pct_threshold)
        marked = {name: {"categorical": is_cat, "estimated": True} for name, is_cat in settled.items()}
        candidates = [name for name in candidates if name not in settled]
        if candidates:
            for row in column_counts(df, candidates).collect():  # one row per column
                if row.non_null and row.distinct_values / row.non_null <= pct_threshold:
                    marked[row.column_name] = {"categorical": True, "categories": row.distinct_values}
        return MarkColumns(marked, tuple(sorted(settled)))

    return WholeTableStep("cast_categorical", decide)


def settled_by_profile(profile: DataFrame, pct_threshold: float) -> dict[str, bool]:
    """Whether a column is categorical, for columns whose estimated ratio is over a tenth away from the threshold.

    A tenth is six standard errors of the estimate.
    """
    settled = {}
    for row in profile_counts(profile).collect():  # one row per column
        ratio = row.distinct_estimate / row.non_null if row.non_null else None
        if ratio is None:
            settled[row.column_name] = False
        elif abs(ratio - pct_threshold) > 0.1 * pct_threshold:
            settled[row.column_name] = ratio <= pct_threshold
    return settled


def estimated_columns(df: DataFrame) -> list[str]:
    """Names of the columns that :func:`cast_categorical` settled by an estimate."""
    return [f.name for f in df.schema.fields if f.metadata.get("estimated")]


def categorical_columns(df: DataFrame) -> list[str]:
    """Names of the columns marked by :func:`cast_categorical`."""
    return [f.name for f in df.schema.fields if f.metadata.get("categorical")]


def category_codes(
    column: str, output_column: str, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> Step:
    """Number the sorted distinct values 0, 1, ... and give each row its number; null and NaN get -1.

    A dictionary of at most ``max_broadcast_rows`` values (long texts as digests, so at most some
    80 bytes each) is broadcast. With a larger one, values
    that are frequent enough to overload one task are looked up by a broadcast of just those values
    and never shuffled; only the other rows are joined by shuffle.
    """

    def step(df: DataFrame) -> DataFrame:
        require_batch(df, "category_codes")
        require_columns(df, [column])
        value = F.col(quoted(column))
        missing = is_missing(value, df.schema[column].dataType)
        # Numbering and looking up read it several times, so it is landed: one row a value.
        found = materialise(df.filter(~missing).groupBy(value.alias("__value")).agg(F.count(F.lit(1)).alias("__rows")), "dictionary")
        dictionary = found.transform(with_row_index(["__value"], "__code"))
        kept = [F.col(quoted(c)) for c in df.columns if c != output_column]

        def short(c: Column) -> Column:
            if isinstance(df.schema[column].dataType, _FIXED_WIDTH + (T.DecimalType,)):
                return c
            return _short_key(c if isinstance(df.schema[column].dataType, (T.StringType, T.BinaryType)) else as_text(c, df.schema[column].dataType))

        key = F.when(~missing, short(value))  # a null key finds nothing
        entry = short(F.col("__value"))
        same = key == F.col("__key")

        def lookup(rows: DataFrame, codes: DataFrame) -> DataFrame:
            code = F.coalesce(F.col("__code"), F.lit(-1)).cast("bigint").alias(output_column)
            return rows.join(codes, same, "left").select(*kept, code)

        size, total = dictionary.agg(F.count(F.lit(1)), F.sum("__rows")).first()
        codes = dictionary.select(entry.alias("__key"), "__code")
        if size <= max_broadcast_rows:
            return lookup(df, F.broadcast(codes))
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Fewer than `tasks` values can fill more than a fair share of the tasks.
        frequent = dictionary.filter(F.col("__rows") > F.lit((total or 0) / tasks))
        hot = F.broadcast(frequent.select(entry.alias("__key"), "__code"))
        settled = df.join(hot, same, "left").filter(F.col("__code").isNotNull() | missing)
        settled = settled.select(*kept, F.coalesce(F.col("__code"), F.lit(-1)).alias(output_column))
        others = df.filter(~missing).join(hot, same, "left_anti")
        return settled.unionByName(lookup(others, codes))

    return step
