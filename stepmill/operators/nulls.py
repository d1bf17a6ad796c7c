"""Null handling. NaN counts as null wherever nulls are tested."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill.plans.fitted import DropRows, WholeTableStep
from stepmill.plans.pipeline import Step
from stepmill.session import quoted, require_columns


def is_missing(c: Column, dtype: T.DataType) -> Column:
    """Null, or NaN for floating-point columns."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nullify_value(null_map: dict[str, object]) -> Step:
    """Whole values equal to the column's placeholder (or to one in a list) become null."""

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, null_map)
        fields = {f.name: f.dataType for f in df.schema.fields}
        changed = {}
        for name, values in null_map.items():
            placeholders = values if isinstance(values, (list, tuple, set)) else [values]
            fitting = [v for v in placeholders if _same_kind(fields[name], v)]
            if fitting:
                c = F.col(quoted(name))
                moment = isinstance(fields[name], (T.DateType, T.TimestampType, T.TimestampNTZType))
                # Dates meet timestamps at midnight, as timestamps.
                changed[name] = F.when(~(c.cast("timestamp_ntz").isin([_at_midnight(v) for v in fitting]) if moment else c.isin(fitting)), c)
        return df.withColumns(changed) if changed else df

    return step


def _at_midnight(value: dt.date) -> Column:
    whole = value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())
    return F.lit(whole.isoformat(sep=" ")).cast("timestamp_ntz")


def _same_kind(dtype: T.DataType, value: object) -> bool:
    """A value of another kind can equal nothing in the column, so it is left out of the test."""
    if isinstance(dtype, T.StringType):
        return isinstance(value, str)
    if isinstance(dtype, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(dtype, T.NumericType):
        return isinstance(value, (int, float, Decimal)) and not isinstance(value, bool)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return isinstance(value, dt.date)  # a datetime is a date too
    if isinstance(dtype, (T.BinaryType, T.ArrayType, T.MapType, T.StructType)) and value is not None:
        raise ValueError(f"no placeholder can be given for a column of type {dtype.simpleString()}")
    return False


def nullify_range(range_map: dict[str, tuple[float, float]]) -> Step:
    """Keep values above the lower bound and not above the upper one; all others become null."""

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, range_map)
        changed = {}
        for name, (low, high) in range_map.items():
            dtype = df.schema[name].dataType
            if isinstance(dtype, T.IntegralType):
                out = "bigint"
            elif isinstance(dtype, (T.DoubleType, T.FloatType)):
                out = "double"
            else:
                raise TypeError(f"column {name} is {dtype.simpleString()}, not int or float")
            c = F.col(quoted(name))
            changed[name] = F.when((c > low) & (c <= high), c).cast(out)
        return df.withColumns(changed)

    return step


def checked_columns(df: DataFrame, pct_threshold: float) -> list[str]:
    """Columns whose share of missing values is at most the threshold: one aggregation for all."""
    shares = df.agg(
        *[
            F.avg(is_missing(F.col(quoted(f.name)), f.dataType).cast("double")).alias(f"s{i}")
            for i, f in enumerate(df.schema.fields)
        ]
    ).first()
    return [
        name for name, share in zip(df.columns, shares) if share is not None and share <= pct_threshold
    ]


def dropna_by_threshold(pct_threshold: float = 0.05) -> WholeTableStep:
    """Drop rows with a missing value in any column that has few of them.

    Columns above the threshold are left alone. Reads the table once for the shares, once for the
    rows; persist it first when it is costly to compute. ``fit`` gives the decision alone, for later batches and streams.
    """
    return WholeTableStep("dropna_by_threshold", lambda df: DropRows(tuple(checked_columns(df, pct_threshold) if df.columns else ())))
