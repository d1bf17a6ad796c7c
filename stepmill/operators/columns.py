"""Column plumbing: drop, rename, cast, fill, row index."""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill.functions.text import as_text
from stepmill.operators.order import with_row_index
from stepmill.plans.pipeline import Step
from stepmill.session import quoted, require_columns

# Dtype names and the Spark type each stands for.
DTYPE_NAMES = {
    "string[pyarrow]": "string",
    "string[python]": "string",
    "uint8": "smallint",
    "UInt8": "smallint",
    "uint16": "int",
    "UInt16": "int",
    "uint32": "bigint",
    "UInt32": "bigint",
    "uint64": "decimal(20,0)",
    "UInt64": "decimal(20,0)",
    "datetime64[us]": "timestamp_ntz",
    "datetime64[ms]": "timestamp_ntz",
    "datetime64[s]": "timestamp_ntz",
    "int": "bigint",
    "int64": "bigint",
    "Int64": "bigint",
    "int32": "int",
    "Int32": "int",
    "int16": "smallint",
    "Int16": "smallint",
    "int8": "tinyint",
    "Int8": "tinyint",
    "float": "double",
    "float64": "double",
    "Float64": "double",
    "float32": "float",
    "Float32": "float",
    "str": "string",
    "string": "string",
    "object": "string",
    "bool": "boolean",
    "boolean": "boolean",
    "datetime64[ns]": "timestamp_ntz",
    "timedelta64[ns]": "interval day to second",
    "category": "string",
}


def drop_columns(column_names: Sequence[str]) -> Step:
    """Drop the listed columns; names the table does not have are ignored."""
    return lambda df: df.drop(*[name for name in column_names if name in df.columns])


def rename_columns(rename_map: dict[str, str]) -> Step:
    """Rename all at once, so that a swap works; unknown names are ignored."""

    def step(df: DataFrame) -> DataFrame:
        return _renamed(df, [rename_map.get(name, name) for name in df.columns])

    return step


def rename_columns_by_replace(pattern_map: dict[str, str]) -> Step:
    """Replace literal substrings in every column name, one pattern after the other."""

    def step(df: DataFrame) -> DataFrame:
        names = df.columns
        for old, new in pattern_map.items():
            names = [name.replace(old, new) for name in names]
        return _renamed(df, names)

    return step


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    doubled = sorted({name for name in names if names.count(name) > 1})
    if doubled:
        raise ValueError(f"renaming gives several columns the same name: {doubled}")
    return df.toDF(*names)


def cast_columns(type_mapping: dict[str, str]) -> Step:
    """Strict casts by dtype name or Spark type name; a value that does not fit fails the job.

    Spark has no unsigned types: they become the next wider type, and a value outside their range fails too.
    """

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, type_mapping)
        casts, tagged = {}, []
        for name, dtype in type_mapping.items():
            c, source, target = F.col(quoted(name)), df.schema[name].dataType, DTYPE_NAMES.get(dtype, dtype)
            if target == "string":
                casts[name] = as_text(c, source)
            else:
                whole = _whole(c, source, name) if _nullable_integer(dtype, source) else c
                casts[name] = _in_range(strict_cast(whole, target, name), dtype, target, name)
            if dtype == "category":
                tagged.append(name)
        out = df.withColumns(casts)
        for name in tagged:
            out = out.withMetadata(name, {"categorical": True})
        return out

    return step


def _nullable_integer(dtype: str, source: T.DataType) -> bool:
    return re.fullmatch(r"U?Int\d+", dtype) is not None and isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType))


def _whole(c: Column, source: T.DataType, label: str) -> Column:
    """The nullable integer types take only whole numbers; NaN is a null. The value keeps its own type."""
    value = c if isinstance(source, T.DecimalType) else F.nanvl(c, F.lit(None).cast(source))
    message = F.concat(F.lit(f"column {label}: cannot safely cast to an integer: "), c.cast("string"))
    return F.when(value % 1 != 0, F.raise_error(message).cast(source)).otherwise(value)


def _in_range(value: Column, dtype: str, target: str, label: str) -> Column:
    bits = re.fullmatch(r"u?U?[iI]nt(\d+)", dtype) if dtype.lower().startswith("uint") else None
    if not bits:
        return value
    message = F.concat(F.lit(f"column {label}: outside {dtype}: "), value.cast("string"))
    most = F.lit(Decimal((1 << int(bits[1])) - 1)).cast(target)
    return F.when((value < 0) | (value > most), F.raise_error(message).cast(target)).otherwise(value)


def strict_cast(c: Column, spark_type: str, label: str) -> Column:
    """A cast that raises on a bad value whatever ``spark.sql.ansi.enabled`` says."""
    value = c.try_cast(spark_type)
    bad = c.isNotNull() & value.isNull()
    message = F.concat(
        F.lit(f"column {label}: cannot cast to {spark_type}: "), c.cast("string")
    )
    return F.when(bad, F.raise_error(message).cast(spark_type)).otherwise(value)


def null_fill(fill_map: dict[str, object]) -> Step:
    """Fill nulls (and NaN) per column; unknown columns are ignored."""

    def step(df: DataFrame) -> DataFrame:
        known = {name: value for name, value in fill_map.items() if name in df.columns}
        for name, value in known.items():
            _check_fill(df.schema[name].dataType, name, value)
        filled = {}
        for name, value in known.items():
            c, dtype = F.col(quoted(name)), df.schema[name].dataType
            present = F.nanvl(c, F.lit(None).cast(dtype)) if isinstance(dtype, (T.DoubleType, T.FloatType)) else c
            filled[name] = F.coalesce(present, F.lit(value).cast(dtype))
        return df.withColumns(filled) if filled else df

    return step


def _check_fill(dtype: T.DataType, name: str, value: object) -> None:
    fits = (
        isinstance(value, bool)
        if isinstance(dtype, T.BooleanType)
        else isinstance(value, str)
        if isinstance(dtype, T.StringType)
        else isinstance(value, int) and not isinstance(value, bool)
        if isinstance(dtype, T.IntegralType)
        else isinstance(value, (int, float)) and not isinstance(value, bool)
        if isinstance(dtype, T.NumericType)
        else False
    )
    if not fits:
        raise ValueError(f"cannot fill column {name} of type {dtype.simpleString()} with {value!r}")


def upgrade_dtype() -> Step:
    """One null kind everywhere: NaN becomes null, nested and void columns become text."""

    def step(df: DataFrame) -> DataFrame:
        return df.select(*[_upgraded(field) for field in df.schema.fields])

    return step


def _upgraded(field: T.StructField) -> Column:
    c = F.col(quoted(field.name))
    if isinstance(field.dataType, T.DoubleType):
        return F.nanvl(c, F.lit(None).cast("double")).alias(field.name)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c).alias(field.name)
    if isinstance(field.dataType, T.NullType):
        return c.cast("string").alias(field.name)
    return c


def reset_index(drop: bool = True, order_by: Sequence[str] = ()) -> Step:
    """``drop=True``: nothing to do, a Spark table has no index. ``drop=False``: put a 0-based row
    number in front, called ``index`` (``level_0`` if that name is taken). Rows need an order to be
    numbered, so ``order_by`` must name columns that are unique together.
    """

    def step(df: DataFrame) -> DataFrame:
        if drop:
            return df
        name = "level_0" if "index" in df.columns else "index"
        return with_row_index(order_by, name)(df).select(name, *[quoted(c) for c in df.columns])

    return step
