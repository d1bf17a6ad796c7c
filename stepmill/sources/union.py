"""Row-wise union of tables whose columns and types drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill.functions.text import as_text
from stepmill.session import quoted

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)


def merged_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """Equal types stay, whole numbers widen, whole and real numbers give double, else text."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    if isinstance(left, _WHOLE) and isinstance(right, _WHOLE):
        return max(left, right, key=lambda t: [type(t) is w for w in _WHOLE].index(True))
    if isinstance(left, _WHOLE + _REAL) and isinstance(right, _WHOLE + _REAL):
        return T.DoubleType()
    return T.StringType()


def union_tree(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by position of tables with the same columns, two by two: the plan is as deep as a tree, not as a list."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [a.union(b) for a, b in zip(frames[::2], frames[1::2], strict=False)] + frames[len(frames) // 2 * 2 :]
    return frames[0]


def union_pages(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; columns a table lacks are null, types are merged first.

    The merge comes before the union because Spark's own union would turn text into numbers where
    the two meet, and fail on the first word. Each table is brought to the merged columns once, and the union
    is a balanced tree, so a thousand tables make a plan in seconds.
    """
    if not frames:
        raise ValueError("no tables to unite")
    schemas = [frame.schema.fields for frame in frames]
    merged: dict[str, T.DataType] = {}
    for fields in schemas:
        for f in fields:
            merged[f.name] = merged_type(merged.get(f.name, f.dataType), f.dataType)

    def aligned(frame: DataFrame, fields: list[T.StructField]) -> DataFrame:
        own = {f.name: f.dataType for f in fields}
        if list(own.items()) == list(merged.items()):
            return frame

        def column(name: str, dtype: T.DataType) -> Column:
            if name not in own:
                return F.lit(None).cast(dtype).alias(name)
            c = F.col(quoted(name))
            if own[name] == dtype:
                return c
            return (as_text(c, own[name]) if isinstance(dtype, T.StringType) else c.cast(dtype)).alias(name)

        return frame.select(*[column(name, dtype) for name, dtype in merged.items()])

    return union_tree([aligned(frame, fields) for frame, fields in zip(frames, schemas, strict=True)])
