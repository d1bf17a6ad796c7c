"""Rules on tables of crawled pages and listings."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepmill.plans.pipeline import Step
from stepmill.session import MAX_BROADCAST_ROWS, quoted, require_columns, small_table


def keep_loaded_pages(sentinel: str, html_column: str = "html") -> Step:
    """Only pages whose HTML holds the sentinel text."""
    return lambda df: df.filter(_has_sentinel(df, sentinel, html_column))


def split_loaded_pages(
    sentinel: str, html_column: str = "html"
) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """Pages with the sentinel, and the others to be logged or fetched again."""

    def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        loaded = _has_sentinel(df, sentinel, html_column)
        return df.filter(loaded), df.filter(~loaded)

    return split


def _has_sentinel(df: DataFrame, sentinel: str, html_column: str) -> Column:
    require_columns(df, [html_column])
    return F.coalesce(F.contains(F.col(quoted(html_column)), F.lit(sentinel)), F.lit(False))


def skip_positions(
    skip_map: dict[str, list[int]],
    category_column: str = "category",
    position_column: str = "subcategory_pos",
) -> Step:
    """Drop the listed subcategory positions of each category; other categories keep all."""
    pairs = [(category, position) for category, listed in skip_map.items() for position in listed]

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, [category_column, position_column])
        if not pairs:
            return df
        skips = small_table(
            df.sparkSession,
            {"__category": [c for c, _ in pairs], "__position": [p for _, p in pairs]},
            {"__category": pa.string(), "__position": pa.int32()},
        )
        if len(pairs) <= MAX_BROADCAST_ROWS:
            skips = F.broadcast(skips)
        return df.join(
            skips,
            (F.col(quoted(category_column)) == F.col("__category"))
            & (F.col(quoted(position_column)) == F.col("__position")),
            "left_anti",
        )

    return step


def target_category(target: str | None, column: str = "category") -> Step:
    """Only rows of the target category; ``None`` keeps all, an unknown target is an error."""

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, [column])
        if target is None:
            return df
        kept = df.filter(F.col(quoted(column)) == target)
        if not df.isStreaming and kept.select(quoted(column)).isEmpty():
            names = df.select(quoted(column)).distinct()
            count, shown = names.count(), [row[0] for row in names.orderBy(quoted(column)).limit(1000).collect()]
            more = f" (the first {len(shown)} of {count})" if count > len(shown) else ""
            raise ValueError(f"category {target!r} not found; available{more}: {shown}")
        return kept

    return step


def page_count(labels: Column) -> Column:
    """The last all-digit label of an array of page labels, 1 if there is none."""
    numbers = F.filter(labels, lambda x: F.regexp_like(F.trim(x), F.lit("^[0-9]+$")))
    return F.coalesce(F.trim(F.try_element_at(numbers, F.lit(-1))).try_cast("int"), F.lit(1))


def drop_tail(items: Column, count: int = 2) -> Column:
    """An array without its last ``count`` elements."""
    return F.slice(items, F.lit(1), F.greatest(F.size(items) - F.lit(count), F.lit(0)))
