"""Text steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmill.functions import text
from stepmill.plans.pipeline import Step
from stepmill.session import quoted, require_columns


def trim_regex_whitespace(col_names: Sequence[str]) -> Step:
    """Each run of blanks becomes one space. The ends are squeezed like the rest, not trimmed."""

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, col_names)
        return df.withColumns({name: text.squeeze_ascii(F.col(quoted(name))) for name in col_names})

    return step


def normalize_trim_case(case_map: dict[str, Sequence[str]]) -> Step:
    """Trim, then ``"title"`` or ``"capitalize"`` the listed columns; other keys are ignored.

    A column listed under both ends in title case.
    """
    title, capital = list(case_map.get("title", [])), list(case_map.get("capitalize", []))

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, [*capital, *title])
        changed = {}
        for name in [*capital, *title]:
            trimmed = text.trim_blanks(text.as_text(F.col(quoted(name)), df.schema[name].dataType))
            changed[name] = text.title(trimmed) if name in title else text.capitalize(trimmed)
        return df.withColumns(changed) if changed else df

    return step


def merge_string_columns(
    col_to_merge: Sequence[str], new_merge_name: str, delimiter: str = "/"
) -> Step:
    """Join the text of the columns, then strip delimiter characters from both ends.

    A null counts as an empty text between two delimiters. The source columns are dropped, except
    one that carries the output name.
    """
    if not col_to_merge:
        raise ValueError("no columns to merge")

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, col_to_merge)
        parts = [
            F.coalesce(text.as_text(F.col(quoted(name)), df.schema[name].dataType), F.lit(""))
            for name in col_to_merge
        ]
        merged = F.concat_ws(delimiter, *parts)
        if delimiter:
            merged = F.btrim(merged, F.lit(delimiter))
        return df.withColumn(new_merge_name, merged).drop(
            *[name for name in col_to_merge if name != new_merge_name]
        )

    return step


def replace_values(col: str, col_mapping: dict) -> Step:
    """Replace whole values, all pairs at once, so that a swap works."""

    def step(df: DataFrame) -> DataFrame:
        require_columns(df, [col])
        if not col_mapping:
            return df
        c, dtype, out = F.col(quoted(col)), df.schema[col].dataType, None
        for old, new in col_mapping.items():
            hit = c.isNull() if old is None else c == F.lit(old)
            value = F.lit(new).cast(dtype)
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return df.withColumn(col, out.otherwise(c))

    return step
