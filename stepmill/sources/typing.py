"""Typing of text columns by a vote over all their values, in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepmill.functions.text import DECIMAL_TEXT, INFINITE_TEXT, INTEGER_TEXT
from stepmill.session import quoted

# Cell texts that stand for a missing value.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
# Cell texts that are booleans.
BOOLEAN_TOKENS = ["True", "TRUE", "true", "False", "FALSE", "false"]


def null_tokens(c: Column) -> Column:
    return F.when(~c.isin(NULL_TOKENS), c)


def _as_bigint(c: Column) -> Column:
    return F.when(F.regexp_like(c, F.lit(INTEGER_TEXT)), F.trim(c).try_cast("bigint"))


def _as_double(c: Column) -> Column:
    spelled = F.regexp_like(c, F.lit(DECIMAL_TEXT)) | F.regexp_like(c, F.lit(INFINITE_TEXT))
    return F.when(spelled, F.trim(c).try_cast("double"))


def _as_boolean(c: Column) -> Column:
    return F.when(c.isin(BOOLEAN_TOKENS), F.lower(c) == "true")


_TYPED = {"bigint": _as_bigint, "double": _as_double, "boolean": _as_boolean, "string": lambda c: c}


def vote(df: DataFrame, columns: Sequence[str], *extra: Column) -> tuple[dict[str, str], list]:
    """The type of every column: the first of bigint, double, boolean that all its values fit,
    else string. A column without any value is double. ``extra`` aggregates ride along.
    """
    tallies = []
    for i, name in enumerate(columns):
        c = F.col(quoted(name))
        whole = F.regexp_like(c, F.lit(INTEGER_TEXT))
        tallies += [
            F.count(c).alias(f"all{i}"),
            F.count(_as_bigint(c)).alias(f"bigint{i}"),
            # Whole numbers beyond bigint would lose digits as doubles: they keep a column text.
            F.count(F.when(~whole | _as_bigint(c).isNotNull(), _as_double(c))).alias(f"double{i}"),
            F.count(_as_boolean(c)).alias(f"boolean{i}"),
        ]
    row = df.agg(*tallies, *extra).first()
    types = {}
    for i, name in enumerate(columns):
        total = row[f"all{i}"]
        order = ("bigint", "double", "boolean") if total else ("double",)
        types[name] = next((t for t in order if row[f"{t}{i}"] == total), "string")
    return types, list(row)[len(tallies):]


def typed(columns: dict[str, str]) -> list[Column]:
    """Select list that types text columns as voted."""
    return [_TYPED[t](F.col(quoted(name))).alias(name) for name, t in columns.items()]
