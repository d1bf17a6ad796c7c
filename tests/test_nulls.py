import datetime as dt
from decimal import Decimal

import math

import pytest
from pyspark.sql import types as T

from stepmill import nulls, strings
from tests.conftest import values


def test_nullify_value(frame):
    df = frame("a string, b bigint, c string", [("UNKNOWN", 1, "N/A"), ("x", 2, "-"), (None, None, "y")])
    out = nulls.nullify_value({"a": "UNKNOWN", "b": 2, "c": ["N/A", "-"]})(df)
    assert values(out) == [(None, 1, None), ("x", None, None), (None, None, "y")]


def test_nullify_value_of_another_type_changes_nothing(frame):
    out = nulls.nullify_value({"b": "UNKNOWN"})(frame("b bigint", [(1,), (None,)]))
    assert values(out) == [(1,), (None,)]
    assert isinstance(out.schema["b"].dataType, T.LongType)


def test_nullify_value_missing_column(frame):
    with pytest.raises(ValueError, match="zz"):
        nulls.nullify_value({"zz": "x"})(frame("a string", []))


def test_nullify_range_bounds(frame):
    df = frame("age int, score double", [(0, 0.0), (1, math.nan), (120, 100.0), (121, 100.5), (None, None)])
    out = nulls.nullify_range({"age": (0, 120), "score": (0, 100)})(df)
    assert values(out) == [(None, None), (1, None), (120, 100.0), (None, None), (None, None)]
    assert [f.dataType for f in out.schema] == [T.LongType(), T.DoubleType()]


def test_nullify_range_needs_numbers(frame):
    with pytest.raises(TypeError):
        nulls.nullify_range({"a": (0, 1)})(frame("a string", []))


def test_dropna_by_threshold(frame):
    rows = [(float(i), "x" if i else None, None if i % 2 else 1) for i in range(40)]
    rows[5] = (math.nan, "x", 1)
    df = frame("a double, b string, many int", rows)
    out = nulls.dropna_by_threshold(0.05)(df)
    assert out.count() == 38
    assert nulls.dropna_by_threshold(0.0)(df).count() == 40
    # a column without gaps is checked and drops nothing; one at the threshold is checked
    assert nulls.checked_columns(df, 1 / 40) == ["a", "b"]


def test_dropna_empty_table(frame):
    assert nulls.dropna_by_threshold()(frame("a int", [])).count() == 0


def test_dropna_all_null_column_is_left_alone(frame):
    df = frame("a int, b string", [(1, None), (2, None)])
    assert nulls.dropna_by_threshold(0.5)(df).count() == 2


def test_replace_values(frame):
    df = frame("g string", [("a",), ("b",), ("c",), (None,)])
    out = strings.replace_values("g", {"a": "b", "b": "a", "c": None})(df)
    assert values(out, "g") == ["b", "a", None, None]
    with pytest.raises(ValueError):
        strings.replace_values("zz", {"a": "b"})(df)


def test_dates_and_decimals_as_placeholders(frame):
    df = frame("d date, t timestamp, n decimal(9,2)", [(dt.date(1900, 1, 1), dt.datetime(1900, 1, 1), Decimal("1.50")), (dt.date(2000, 1, 1), dt.datetime(1900, 1, 1, 5), Decimal("2.00"))])
    out = values(nulls.nullify_value({"d": dt.date(1900, 1, 1), "t": dt.datetime(1900, 1, 1), "n": Decimal("1.5")})(df))
    assert out == [(None, None, None), (dt.date(2000, 1, 1), dt.datetime(1900, 1, 1, 5), Decimal("2.00"))]
