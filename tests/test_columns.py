import math
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill import columns, transform_data
from tests.conftest import values


def test_pipeline_runs_in_order(frame):
    df = frame("a int", [(1,)])
    steps = [lambda d: d.withColumn("a", F.col("a") + 1), lambda d: d.withColumn("a", F.col("a") * 10)]
    assert values(transform_data(steps, df)) == [(20,)]
    assert values(transform_data([], df)) == [(1,)]


def test_drop_ignores_unknown(frame):
    df = frame("a int, b int", [(1, 2)])
    assert columns.drop_columns(["b", "zz"])(df).columns == ["a"]


def test_rename_swaps(frame):
    out = columns.rename_columns({"a": "b", "b": "a", "zz": "y"})(frame("a int, b int", [(1, 2)]))
    assert out.columns == ["b", "a"]
    assert values(out) == [(1, 2)]


def test_rename_by_replace(frame):
    step = columns.rename_columns_by_replace({" ": "_", "-": "_"})
    df = frame("a int, b int", [(1, 2)]).toDF("first name", "user-id")
    assert step(df).columns == ["first_name", "user_id"]
    # one pattern after the other
    assert columns.rename_columns_by_replace({"a": "b", "b": "c"})(frame("ab int", [(1,)])).columns == ["cc"]


def test_rename_collision(frame):
    with pytest.raises(ValueError, match="same name"):
        columns.rename_columns_by_replace({"-": "_"})(frame("x int, y int", []).toDF("a-b", "a_b"))


def test_cast(frame):
    df = frame("a string, b double, c bigint", [("1", 2.0, 3), (None, None, None), ("2", float("nan"), 4)])
    out = columns.cast_columns({"a": "int64", "b": "Int64", "c": "str"})(df)
    assert [f.dataType for f in out.schema] == [T.LongType(), T.LongType(), T.StringType()]
    assert values(out) == [(1, 2, "3"), (None, None, None), (2, None, "4")]


def test_cast_to_nullable_integer_takes_whole_numbers_only(frame):
    df = frame("a double", [(2.9,)])
    with pytest.raises(Exception, match="cannot safely cast"):
        columns.cast_columns({"a": "Int64"})(df).collect()
    assert values(columns.cast_columns({"a": "int64"})(df)) == [(2,)]


def test_whole_decimals_and_doubles_keep_every_digit(frame):
    big = 9007199254740993
    df = frame("a decimal(20,0), b decimal(38,2), c double, d decimal(20,0)", [(Decimal(big), Decimal(f"{big}.00"), 2.0**60, Decimal(2**64 - 1)), (None, None, math.nan, None)])
    out = columns.cast_columns({"a": "Int64", "b": "Int64", "c": "Int64", "d": "UInt64"})(df)
    assert values(out) == [(big, big, 2**60, Decimal(2**64 - 1)), (None, None, None, None)]
    with pytest.raises(Exception, match="cannot safely cast"):
        columns.cast_columns({"a": "Int64"})(frame("a decimal(20,2)", [(Decimal("1.50"),)])).collect()
    with pytest.raises(Exception, match="cannot safely cast"):
        columns.cast_columns({"a": "Int64"})(frame("a double", [(math.inf,)])).collect()


@pytest.mark.parametrize("dtype, bits", [("UInt8", 8), ("uint8", 8), ("UInt16", 16), ("uint32", 32), ("UInt64", 64)])
def test_unsigned_types_have_their_range(frame, dtype, bits):
    most = (1 << bits) - 1
    fits = frame("a string, b decimal(38,0)", [("0", Decimal(0)), (str(most), Decimal(most)), (None, None)])
    assert [tuple(map(lambda x: x and int(x), r)) for r in values(columns.cast_columns({"a": dtype, "b": dtype})(fits))] == [(0, 0), (most, most), (None, None)]
    for bad in (-1, most + 1):
        with pytest.raises(Exception, match="outside|cannot cast"):
            columns.cast_columns({"b": dtype})(frame("b decimal(38,0)", [(Decimal(bad),)])).collect()


def test_more_dtype_names(frame):
    out = columns.cast_columns({"a": "string[pyarrow]", "b": "UInt8", "c": "datetime64[s]"})(frame("a int, b int, c string", [(1, 2, "2020-01-02")]))
    assert [f.dataType for f in out.schema] == [T.StringType(), T.ShortType(), T.TimestampNTZType()]


def test_fill_on_odd_names(frame):
    df = frame("x double, y string", [(float("nan"), None), (1.0, "k")]).toDF("a.b", "c d")
    assert values(columns.null_fill({"a.b": 0.5, "c d": "none"})(df)) == [(0.5, "none"), (1.0, "k")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cast_is_strict(spark, frame, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="cannot cast"):
            columns.cast_columns({"a": "int64"})(frame("a string", [("x",)])).collect()
        with pytest.raises(PySparkException, match="cannot cast"):
            columns.cast_columns({"a": "int64"})(frame("a double", [(math.nan,)])).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_cast_missing_column(frame):
    with pytest.raises(ValueError, match="zz"):
        columns.cast_columns({"zz": "int"})(frame("a int", []))


def test_cast_category_marks(frame):
    out = columns.cast_columns({"a": "category"})(frame("a string", [("x",)]))
    assert out.schema["a"].metadata == {"categorical": True}


def test_null_fill(frame):
    df = frame("a double, b string, c bigint", [(math.nan, None, None), (1.0, "x", 2)])
    out = columns.null_fill({"a": 0.0, "b": "-", "c": 7, "zz": 1})(df)
    assert values(out) == [(0.0, "-", 7), (1.0, "x", 2)]


@pytest.mark.parametrize("fill", [{"a": "text"}, {"b": 1}, {"c": 1.5}, {"c": True}])
def test_null_fill_other_type(frame, fill):
    with pytest.raises(ValueError, match="cannot fill"):
        columns.null_fill(fill)(frame("a double, b string, c bigint", []))


def test_upgrade(spark):
    df = spark.sql(
        "select double('NaN') d, 1L n, 'x' s, 1 i, array(1, 2) a, named_struct('k', 1) st, null v, true b"
    )
    out = columns.upgrade_dtype()(df)
    assert values(out) == [(None, 1, "x", 1, "[1,2]", '{"k":1}', None, True)]
    assert isinstance(out.schema["v"].dataType, T.StringType)
    assert isinstance(out.schema["i"].dataType, T.IntegerType)


def test_reset_index(frame):
    df = frame("k int, index string", [(30, "c"), (10, "a"), (20, "b")])
    assert columns.reset_index()(df) is df
    out = columns.reset_index(drop=False, order_by=["k"])(df)
    assert out.columns == ["level_0", "k", "index"]
    assert sorted(values(out)) == [(0, 10, "a"), (1, 20, "b"), (2, 30, "c")]
    with pytest.raises(ValueError, match="order_by"):
        columns.reset_index(drop=False)(df)
