import math
import random

import pytest
from pyspark.sql import functions as F

from stepmill import profile, sketch
from tests.conftest import values


def test_shares_and_counts(frame):
    df = frame(
        "a double, b string, c string, d array<int>",
        [(0.0, "x", None, [1]), (-0.0, "x", None, [1]), (math.nan, "y", None, None), (None, None, None, [2])],
    )
    assert values(profile.null_shares(df)) == [("a", 0.5), ("b", 0.25), ("c", 1.0), ("d", 0.25)]
    assert sorted(values(profile.column_counts(df))) == [("a", 2, 1), ("b", 3, 2), ("c", 0, 0), ("d", 3, 2)]
    assert values(profile.null_shares(df, ["b"])) == [("b", 0.25)]


def test_counts_of_nothing(frame):
    assert values(profile.column_counts(frame("a string", []))) == []
    assert values(profile.null_shares(frame("a string", []))) == [("a", None)]


def test_long_texts_are_told_apart(frame):
    rows = [("x" * 100 + str(i % 7),) for i in range(50)] + [("x" * 64,), ("short",), (None,)]
    assert values(profile.column_counts(frame("a string", rows))) == [("a", 52, 9)]


@pytest.mark.parametrize("exact", [True, False])
def test_cast_categorical(frame, exact):
    rows = [(str(i % 5), str(i), None, i % 2, "q") for i in range(100)]
    df = frame("few string, many string, empty string, number int, ignored string", rows)
    out = profile.cast_categorical(ignore_columns=["ignored"], exact=exact)(df)
    assert profile.categorical_columns(out) == ["few"]
    if exact:
        assert out.schema["few"].metadata == {"categorical": True, "categories": 5}
    assert profile.categorical_columns(out.filter("few = '1'")) == ["few"]
    assert profile.categorical_columns(profile.cast_categorical(pct_threshold=0.049)(df.select("few"))) == []


def test_decision_table(frame):
    rows = [(str(i % 5), str(i), None) for i in range(100)]
    df = frame("few string, many string, empty string", rows)
    got = {r.column_name: (r.ratio, r.is_categorical) for r in profile.categorical_decision(df).collect()}
    assert got == {"few": (0.05, True), "many": (1.0, False), "empty": (None, False)}
    ignored = profile.categorical_decision(df, ["few"]).filter("is_categorical")
    assert ignored.count() == 0


@pytest.mark.parametrize("limit", [1_000_000, 10, 0])
def test_category_codes(frame, limit):
    rnd = random.Random(1)
    labels = ["hot" if rnd.random() < 0.4 else None if rnd.random() < 0.2 else f"v{rnd.randrange(60)}" for _ in range(2000)]
    df = frame("id int, label string", list(enumerate(labels)))
    order = {v: i for i, v in enumerate(sorted({x for x in labels if x is not None}))}
    out = profile.category_codes("label", "code", max_broadcast_rows=limit)(df)
    assert out.columns == ["id", "label", "code"]
    assert sorted(values(out)) == sorted(
        ((i, x, order.get(x, -1)) for i, x in enumerate(labels)), key=lambda r: r[0]
    )
    over = profile.category_codes("label", "label", max_broadcast_rows=limit)(df)
    assert sorted(values(over)) == [(i, order.get(x, -1)) for i, x in enumerate(labels)]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_codes_of_long_texts_and_numbers(frame, limit):
    labels = ["x" * 100 + str(i % 3) for i in range(9)] + ["x" * 64, "a", None]
    df = frame("id int, label string", list(enumerate(labels)))
    order = {v: i for i, v in enumerate(sorted({x for x in labels if x is not None}))}
    out = profile.category_codes("label", "code", limit)(df).select("id", "code")
    assert sorted(values(out)) == [(i, order.get(x, -1)) for i, x in enumerate(labels)]
    numbers = profile.category_codes("id", "code", limit)(df.filter("id > 3")).select("id", "code")
    assert sorted(values(numbers)) == [(i, i - 4) for i in range(4, 12)]


def test_hash_keys_are_one_to_one(spark):
    n = 200_000
    df = spark.range(n).select(
        F.col("id").alias("a"),
        (F.col("id") * 0.1).alias("b"),
        F.col("id").cast("int").alias("c"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id / 1000)").alias("d"),
    )
    assert sorted(values(profile.column_counts(df))) == [(c, n, n) for c in "abcd"]


def test_codes_without_values(frame):
    df = frame("label string", [(None,), (None,)])
    assert values(profile.category_codes("label", "code")(df)) == [(None, -1), (None, -1)]
    assert values(profile.category_codes("label", "code", 0)(df)) == [(None, -1), (None, -1)]


def test_streams_are_refused(spark):
    stream = spark.readStream.format("rate").load().select(F.col("value").cast("string").alias("v"))
    with pytest.raises(ValueError, match="stream"):
        profile.cast_categorical()(stream)
    with pytest.raises(ValueError, match="stream"):
        profile.category_codes("v", "c")(stream)


@pytest.mark.parametrize("most", [0, 100])
def test_codes_treat_nan_as_missing(frame, most):
    df = frame("v double", [(2.0,), (float("nan"),), (1.0,), (None,)])
    assert sorted(c for _, c in values(profile.category_codes("v", "code", most)(df))) == [-1, -1, 0, 1]


@pytest.mark.parametrize("most", [0, 100])
def test_codes_of_binary_values(frame, most):
    df = frame("v binary", [(bytearray(b"b" * 5000),), (bytearray(b"a"),), (None,)])
    assert sorted(c for _, c in values(profile.category_codes("v", "code", most)(df))) == [-1, 0, 1]


def test_profiles_merge_to_that_of_the_union(spark):
    df = spark.range(30_000).select(
        F.col("id"), (F.col("id") % 3).cast("string").alias("few"), F.when(F.col("id") % 2 == 0, F.col("id") % 9000).cast("double").alias("half"),
        F.lit(None).cast("string").alias("none"), F.array(F.col("id") % 50).alias("nested"),
    )
    whole = sketch.column_profile(df)
    parts = [sketch.column_profile(df.filter(F.col("id") % 4 == i)) for i in range(4)]
    merged = sketch.merge_profiles([sketch.merge_profiles(parts[:2]), parts[2], parts[3]])
    assert sorted(values(merged)) == sorted(values(whole))
    got = {r.column_name: (r.rows, r.non_null, r.distinct_estimate) for r in sketch.profile_counts(merged).collect()}
    exact = {r.column_name: (r.non_null, r.distinct_values) for r in profile.column_counts(df).collect()}
    for name, (rows, non_null, estimate) in got.items():
        assert rows == 30_000 and non_null == exact[name][0] and abs(estimate - exact[name][1]) <= 0.06 * exact[name][1]
    assert sketch.column_profile(df.select()).count() == 0 and got["none"] == (30_000, 0, 0)
    # a column that one table lacks
    other = sketch.merge_profiles([whole, sketch.column_profile(spark.range(5).withColumn("more", F.lit("x")))])
    assert {r.column_name: r.rows for r in other.collect()}["more"] == 5


def test_estimates_are_named(frame):
    df = frame("few string, near string, many string, empty string", [(str(i % 5), str(i % 50), str(i), None) for i in range(1000)])
    step = profile.cast_categorical(pct_threshold=0.05, exact=False)
    decision = step.fit(df)
    assert decision.estimated == ("empty", "few", "many") and decision.metadata["near"] == {"categorical": True, "categories": 50}
    out = step(df)
    assert profile.categorical_columns(out) == ["few", "near"] and profile.estimated_columns(out) == ["few", "many", "empty"]
    assert profile.estimated_columns(profile.cast_categorical()(df)) == []
