import datetime as dt
import math
import random
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stepmill import order, union_pages
from stepmill.session import release, scratch
from tests.conftest import values


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_index_against_sorted_rows(spark):
    rnd = random.Random(3)
    # two thirds of the rows share the leading key; one key is null
    rows = [("a" if rnd.random() < 0.67 else rnd.choice("bcd"), i) for i in range(5000)] + [(None, 1)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int")
    out = order.with_row_index(["k", "i"], "n")(df)
    assert out.columns == ["k", "i", "n"]
    expected = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    assert [r[:2] for r in sorted(values(out), key=lambda r: r[2])] == expected
    assert sorted(values(out, "n")) == list(range(len(rows)))


def test_row_index_never_uses_one_task(spark):
    out = order.with_row_index(["id"], "n")(spark.range(1000))
    assert "SinglePartition" not in plan(out)


def many_kinds(spark, seed):
    """Keys of every kind with a literal: nulls, NaN, ties in the leading one, odd texts, old and new moments."""
    rnd = random.Random(seed)
    texts = ["", " ", "a'b", "é", "z\\n", "\U0001d11e", None, "a"]
    rows = [
        (
            rnd.choice(texts),
            rnd.choice([None, math.nan, -0.0, 0.0, math.inf, 1e300, 0.1]),
            rnd.choice([None, True, False]),
            rnd.choice([None, Decimal("1.10"), Decimal("-99999999.01")]),
            rnd.choice([None, dt.date(1, 1, 1), dt.date(2024, 10, 27)]),
            rnd.choice([None, dt.datetime(1900, 1, 1), dt.datetime(2024, 10, 27, 2, 30, 0, 123456)]),
            rnd.choice([None, b"", b"\x00\xff", b"a"]),
            i,
        )
        for i in range(600)
    ]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "s string, d double, b boolean, n decimal(10,2), day date, at timestamp_ntz, raw binary, i int")
    return df.withColumn("instant", F.col("at").cast("timestamp")).repartition(4)


@pytest.mark.parametrize("names", [["s", "i"], ["d", "i"], ["b", "n", "i"], ["day", "at", "i"], ["instant", "raw", "i"], ["i"]])
def test_ranks_of_all_kinds_of_keys(spark, monkeypatch, names):
    monkeypatch.setattr(order, "BUCKET_ROWS", 20)
    monkeypatch.setattr(order, "ROUND_BUCKETS", 3)
    df = many_kinds(spark, 5)
    want = [r["i"] for r in df.orderBy(*[F.col(n).asc_nulls_last() for n in names]).collect()]
    numbered = order.with_row_index(names, "at_row")(df)
    assert {r["i"]: r["at_row"] for r in numbered.collect()} == {i: n for n, i in enumerate(want)}
    for cap in (1, 300, 600):
        assert {r["i"] for r in order.record_cap(cap, names)(df).collect()} == set(want[:cap])
    got = order.paged_slice(names, offset=250, seed_limit=70, chunk_limit=30)(df).collect()
    assert {(r["i"], r["row_index"], r["page"]) for r in got} == {(i, n, (n - 250) // 30) for n, i in enumerate(want) if 250 <= n < 340}


def test_unique_keys_land_nothing(spark):
    with scratch(spark) as tables:
        df = spark.range(5000)
        order.with_row_index(["id"])(df).count()
        order.record_cap(70, ["id"])(df).count()
        order.paged_slice(["id"], offset=100, seed_limit=1000)(df).count()
    assert tables == []


def test_a_cap_is_a_pushed_filter(spark, tmp_path):
    spark.range(5000).withColumn("x", F.col("id") * 2).write.parquet(str(tmp_path / "t"))
    text = plan(order.record_cap(70, ["id"])(spark.read.parquet(str(tmp_path / "t"))))
    assert "LessThanOrEqual(id,69)" in text and "Exchange" not in text and "Sort" not in text


def test_equal_keys_are_still_numbered_and_cut(spark, monkeypatch):
    monkeypatch.setattr(order, "BUCKET_ROWS", 10)
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2)).repartition(4)
    got = order.with_row_index(["k"], "n")(df).orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1000)) and [r["k"] for r in got] == sorted(r["k"] for r in got)
    assert order.record_cap(100, ["k"])(df).count() == 100
    assert order.paged_slice(["k"], offset=100, seed_limit=200, chunk_limit=50)(df).count() == 200


def test_keys_without_literals(spark):
    df = spark.range(100).select(F.array(99 - F.col("id")).alias("k"), "id")
    assert sorted(values(order.record_cap(3, ["k"])(df), "id")) == [97, 98, 99]
    assert sorted(values(order.paged_slice(["k"], offset=2, seed_limit=2, chunk_limit=2)(df), "id")) == [96, 97]


def test_row_index_of_nothing(spark):
    assert values(order.with_row_index(["id"])(spark.range(0))) == []


def test_order_is_required(spark):
    with pytest.raises(ValueError, match="order_by"):
        order.with_row_index([])(spark.range(3))
    with pytest.raises(ValueError, match="zz"):
        order.record_cap(3, ["zz"])(spark.range(3))


def test_page_plan(spark):
    got = values(order.page_plan(spark, -500, 2500, 1000, 2))
    assert sorted(got) == [(0, -500, 1000, 0), (1, 500, 1000, 0), (2, 1500, 1000, 1)]


@pytest.mark.parametrize("seed, chunk, offset", [(25, 10, 5), (30, 10, 0), (7, 7, 95), (10, 5, -7)])
def test_paged_slice(spark, seed, chunk, offset):
    df = spark.range(100).select((99 - F.col("id")).alias("id"))
    got = values(order.paged_slice(["id"], offset=offset, seed_limit=seed, chunk_limit=chunk)(df))
    pages = -(-seed // chunk)
    expected = [
        (i, i, (i - offset) // chunk) for i in range(100) if offset <= i < offset + pages * chunk
    ]
    assert sorted(got) == expected


def test_nothing_to_slice(spark):
    empty = spark.range(0)
    assert values(order.paged_slice(["id"])(empty)) == [] and values(order.record_cap(5, ["id"])(empty)) == []
    assert values(order.paged_slice(["id"], offset=50)(spark.range(20))) == []


def test_record_cap(spark):
    df = spark.range(100).repartition(5)
    assert sorted(values(order.record_cap(7, ["id"])(df))) == [(i,) for i in range(7)]
    assert order.record_cap(None, ["id"])(df).count() == 100
    assert order.record_cap(0, ["id"])(df).count() == 0
    assert order.record_cap(-3, ["id"])(df).count() == 0
    assert order.record_cap(1000, ["id"])(df).count() == 100


def test_caps_gather_nothing_in_one_task(spark):
    text = plan(order.record_cap(7, ["id"])(spark.range(100)))
    assert "TakeOrdered" not in text and "SinglePartition" not in text


def test_scratch_is_empty_after_release(spark, tmp_path):
    with scratch(spark) as tables:
        equal = spark.range(100).withColumn("k", F.array("id"))
        order.with_row_index(["k"])(equal).select("index").write.parquet(str(tmp_path / "out"))
    places = [Path(t.removeprefix("file:")) for t in tables]
    assert places and all(p.exists() for p in places)
    release(spark, tables)
    assert not any(p.exists() for p in places)


def test_union_merges_types_and_columns(frame):
    a = frame("id int, x bigint, y bigint", [(1, 10, 7)])
    b = frame("y string, id bigint, x double", [("word", 2, 0.5)])
    c = frame("z boolean, y boolean", [(True, False)])
    out = union_pages([a, b, c])
    assert out.dtypes == [("id", "bigint"), ("x", "double"), ("y", "string"), ("z", "boolean")]
    assert sorted(values(out), key=str) == sorted(
        [(1, 10.0, "7", None), (2, 0.5, "word", None), (None, None, "False", True)], key=str
    )
    with pytest.raises(ValueError):
        union_pages([])


def test_union_of_many_pages(spark):
    frames = [spark.range(i, i + 1, numPartitions=1).selectExpr("id", f"{'id' if i % 2 else repr('x')} AS c{i % 3}") for i in range(200)]
    out = union_pages(frames)
    assert out.dtypes == [("id", "bigint"), ("c0", "string"), ("c1", "string"), ("c2", "string")]
    rows = {r["id"]: r for r in out.collect()}
    assert len(rows) == 200 and rows[4]["c1"] == "x" and rows[7]["c1"] == "7" and rows[7]["c0"] is None
    depth = out._jdf.queryExecution().analyzed().toString().count("Union")
    assert depth < 200
