import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill import records
from stepmill.functions import text
from tests.conftest import values

WIDE = "  Ｔｈｅ\xa0​Example\nBook  "


def test_record_normaliser(frame):
    df = frame("title string, author string, n int", [(WIDE, "   ", 1), (None, "", 2)])
    assert values(records.normalize_record()(df)) == [("The Example Book", None, 1), (None, None, 2)]
    assert values(records.normalize_record(["title"])(df), "author") == ["   ", ""]


def test_order_of_normalisers(frame):
    df = frame("a string", [("a ​ b",), ("​ x",), ("x　ｙ﻿",)])
    assert values(records.normalize_text()(df), "a") == ["a  b", " x", "x y"]
    assert values(records.normalize_text(order="text_first")(df), "a") == ["a b", "x", "x y"]
    with pytest.raises(ValueError):
        records.normalize_text(order="other")


def test_ascii_text_is_not_sent_to_python(frame):
    df = frame("a string", [("plain",), ("ﬁ",), (None,)]).select(text.nfkc(F.col("a")).alias("a"))
    assert values(df, "a") == ["plain", "fi", None]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN NOT" in plan


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("added", ["\u200b", "\u2026 \ufb01"])
def test_a_batch_is_normalised_piece_by_piece(kind, added):
    texts = [None if i % 7 == 0 else "" if i % 11 == 0 else f"{i} {'plain words ' * 200}{added}" for i in range(4000)]
    batch = pa.array(["left out", *texts], type=kind).slice(1)
    tracemalloc.start()
    out = text._nfkc.func(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.type == kind
    assert out.to_pylist() == [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]
    # The batch as Python text: 15 MB.
    assert peak < 4_000_000


def test_normal_and_other_pieces_of_a_batch(monkeypatch):
    monkeypatch.setattr(text, "_PIECE_CHARS", 3)
    texts = ["\xe9\xe8", None, "\xe9\xe8", "\u2026", "", None, "\uff34\uff48\uff45", "\xe9\xe8\xea\xe9", "a\u0301", "\ufdfa", None]
    for first in range(len(texts) + 1):
        for end in range(first, len(texts) + 1):
            out = text._nfkc.func(pa.array(texts, type=pa.string()).slice(first, end - first))
            assert out.to_pylist() == [t and unicodedata.normalize("NFKC", t) for t in texts[first:end]]


MODEL = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType(), False, {"min_length": 1}),
    T.StructField("price", T.DoubleType()),
])
ROWS = [("a", "c", "1.5"), ("b", "", "2"), ("c", None, "3"), ("d", "x", "cheap"), (None, "x", None)]


def test_quarantine(frame):
    df = frame("name string, category string, price string, extra int", [(*r, 1) for r in ROWS])
    good, rejected = records.quarantine(MODEL)(df)
    assert good.schema.fieldNames() == ["name", "category", "price"]
    assert values(good) == [("a", "c", 1.5), (None, "x", None)]
    assert values(rejected) == [
        ("b", "", "2", "category: too short"),
        ("c", None, "3", "category: missing"),
        ("d", "x", "cheap", "price: not a double"),
    ]


@pytest.mark.parametrize("bad, message", [(1, "too short"), (2, "missing"), (3, "not a double")])
def test_conform_fails_on_a_bad_record(frame, bad, message):
    df = frame("name string, category string, price string", [ROWS[0], ROWS[bad]])
    with pytest.raises(PySparkException, match=message):
        records.conform(MODEL)(df).collect()
    # also when the bad field is not asked for
    with pytest.raises(PySparkException, match=message):
        records.conform(MODEL)(df).select("name").collect()


def test_checks_do_not_repeat_the_work_of_earlier_steps(frame):
    df = frame("name string, category string, price string", [ROWS[0]]).transform(records.normalize_text())
    good, rejected = records.quarantine(MODEL)(df)
    for out in (records.conform(MODEL)(df), good, rejected):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1


def test_conform_good(frame):
    df = frame("price string, category string, extra int, name string", [("1.5", "c", 1, "a")])
    assert values(records.conform(MODEL)(df)) == [("a", "c", 1.5)]


def test_field_without_value_or_default(frame):
    df = frame("name string, category string", [("a", "c")])
    with pytest.raises(ValueError, match="price"):
        records.project_to_model(MODEL)(df)
    assert values(records.project_to_model(MODEL, {"price": 0.0})(df)) == [("a", "c", 0.0)]


def test_quarantine_judges_once(spark, tmp_path):
    model = T.StructType([T.StructField("name", T.StringType(), False, {"min_length": 1}), T.StructField("n", T.IntegerType()), T.StructField("origin", T.StringType())])
    parsed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def parse(text):
        parsed.add(1)
        return text[1:] or None

    raw = spark.createDataFrame([(f"x{'' if i % 5 == 0 else i}", "?" if i % 7 == 0 else str(i)) for i in range(100)], "page string, n string")
    split = records.quarantine_to(model, {"origin": "web"})(raw.withColumn("name", parse("page")), str(tmp_path / "out"))
    good, rejected = values(split.good), values(split.rejected)
    assert parsed.value == 100
    assert (split.good_rows, split.rejected_rows) == (len(good), len(rejected)) and len(good) + len(rejected) == 100
    assert sorted(good) == sorted((str(i), i, "web") for i in range(100) if i % 5 and i % 7)
    assert sorted(rejected, key=str) == sorted(((None if i % 5 == 0 else str(i), "?" if i % 7 == 0 else str(i), "web", "name: missing" if i % 5 == 0 else "n: not a int") for i in range(100) if i % 5 == 0 or i % 7 == 0), key=str)
    plan = split.good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(accepted" in plan and "came" not in plan.split("ReadSchema")[1]
    empty = records.quarantine_to(model, {"origin": "web"})(raw.limit(0).withColumn("name", F.col("page")), None)
    assert (empty.good.count(), empty.rejected.count(), empty.good_rows, empty.rejected_rows) == (0, 0, 0, 0)
