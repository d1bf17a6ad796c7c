import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill import dates
from stepmill.functions import temporal
from tests.conftest import values

CASES = [
    ("2024-1-5", "%Y-%m-%d"),
    ("2024-02-30", "%Y-%m-%d"),
    (" 2024-01-05", "%Y-%m-%d"),
    ("99-01-05", "%Y-%m-%d"),
    ("12024-01-05", "%Y-%m-%d"),
    ("2024-01-05x", "%Y-%m-%d"),
    ("2024-03-10 02:30:00", "%Y-%m-%d %H:%M:%S"),
    ("1924-03-10 02:30:00", "%Y-%m-%d %H:%M:%S"),
    ("20240105", "%Y%m%d"),
    ("01/02/68", "%m/%d/%y"),
    ("01/02/69 13:05", "%m/%d/%y %H:%M"),
    ("5 Jan 2024 01:05 pm", "%d %b %Y %I:%M %p"),
    ("January 5, 2024", "%B %d, %Y"),
    ("2024-01-05T10:00", "%Y-%m-%dT%H:%M"),
    ("2024-01-05 10:00:00.123456", "%Y-%m-%d %H:%M:%S.%f"),
    ("12:30", "%H:%M"),
    ("12:30", "%I:%M"),
    ("2024-060", "%Y-%j"),
    ("2024", "%Y"),
    ("100% 2024", "100%% %Y"),
]


@pytest.mark.parametrize("kind", ["TIMESTAMP_NTZ", "TIMESTAMP_LTZ"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_formats(spark, frame, kind, zone):
    before = {k: spark.conf.get(k) for k in ("spark.sql.timestampType", "spark.sql.session.timeZone")}
    spark.conf.set("spark.sql.timestampType", kind)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = frame("x int", [(1,)]).select(
            *[F.lit(text).alias(f"c{i}") for i, (text, _) in enumerate(CASES)]
        )
        step = dates.parse_date_columns({f"c{i}": f for i, (_, f) in enumerate(CASES)}, slice_length=None)
        out = step(df)
        assert {f.dataType for f in out.schema} == {T.TimestampNTZType()}
        got = out.select(*[F.col(c).cast("string") for c in out.columns]).first()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    for (text, fmt), value in zip(CASES, got):
        expected = pd.to_datetime(pd.Series([text]), format=fmt, errors="coerce")[0]
        assert value == (None if expected is pd.NaT else str(expected)), (text, fmt)


ZONED = [
    ("2024-03-10 02:30:00+0530", "%Y-%m-%d %H:%M:%S%z"),
    ("2024-03-10 02:30:00.25-08:00", "%Y-%m-%d %H:%M:%S.%f%z"),
    ("1824-03-10 02:30:00 +01:02:03", "%Y-%m-%d %H:%M:%S %z"),
    ("2024-11-03 01:30 Z", "%Y-%m-%d %H:%M %z"),
    ("2024-11-03 01:30 z", "%Y-%m-%d %H:%M %z"),
    ("2024-11-03 01:30", "%Y-%m-%d %H:%M%z"),
    ("2024-11-03 01:30 +05", "%Y-%m-%d %H:%M %z"),
    ("2024-11-03 01:30 +0577", "%Y-%m-%d %H:%M %z"),
    ("2024-11-33 01:30 +0500", "%Y-%m-%d %H:%M %z"),
    ("+0200 2024", "%z %Y"),
    ("2024-07-01 12:00 America/New_York", "%Y-%m-%d %H:%M %Z"),
    ("2024-01-01 12:00 UTC", "%Y-%m-%d %H:%M %Z"),
    ("2024-01-01 12:00 Mars/Base", "%Y-%m-%d %H:%M %Z"),
    ("Fri, 05 Jan 2024 10:00:00 -0330", "%a, %d %b %Y %H:%M:%S %z"),
    ("MON 2024-01-05", "%a %Y-%m-%d"),
    ("Sunday 2024-01-05", "%A %Y-%m-%d"),
    ("Sun 2024-01-05", "%A %Y-%m-%d"),
    ("Someday 2024-01-05", "%A %Y-%m-%d"),
    ("100% Fri 2024", "100%% %a %Y"),
]


@pytest.mark.parametrize("kind, zone", [("TIMESTAMP_NTZ", "UTC"), ("TIMESTAMP_LTZ", "America/New_York")])
def test_zones_and_weekdays(spark, frame, kind, zone):
    before = {k: spark.conf.get(k) for k in ("spark.sql.timestampType", "spark.sql.session.timeZone")}
    spark.conf.set("spark.sql.timestampType", kind)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = frame("x int", [(1,)]).select(*[F.lit(text).alias(f"c{i}") for i, (text, _) in enumerate(ZONED)])
        out = dates.parse_date_columns({f"c{i}": f for i, (_, f) in enumerate(ZONED)}, slice_length=None)(df)
        instants = [isinstance(f.dataType, T.TimestampType) for f in out.schema]
        assert instants == ["%z" in f.lower() for _, f in ZONED]
        got = out.select(*[F.unix_micros(c).cast("string") if at else F.col(c).cast("string") for c, at in zip(out.columns, instants, strict=True)]).first()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    for (text, fmt), value, instant in zip(ZONED, got, instants, strict=True):
        expected = pd.to_datetime(pd.Series([text]), format=fmt, errors="coerce", utc=instant)[0]
        assert value == (None if expected is pd.NaT else str(expected.value // 1000) if instant else str(expected)), (text, fmt)


def test_slice(frame):
    df = frame("a string, b string", [("2024-01-05 10:11:12", "2024-01-05 10:11:12"), ("2024-01-05x", None)])
    out = dates.parse_date_columns({"a": "%Y-%m-%d", "b": "%Y-%m-%d %H:%M:%S"})(df)
    assert values(out) == [(dt.datetime(2024, 1, 5), None), (dt.datetime(2024, 1, 5), None)]


def test_unsupported_format_and_types(frame):
    with pytest.raises(ValueError, match="%W"):
        dates.parse_date_columns({"a": "%Y %W"})(frame("a string", []))
    with pytest.raises(ValueError, match="two zones"):
        dates.parse_date_columns({"a": "%Y %z %Z"})(frame("a string", []))
    with pytest.raises(TypeError):
        dates.parse_date_columns({"a": "%Y"})(frame("a bigint", []))
    with pytest.raises(ValueError, match="zz"):
        dates.parse_date_columns({"zz": "%Y"})(frame("a string", []))


def test_military_time(frame):
    cases = {
        "845": (8, 45), " 930 ": (9, 30), "12.7": (0, 12), "1": (0, 1), "1330": (13, 30), "-30": (0, 10),
        "2575": (25, 75), "70000": (0, 0), "abc": (0, 0), "": (0, 0), "12d": (0, 0), "1e2": (1, 0),
    }
    df = frame("t string", [(k,) for k in cases] + [(None,)])
    out = dates.parse_military_time_column("t", "d")(df)
    assert isinstance(out.schema["d"].dataType, T.DayTimeIntervalType)
    assert values(out, "d") == [dt.timedelta(hours=h, minutes=m) for h, m in cases.values()] + [dt.timedelta(0)]
    over = dates.parse_military_time_column("t")(frame("t int", [(845,)]))
    assert values(over) == [(dt.timedelta(hours=8, minutes=45),)]


def test_combine(spark, frame):
    df = spark.sql("select timestamp_ntz'2024-03-10' d, date'2024-03-10' e, interval '02:30' hour to minute t, 1 k")
    out = dates.combine_date_and_time("d", "t", "at", ["d"])(df)
    assert out.columns == ["e", "t", "k", "at"]
    assert values(out, "at") == [dt.datetime(2024, 3, 10, 2, 30)]
    from_date = dates.combine_date_and_time("e", "t", "at")(df)
    assert isinstance(from_date.schema["at"].dataType, T.TimestampNTZType)
    for bad in (("k", "t", "at"), ("d", "k", "at")):
        with pytest.raises(TypeError):
            dates.combine_date_and_time(*bad)(df)
    with pytest.raises(ValueError, match="zz"):
        dates.combine_date_and_time("d", "t", "at", ["zz"])(df)


def test_workday(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(7)]  # Monday first
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert values(dates.keep_workdays("d")(df), "d") == days[1:6]
    assert [temporal.is_workday_date(d) for d in days] == [False, True, True, True, True, True, False]
    assert spark.range(1).select(temporal.is_workday().alias("w")).first().w == temporal.is_workday_date()
