"""Dates and times."""

from pyspark.sql import functions as F

from stepmill import dates
from stepmill.plans.queries.registry import query, table

_HHMM_SQL = "CASE WHEN o_orderkey % 13 = 0 THEN 'abc' ELSE ((o_orderkey * 37) % 2400)::VARCHAR END"


def _hhmm():
    key = F.col("o_orderkey")
    return F.when(key % 13 == 0, "abc").otherwise(((key * 37) % 2400).cast("string"))


@query(
    "parse_dates",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS long_text,
           strftime(o_orderdate, '%Y-%m-%d') AS short_parts,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS compact
    FROM orders
    """,
)
def parse_dates(spark, sf_dir):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    parsed = (
        table(spark, sf_dir, "orders")
        .select(
            "o_orderkey",
            F.when(key % 11 == 0, "2024-02-30")
            .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
            .alias("long_text"),
            F.date_format(day, "d/M/yyyy").alias("short_parts"),
            F.concat(F.when(key % 5 == 0, " ").otherwise(""), F.date_format(day, "yyyyMMdd")).alias("compact"),
        )
        .transform(
            dates.parse_date_columns(
                {"long_text": "%Y-%m-%d", "short_parts": "%d/%m/%Y", "compact": "%Y%m%d"}
            )
        )
    )
    return parsed.select(
        "o_orderkey", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("long_text", "short_parts", "compact")]
    )


@query(
    "parse_timestamps",
    """
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS full_text,
           strftime(date_trunc('minute', ts) - INTERVAL 55 YEAR, '%Y-%m-%d %H:%M:%S') AS short_year,
           NULL::VARCHAR AS sliced
    FROM events
    """,
)
def parse_timestamps(spark, sf_dir):
    # Two-digit years from 69 on lie in the twentieth century.
    early = F.col("ts") - F.expr("INTERVAL '55' YEAR")
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("full_text"),
        F.date_format(early, "dd.MM.yy hh:mm a").alias("short_year"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("sliced"),
    )
    parsed = text.transform(
        dates.parse_date_columns(
            {"full_text": "%Y-%m-%d %H:%M:%S", "short_year": "%d.%m.%y %I:%M %p"}, slice_length=None
        )
    ).transform(dates.parse_date_columns({"sliced": "%Y-%m-%d %H:%M:%S"}))
    return parsed.select(
        "event_id",
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("full_text", "short_year", "sliced")],
    )


@query(
    "parse_zoned",
    """
    WITH t AS (SELECT event_id, date_trunc('second', ts) AS ts, event_id % 4 AS kind FROM events)
    SELECT event_id, CASE WHEN kind < 3 THEN epoch_us(ts - CASE kind WHEN 0 THEN INTERVAL 330 MINUTE WHEN 1 THEN INTERVAL (-480) MINUTE ELSE INTERVAL 0 MINUTE END) END AS micros,
           CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS named_day
    FROM t
    """,
)
def parse_zoned(spark, sf_dir):
    """Offsets of several kinds in one column give comparable instants; weekdays must be weekdays, right or wrong."""
    kind = F.col("event_id") % 4
    zone = F.when(kind == 0, "+05:30").when(kind == 1, "-0800").when(kind == 2, "Z").otherwise("")
    weekday = F.when(F.col("event_id") % 5 == 0, "Xyz").when(F.col("event_id") % 5 == 1, "mon").otherwise(F.date_format("ts", "EEE"))
    text = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss "), zone).alias("zoned"),
        F.concat(weekday, F.lit(", "), F.date_format("ts", "dd.MM.yyyy")).alias("named_day"),
    )
    parsed = text.transform(dates.parse_date_columns({"zoned": "%Y-%m-%d %H:%M:%S %z", "named_day": "%a, %d.%m.%Y"}, slice_length=None))
    return parsed.select("event_id", F.unix_micros("zoned").alias("micros"), F.date_format("named_day", "yyyy-MM-dd").alias("named_day"))


@query(
    "hhmm_seconds",
    f"""
    WITH t AS (SELECT o_orderkey, coalesce(try_cast({_HHMM_SQL} AS INT), 0) AS v FROM orders)
    SELECT o_orderkey, ((v // 100) * 3600 + (v % 100) * 60)::BIGINT AS seconds FROM t
    """,
)
def hhmm_seconds(spark, sf_dir):
    parsed = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", _hhmm().alias("hhmm"))
        .transform(dates.parse_military_time_column("hhmm", "delta"))
    )
    return parsed.select(
        "o_orderkey",
        F.expr("CAST(CAST(delta AS INTERVAL SECOND) AS BIGINT)").alias("seconds"),
    )


@query(
    "combine_dt",
    f"""
    WITH t AS (SELECT o_orderkey, o_orderdate, coalesce(try_cast({_HHMM_SQL} AS INT), 0) AS v FROM orders)
    SELECT o_orderkey, strftime(o_orderdate + to_hours(v // 100) + to_minutes(v % 100), '%Y-%m-%d %H:%M:%S') AS at
    FROM t
    """,
)
def combine_dt(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderdate", _hhmm().alias("hhmm"))
        .transform(dates.parse_military_time_column("hhmm"))
        .transform(dates.combine_date_and_time("o_orderdate", "hhmm", "at", ["o_orderdate", "hhmm"]))
        .withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))
    )


@query("workday", "SELECT event_id, user_id FROM events WHERE isodow(ts) NOT IN (1, 7)")
def workday(spark, sf_dir):
    return table(spark, sf_dir, "events").transform(dates.keep_workdays("ts")).select("event_id", "user_id")
