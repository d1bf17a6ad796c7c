"""Null handling."""

import datetime as dt

from pyspark.sql import functions as F

from stepmill import columns, nulls, strings
from stepmill.plans.queries.registry import query, table


@query(
    "nullify_value",
    """
    SELECT o_orderkey, nullif(CASE WHEN o_orderkey % 7 = 0 THEN 'UNKNOWN' ELSE o_orderstatus END, 'UNKNOWN') AS status,
           CASE WHEN o_orderpriority NOT IN ('1-URGENT', '5-LOW') THEN o_orderpriority END AS o_orderpriority,
           nullif(o_custkey, 7)::VARCHAR AS o_custkey,
           nullif(o_orderdate::DATE, DATE '1995-01-01') AS day, nullif(o_orderdate::TIMESTAMP, TIMESTAMP '1996-01-02 00:00:00') AS moment
    FROM orders
    """,
)
def nullify_value(spark, sf_dir):
    status = F.when(F.col("o_orderkey") % 7 == 0, "UNKNOWN").otherwise(F.col("o_orderstatus"))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", status.alias("status"), "o_orderpriority", "o_custkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderdate").cast("timestamp_ntz").alias("moment"))
        .transform(
            nulls.nullify_value({
                "status": "UNKNOWN",
                "o_orderpriority": ["1-URGENT", "5-LOW"],
                "o_orderkey": "UNKNOWN",
                "o_custkey": 7,
                "day": dt.date(1995, 1, 1),
                "moment": dt.datetime(1996, 1, 2),
            })
        )
        .withColumn("o_custkey", F.col("o_custkey").cast("string"))
    )


@query(
    "nullify_range",
    """
    SELECT c_custkey,
           CASE WHEN c_acctbal > 0 AND c_acctbal <= 5000 THEN c_acctbal END AS c_acctbal,
           CASE WHEN c_nationkey > 3 AND c_nationkey <= 20 THEN c_nationkey END::VARCHAR AS c_nationkey
    FROM customer
    """,
)
def nullify_range(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_acctbal", "c_nationkey")
        .transform(nulls.nullify_range({"c_acctbal": (0, 5000), "c_nationkey": (3, 20)}))
        .withColumn("c_nationkey", F.col("c_nationkey").cast("string"))
    )


@query(
    "null_fill",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'missing' ELSE o_orderstatus END AS status,
           CASE WHEN o_orderkey % 5 = 0 THEN -1.0 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def null_fill(spark, sf_dir):
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .select(
            "o_orderkey",
            F.when(key % 7 != 0, F.col("o_orderstatus")).alias("status"),
            F.when(key % 10 == 0, float("nan")).when(key % 5 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        )
        .transform(columns.null_fill({"status": "missing", "o_totalprice": -1.0, "no_such_column": 0}))
    )


@query(
    "replace_values",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'F' WHEN 'F' THEN 'O' WHEN 'P' THEN NULL
                       ELSE o_orderstatus END AS o_orderstatus
    FROM orders
    """,
)
def replace_values(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderstatus")
        .transform(strings.replace_values("o_orderstatus", {"O": "F", "F": "O", "P": None}))
    )


@query(
    "dropna_threshold",
    """
    WITH dirty AS (
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_orderkey % 40 <> 0 THEN l_quantity END AS few_gaps,
               CASE WHEN l_orderkey % 50 <> 1 THEN l_returnflag END AS few_gaps_text,
               CASE WHEN l_orderkey % 3 <> 0 THEN l_shipdate END AS many_gaps
        FROM lineitem),
    share AS (
        SELECT avg((few_gaps IS NULL)::INT) AS a, avg((few_gaps_text IS NULL)::INT) AS b,
               avg((many_gaps IS NULL)::INT) AS c FROM dirty)
    SELECT l_orderkey, l_linenumber, few_gaps, few_gaps_text,
           strftime(many_gaps, '%Y-%m-%d') AS many_gaps
    FROM dirty, share
    WHERE (few_gaps IS NOT NULL OR a > 0.05) AND (few_gaps_text IS NOT NULL OR b > 0.05)
      AND (many_gaps IS NOT NULL OR c > 0.05)
    """,
)
def dropna_threshold(spark, sf_dir):
    key = F.col("l_orderkey")
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_orderkey",
            "l_linenumber",
            F.when(key % 40 == 0, float("nan")).otherwise(F.col("l_quantity")).alias("few_gaps"),
            F.when(key % 50 != 1, F.col("l_returnflag")).alias("few_gaps_text"),
            F.when(key % 3 != 0, F.col("l_shipdate")).alias("many_gaps"),
        )
        .transform(nulls.dropna_by_threshold(0.05))
        .withColumn("many_gaps", F.date_format("many_gaps", "yyyy-MM-dd"))
    )
