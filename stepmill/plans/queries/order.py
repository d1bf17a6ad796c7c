"""Row order: numbering, pages, caps, unions of pages."""

from pyspark.sql import functions as F

from stepmill import columns, order, union_pages
from stepmill.plans.queries.registry import query, table


@query(
    "row_index",
    """
    SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS index, o_orderkey, o_custkey, o_totalprice
    FROM orders
    """,
)
def row_index(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_totalprice")
        .transform(columns.reset_index(drop=False, order_by=["o_orderkey"]))
    )


@query(
    "row_index_skewed",
    """
    SELECT row_number() OVER (ORDER BY event_type, user_id, event_id) - 1 AS position, event_id, event_type
    FROM (SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN 'view' ELSE event_type END AS event_type
          FROM events)
    """,
)
def row_index_skewed(spark, sf_dir):
    """A leading key that most rows share."""
    kind = F.when(F.col("event_id") % 2 == 0, "view").otherwise(F.col("event_type"))
    return (
        table(spark, sf_dir, "events")
        .select("event_id", "user_id", kind.alias("event_type"))
        .transform(order.with_row_index(["event_type", "user_id", "event_id"], "position"))
        .select("position", "event_id", "event_type")
    )


@query("reset_index_drop", "SELECT p_partkey, p_name FROM part")
def reset_index_drop(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name").transform(columns.reset_index())


@query(
    "page_plan",
    """
    SELECT o // 1000 AS page, o AS offset, 1000::BIGINT AS "limit", o // 1000 // 4 AS batch
    FROM (SELECT unnest(range(0, (SELECT count(*) FROM events), 1000)) AS o)
    """,
)
def page_plan(spark, sf_dir):
    """The pages of a pull of the whole table."""
    return order.page_plan(spark, 0, table(spark, sf_dir, "events").count(), 1000, 4)


_SLICE_SQL = """
    WITH t AS (SELECT event_id, event_type, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events)
    SELECT *, (row_index - {offset}) // 300 AS page FROM t
    WHERE row_index >= {offset} AND row_index < {offset} + 300 * CAST(ceil({seed} / 300.0) AS BIGINT)
"""


@query("paged_slice", _SLICE_SQL.format(offset=1234, seed=2000))
def paged_slice(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .transform(order.paged_slice(["ts", "event_id"], offset=1234, seed_limit=2000, chunk_limit=300))
        .select("event_id", "event_type", "row_index", "page")
    )


@query("paged_slice_long", _SLICE_SQL.format(offset=500, seed=1_000_000))
def paged_slice_long(spark, sf_dir):
    """A slice too long for a top-k: the table is numbered as a whole."""
    return (
        table(spark, sf_dir, "events")
        .transform(order.paged_slice(["ts", "event_id"], offset=500, seed_limit=1_000_000, chunk_limit=300))
        .select("event_id", "event_type", "row_index", "page")
    )


@query("record_cap", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 500")
def record_cap(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice")
        .transform(order.record_cap(500, ["o_totalprice", "o_orderkey"]))
    )


@query(
    "record_cap_large",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 120000",
)
def record_cap_large(spark, sf_dir):
    """A cap too large for a top-k."""
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice")
        .transform(order.record_cap(120_000, ["o_totalprice", "o_orderkey"]))
    )


@query(
    "union_by_name",
    """
    SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS code, NULL::VARCHAR AS segment FROM orders
    UNION ALL BY NAME
    SELECT c_custkey AS id, c_nationkey::DOUBLE AS amount, c_nationkey::VARCHAR AS code, c_mktsegment AS segment
    FROM customer
    """,
)
def union_by_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_totalprice AS amount", "o_orderstatus AS code"
    )
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_mktsegment AS segment", "c_nationkey AS code", "c_nationkey AS amount", "c_custkey AS id"
    )
    return union_pages([orders, customers])
