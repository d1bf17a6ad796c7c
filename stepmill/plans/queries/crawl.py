"""Rules on page and listing tables."""

from pyspark.sql import functions as F

from stepmill import crawl
from stepmill.plans.queries.registry import query, table

_SKIP = {"en": [2, 5], "de": [0], "no such category": [1]}


@query("sentinel", "SELECT page_id, url FROM pages WHERE contains(html, '</body>')")
def sentinel(spark, sf_dir):
    return table(spark, sf_dir, "pages").transform(crawl.keep_loaded_pages("</body>")).select("page_id", "url")


@query("sentinel_rejected", "SELECT page_id, url FROM pages WHERE NOT contains(html, '</body>')")
def sentinel_rejected(spark, sf_dir):
    return crawl.split_loaded_pages("</body>")(table(spark, sf_dir, "pages"))[1].select("page_id", "url")


@query(
    "skip_map",
    """
    SELECT doc_id, lang, (doc_id % 8)::INT AS position FROM documents
    WHERE NOT (lang = 'en' AND doc_id % 8 IN (2, 5)) AND NOT (lang = 'de' AND doc_id % 8 = 0)
    """,
)
def skip_map(spark, sf_dir):
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "lang", (F.col("doc_id") % 8).cast("int").alias("position"))
        .transform(crawl.skip_positions(_SKIP, "lang", "position"))
    )


@query("target_filter", "SELECT event_id, event_type, value FROM events WHERE event_type = 'purchase'")
def target_filter(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .select("event_id", "event_type", "value")
        .transform(crawl.target_category("purchase", "event_type"))
    )


_LABELS_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN [o_orderpriority, 'Next']
                            WHEN o_orderkey % 5 = 1 THEN []
                            ELSE ['1', '2', ' ' || (o_custkey + 3) || ' ', 'Next', o_orderstatus] END AS labels
    FROM orders
"""


def _labels(spark, sf_dir):
    key = F.col("o_orderkey")
    number = F.concat(F.lit(" "), (F.col("o_custkey") + 3).cast("string"), F.lit(" "))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 5 == 0, F.array("o_orderpriority", F.lit("Next")))
        .when(key % 5 == 1, F.array().cast("array<string>"))
        .otherwise(F.array(F.lit("1"), F.lit("2"), number, F.lit("Next"), F.col("o_orderstatus")))
        .alias("labels"),
    )


@query(
    "page_count",
    f"""
    WITH t AS ({_LABELS_SQL})
    SELECT o_orderkey, coalesce(trim(list_filter(labels, lambda x: regexp_full_match(trim(x), '[0-9]+'))[-1])::INT, 1) AS pages
    FROM t
    """,
)
def page_count(spark, sf_dir):
    return _labels(spark, sf_dir).select("o_orderkey", crawl.page_count(F.col("labels")).alias("pages"))


@query(
    "drop_tail",
    f"""
    WITH t AS ({_LABELS_SQL})
    SELECT o_orderkey, array_to_string(labels[:greatest(len(labels) - 2, 0)], '|') AS kept,
           greatest(len(labels) - 2, 0) AS kept_count
    FROM t
    """,
)
def drop_tail(spark, sf_dir):
    kept = _labels(spark, sf_dir).select("o_orderkey", crawl.drop_tail(F.col("labels")).alias("kept"))
    return kept.select(
        "o_orderkey",
        F.array_join("kept", "|").alias("kept"),
        F.size("kept").cast("bigint").alias("kept_count"),
    )
