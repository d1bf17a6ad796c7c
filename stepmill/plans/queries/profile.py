"""Column statistics and categories."""

from pyspark.sql import functions as F

from stepmill import profile, sketch
from stepmill.plans.queries.registry import query, table

_GAPS_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status,
           CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price,
           o_orderpriority, o_orderdate, NULL::VARCHAR AS empty
    FROM orders
"""


def _gaps(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 7 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(key % 6 == 0, float("nan")).when(key % 3 != 0, F.col("o_totalprice")).alias("price"),
        "o_orderpriority",
        "o_orderdate",
        F.lit(None).cast("string").alias("empty"),
    )


def _per_column(names, expression, source):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {expression.format(c=name)} FROM {source}" for name in names
    )


_GAP_COLUMNS = ["o_orderkey", "status", "price", "o_orderpriority", "o_orderdate", "empty"]
_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_COUNTS = "count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values"


@query(
    "null_share",
    f"WITH t AS ({_GAPS_SQL}) "
    + _per_column(_GAP_COLUMNS, "avg(({c} IS NULL)::INT) AS null_share", "t"),
)
def null_share(spark, sf_dir):
    return profile.null_shares(_gaps(spark, sf_dir))


@query("col_counts", f"WITH t AS ({_GAPS_SQL}) " + _per_column(_GAP_COLUMNS, _COUNTS, "t"))
def col_counts(spark, sf_dir):
    return profile.column_counts(_gaps(spark, sf_dir))


@query("col_counts_lineitem", _per_column(_LINE_COLUMNS, _COUNTS, "lineitem"))
def col_counts_lineitem(spark, sf_dir):
    return profile.column_counts(table(spark, sf_dir, "lineitem"))


@query(
    "col_counts_documents",
    _per_column(["text", "lang", "source"], _COUNTS, "documents"),
)
def col_counts_documents(spark, sf_dir):
    return profile.column_counts(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


@query(
    "categorical_decision",
    f"""
    WITH t AS ({_GAPS_SQL}), counts AS ({_per_column(["status", "o_orderpriority", "empty"], _COUNTS, "t")})
    SELECT *, CASE WHEN non_null > 0 THEN distinct_values::DOUBLE / non_null END AS ratio,
           non_null > 0 AND distinct_values::DOUBLE / non_null <= 0.05
               AND column_name <> 'o_orderpriority' AS is_categorical
    FROM counts
    """,
)
def categorical_decision(spark, sf_dir):
    return profile.categorical_decision(_gaps(spark, sf_dir), ["o_orderpriority"], 0.05)


@query(
    "categorical_marks",
    f"""
    WITH {", ".join(f"c{i} AS (SELECT count({c}) n, count(DISTINCT {c}) d FROM documents)" for i, c in enumerate(["text", "lang", "source"]))}
    SELECT doc_id, n_chars,
           (SELECT d::DOUBLE / n <= 0.05 FROM c0)::INT + (SELECT d::DOUBLE / n <= 0.05 FROM c1)::INT
           + (SELECT d::DOUBLE / n <= 0.05 FROM c2)::INT AS categorical_columns
    FROM documents
    """,
)
def categorical_marks(spark, sf_dir):
    marked = table(spark, sf_dir, "documents").transform(profile.cast_categorical())
    count = len(profile.categorical_columns(marked))
    return marked.select("doc_id", "n_chars", F.lit(count).alias("categorical_columns"))


@query(
    "category_codes",
    f"""
    WITH t AS ({_GAPS_SQL})
    SELECT o_orderkey, coalesce(
               CASE WHEN status IS NOT NULL
                    THEN dense_rank() OVER (ORDER BY status NULLS LAST) - 1 END, -1)::BIGINT AS code
    FROM t
    """,
)
def category_codes(spark, sf_dir):
    return _gaps(spark, sf_dir).transform(profile.category_codes("status", "code")).select("o_orderkey", "code")


_SKEWED_SQL = """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'most' WHEN event_id % 7 = 1 THEN NULL
                     ELSE user_id || '/' || (event_id % 50) END AS label
    FROM events
"""


@query(
    "category_codes_large",
    f"""
    WITH t AS ({_SKEWED_SQL})
    SELECT event_id, coalesce(
               CASE WHEN label IS NOT NULL
                    THEN dense_rank() OVER (ORDER BY label NULLS LAST) - 1 END, -1)::BIGINT AS code
    FROM t
    """,
)
def category_codes_large(spark, sf_dir):
    """The way of a dictionary that is too large to broadcast, with a third of the rows in one value."""
    key = F.col("event_id")
    label = (
        F.when(key % 3 == 0, F.lit("most"))
        .when(key % 7 == 1, F.lit(None))
        .otherwise(F.concat_ws("/", F.col("user_id").cast("string"), (key % 50).cast("string")))
    )
    return (
        table(spark, sf_dir, "events")
        .select("event_id", label.alias("label"))
        .transform(profile.category_codes("label", "code", max_broadcast_rows=0))
        .select("event_id", "code")
    )


@query(
    "profile_merged",
    """
    SELECT column_name, rows, non_null, TRUE AS as_the_whole, TRUE AS near FROM (
        SELECT count(*) AS rows, count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey,
               count(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END) AS status, count(o_totalprice) AS o_totalprice
        FROM orders) UNPIVOT (non_null FOR column_name IN (o_orderkey, o_custkey, status, o_totalprice))
    """,
)
def profile_merged(spark, sf_dir):
    """Profiles of three parts, merged: the profile of the whole, register by register, with estimates within six percent."""
    status = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("status")
    whole = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", status, "o_totalprice")
    parts = [whole.filter(F.col("o_orderkey") % 3 == i) for i in range(3)]
    merged = sketch.merge_profiles([sketch.column_profile(p) for p in parts])
    direct = sketch.column_profile(whole).select("column_name", F.col("registers").alias("direct"))
    counts = profile.column_counts(whole).select("column_name", "distinct_values")
    estimates = sketch.profile_counts(merged).select("column_name", "distinct_estimate")
    joined = merged.join(direct, "column_name").join(counts, "column_name").join(estimates, "column_name")
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= 0.06 * F.col("distinct_values")
    return joined.select("column_name", "rows", "non_null", (F.col("registers") == F.col("direct")).alias("as_the_whole"), near.alias("near"))
