"""The flagship pipeline, and column plumbing."""

from pyspark.sql import functions as F

from stepmill import columns, dates, nulls, profile, strings, transform_data
from stepmill.plans.queries.registry import query, table


@query(
    "flagship",
    """
    WITH dirty AS (
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 7 = 0 THEN 'UNKNOWN' ELSE o_orderstatus END AS status,
               CASE WHEN o_orderkey % 11 = 0 THEN '2024-02-30'
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS created,
               '  ' || lower(o_orderpriority) || ' ' AS priority,
               o_totalprice
        FROM orders),
    clean AS (
        SELECT o_orderkey,
               CASE WHEN status <> 'UNKNOWN'
                    THEN upper(substr(trim(status), 1, 1)) || lower(substr(trim(status), 2)) END AS status,
               strftime(try_strptime(created, '%Y-%m-%d'), '%Y-%m-%d') AS created_date,
               array_to_string(list_transform(
                   regexp_extract_all(lower(trim(priority)), '(\\p{L}+|[^\\p{L}]+)'),
                   lambda w: upper(w[1]) || w[2:]), '') AS priority,
               o_totalprice
        FROM dirty)
    SELECT *,
           (SELECT count(DISTINCT status)::DOUBLE / count(status) <= 0.05 FROM clean) AS status_is_category,
           (SELECT count(DISTINCT priority)::DOUBLE / count(priority) <= 0.05 FROM clean) AS priority_is_category
    FROM clean
    """,
)
def flagship(spark, sf_dir):
    key = F.col("o_orderkey")
    dirty = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 7 == 0, "UNKNOWN").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(key % 11 == 0, "2024-02-30")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("created_date"),
        F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" ")).alias("priority"),
        "o_totalprice",
    )
    clean = transform_data(
        [
            nulls.nullify_value({"status": "UNKNOWN", "created_date": ""}),
            dates.parse_date_columns({"created_date": "%Y-%m-%d"}),
            strings.normalize_trim_case({"title": ["priority"], "capitalize": ["status"]}),
            columns.upgrade_dtype(),
            profile.cast_categorical(pct_threshold=0.05),
        ],
        dirty,
    )
    marked = profile.categorical_columns(clean)
    return clean.withColumns({
        "created_date": F.date_format("created_date", "yyyy-MM-dd"),
        "status_is_category": F.lit("status" in marked),
        "priority_is_category": F.lit("priority" in marked),
    })


@query("drop_cols", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def drop_cols(spark, sf_dir):
    return table(spark, sf_dir, "orders").transform(
        columns.drop_columns(["o_custkey", "o_totalprice", "o_orderdate", "no_such_column"])
    )


@query(
    "rename_swap",
    """SELECT o_orderkey AS o_custkey, o_custkey AS o_orderkey, o_orderstatus AS status FROM orders""",
)
def rename_swap(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus")
        .transform(
            columns.rename_columns({
                "o_orderkey": "o_custkey",
                "o_custkey": "o_orderkey",
                "o_orderstatus": "status",
                "no_such_column": "x",
            })
        )
    )


@query(
    "rename_replace",
    """SELECT c_custkey AS "cust-key", c_name AS "cust-name", c_mktsegment AS "cust-mktsegment" FROM customer""",
)
def rename_replace(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", "c_mktsegment")
        .transform(
            columns.rename_columns_by_replace({"c_": "cust_", "cust_cust": "cust_", "_": "-", "--": "-"})
        )
    )


@query(
    "cast_cols",
    """
    SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::DOUBLE AS o_custkey,
           floor(o_totalprice)::BIGINT AS o_totalprice,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END::VARCHAR AS digits
    FROM orders
    """,
)
def cast_cols(spark, sf_dir):
    digits = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string"))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", F.floor("o_totalprice").cast("double").alias("o_totalprice"), digits.alias("digits"))
        .transform(
            columns.cast_columns({
                "o_orderkey": "str",
                "o_custkey": "float64",
                "o_totalprice": "Int64",
                "digits": "int64",
            })
        )
        .withColumn("digits", F.col("digits").cast("string"))
    )


@query(
    "cast_whole",
    """
    SELECT o_orderkey, 9007199254740993 + o_orderkey AS exact, (o_orderkey % 256)::SMALLINT AS byte
    FROM orders
    """,
)
def cast_whole(spark, sf_dir):
    """Whole decimals keep every digit as integers; unsigned bytes have their range."""
    exact = F.col("o_orderkey").cast("decimal(20,0)") + F.lit(9007199254740993)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", exact.cast("decimal(22,2)").alias("exact"), (F.col("o_orderkey") % 256).alias("byte"))
    return rows.transform(columns.cast_columns({"exact": "Int64", "byte": "UInt8"}))


@query(
    "upgrade_nan",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS c_acctbal,
           c_name, c_nationkey,
           '["' || c_name || '","' || c_mktsegment || '"]' AS labels
    FROM customer
    """,
)
def upgrade_nan(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .select(
            "c_custkey",
            F.when(F.col("c_custkey") % 4 == 0, float("nan")).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
            "c_name",
            "c_nationkey",
            F.array("c_name", "c_mktsegment").alias("labels"),
        )
        .transform(columns.upgrade_dtype())
    )
