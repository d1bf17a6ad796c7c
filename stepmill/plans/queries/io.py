"""Sources and sinks: tables are written by Spark to the shared folder and read back."""

from pyspark.sql import functions as F

from stepmill import (
    append_csv,
    append_csv_stream,
    dates,
    extract_csv,
    extract_paged_csv,
    extract_paged_csv_lite,
    nulls,
    order,
    stage_export,
    strings,
    transform_data,
)
from stepmill.plans.fitted import fit_steps
from stepmill.plans.queries.registry import query, table
from stepmill.session import scratch_path
from stepmill.sources.paged import export_pages
from stepmill.streaming.run import run_batches, write_parquet_stream

_CELLS_SQL = """
    SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN c_nationkey END::VARCHAR AS c_nationkey,
           c_acctbal, c_custkey % 2 = 0 AS even,
           CASE WHEN c_custkey % 5 <> 0 THEN 'a "quoted", cell' || {line_break} || c_name END AS label,
           '1998-0' || (1 + c_custkey % 9) || '-01' AS day
    FROM customer
"""


def _cells(spark, sf_dir, line_break):
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(key % 6 != 0, F.col("c_nationkey").cast("string")).otherwise("N/A").alias("c_nationkey"),
        "c_acctbal",
        (key % 2 == 0).alias("even"),
        F.when(key % 5 != 0, F.concat(F.lit('a "quoted", cell' + line_break), F.col("c_name"))).alias("label"),
        F.concat(F.lit("1998-0"), (1 + key % 9).cast("string"), F.lit("-01")).alias("day"),
    )


def _roundtrip(spark, sf_dir, line_break):
    path = scratch_path(spark, "csv")
    append_csv(_cells(spark, sf_dir, line_break), path)
    # The column comes back as a number with gaps.
    return extract_csv(spark, path).withColumn("c_nationkey", F.col("c_nationkey").cast("string"))


@query("csv_roundtrip", _CELLS_SQL.format(line_break="' '"))
def csv_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, " ")


@query("csv_line_breaks", _CELLS_SQL.format(line_break="chr(10)"))
def csv_line_breaks(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "\n")


@query(
    "csv_given_schema",
    "SELECT c_custkey, c_name, c_acctbal FROM customer",
)
def csv_given_schema(spark, sf_dir):
    path = scratch_path(spark, "csv")
    append_csv(table(spark, sf_dir, "customer"), path, ["c_custkey", "c_name", "c_acctbal"])
    return extract_csv(
        spark, path, schema="c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE", multi_line=False
    )


def _two_headers(spark, sf_dir):
    """Customers as two sets of files, with other columns in another order."""
    customer, path = table(spark, sf_dir, "customer"), scratch_path(spark, "headers")
    append_csv(customer.filter("c_custkey % 3 <> 0"), f"{path}/a", ["c_custkey", "c_name", "c_acctbal"])
    append_csv(customer.filter("c_custkey % 3 = 0"), f"{path}/b", ["c_acctbal", "c_mktsegment", "c_custkey"])
    return f"{path}/*"


@query(
    "csv_header_order",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS c_name, c_acctbal,
           CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS c_mktsegment
    FROM customer
    """,
)
def csv_header_order(spark, sf_dir):
    """Columns go by the names in each file's header."""
    return extract_csv(spark, _two_headers(spark, sf_dir))


@query(
    "csv_schema_by_name",
    """
    SELECT CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS c_mktsegment, c_custkey,
           CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal
    FROM customer
    """,
)
def csv_schema_by_name(spark, sf_dir):
    """A given schema is looked up by name, whatever the order of the files' columns."""
    return extract_csv(spark, _two_headers(spark, sf_dir), schema="c_mktsegment STRING, c_custkey BIGINT, c_acctbal DECIMAL(12,2)")


@query(
    "sink_batches",
    "SELECT p_partkey, p_name, (SELECT count(*) FROM part WHERE p_size <= 25) AS noted FROM part",
)
def sink_batches(spark, sf_dir):
    """Appends by batch number: one made twice adds its rows once."""
    part, path = table(spark, sf_dir, "part"), scratch_path(spark, "append")
    append_csv(part.filter("p_size <= 25"), path, ["p_partkey", "p_name"], batch=1)
    append_csv(part.filter("p_size > 25"), path, ["p_partkey", "p_name"], batch=2)
    noted = append_csv(part.filter("p_size <= 25"), path, ["p_partkey", "p_name"], batch=1)
    return extract_csv(spark, path).withColumn("noted", F.lit(noted).cast("bigint"))


def _exported(spark, sf_dir, rows_per_page):
    """The orders table as a folder of page files; the status column is a number on some pages."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    root = scratch_path(spark, "pages") + ".csv"
    total = orders.count()
    paged = orders.transform(
        order.paged_slice(["o_orderkey"], seed_limit=total, chunk_limit=rows_per_page)
    ).select(
        (F.col("page") * rows_per_page).alias("offset"),
        (F.col("row_index") % rows_per_page).alias("row_pos"),
        "o_orderkey",
        F.when(F.col("page") % 2 == 0, F.col("o_totalprice").cast("bigint").cast("string"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("price"),
        F.when(F.col("page") % 3 == 0, "7").otherwise(F.col("o_orderstatus")).alias("status"),
    )
    export_pages(paged, root)
    return root, total


_PAGED_SQL = """
    WITH t AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
    SELECT (i // 1000)::INT AS page, (i % 1000)::INT AS row_pos, o_orderkey,
           CASE WHEN i // 1000 % 2 = 0 THEN trunc(o_totalprice) ELSE o_totalprice END AS price,
           CASE WHEN i // 1000 % 3 = 0 THEN '7' ELSE o_orderstatus END AS status
    FROM t
"""


@query("paged_source", _PAGED_SQL)
def paged_source(spark, sf_dir):
    root, total = _exported(spark, sf_dir, 1000)
    return extract_paged_csv(
        spark, data_source_url=root, seed_limit=total, chunk_limit=1000, keep_position=True
    )


@query(
    "paged_source_lite",
    """
    SELECT o_orderkey, trunc(o_totalprice)::BIGINT AS price, 7::BIGINT AS status
    FROM orders ORDER BY o_orderkey LIMIT 500
    """,
)
def paged_source_lite(spark, sf_dir):
    root, _ = _exported(spark, sf_dir, 500)
    return extract_paged_csv_lite(spark, data_source_url=root, limit=500)


@query(
    "sink_append",
    """
    SELECT p_partkey, p_name, nullif(p_brand, 'Brand#1') AS p_brand,
           (SELECT count(*) FROM part) AS first_write, (SELECT count(*) FROM part WHERE p_size > 25) AS second_write
    FROM part
    UNION ALL
    SELECT p_partkey, p_name, nullif(p_brand, 'Brand#1') AS p_brand,
           (SELECT count(*) FROM part), (SELECT count(*) FROM part WHERE p_size > 25)
    FROM part WHERE p_size > 25
    """,
)
def sink_append(spark, sf_dir):
    part = table(spark, sf_dir, "part").transform(nulls.nullify_value({"p_brand": "Brand#1"}))
    path, columns = scratch_path(spark, "append"), ["p_partkey", "p_name", "p_brand"]
    first = append_csv(part, path, columns)
    second = append_csv(part.filter("p_size > 25"), path, columns)
    append_csv(part.filter("p_size < 0"), path, columns)
    return extract_csv(spark, path).withColumns({
        "first_write": F.lit(first).cast("bigint"),
        "second_write": F.lit(second).cast("bigint"),
    })


@query("stage_export", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def stage(spark, sf_dir):
    path = scratch_path(spark, "stage")
    stage_export(table(spark, sf_dir, "customer"), path, ["c_custkey", "c_name", "c_mktsegment"])
    return extract_csv(spark, path)


def _order_steps():
    return [
        nulls.nullify_value({"o_orderstatus": "P"}),
        nulls.nullify_range({"o_totalprice": (1000, 300_000)}),
        strings.normalize_trim_case({"title": ["o_orderpriority"]}),
        dates.keep_workdays("o_orderdate"),
    ]


def _orders_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "orders").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/orders.parquet*")


_CLEAN_SQL = """
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
           CASE WHEN o_totalprice > 1000 AND o_totalprice <= 300000 THEN o_totalprice END AS o_totalprice,
           array_to_string(list_transform(
               regexp_extract_all(lower(o_orderpriority), '(\\p{L}+|[^\\p{L}]+)'),
               lambda w: upper(w[1]) || w[2:]), '') AS o_orderpriority
    FROM orders WHERE isodow(o_orderdate) NOT IN (1, 7)
"""


@query("stream_clean", _CLEAN_SQL)
def stream_clean(spark, sf_dir):
    """The steps on a stream, written exactly once to parquet."""
    path = scratch_path(spark, "stream")
    cleaned = transform_data(_order_steps(), _orders_stream(spark, sf_dir)).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    write_parquet_stream(cleaned, path, path + "-checkpoint").awaitTermination()
    return spark.read.schema(cleaned.schema).parquet(path)


@query("stream_append_csv", "SELECT o_orderkey, o_orderstatus FROM orders WHERE isodow(o_orderdate) NOT IN (1, 7)")
def stream_append_csv(spark, sf_dir):
    path = scratch_path(spark, "stream")
    rows = _orders_stream(spark, sf_dir).transform(dates.keep_workdays("o_orderdate"))
    append_csv_stream(rows, path, path + "-checkpoint", ["o_orderkey", "o_orderstatus"]).awaitTermination()
    return extract_csv(spark, path)


@query(
    "stream_batches",
    """
    WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 40 <> 0 THEN o_orderstatus END AS status FROM orders)
    SELECT * FROM t WHERE status IS NOT NULL
    """,
)
def stream_batches(spark, sf_dir):
    """A step that needs table statistics: decided once on the table, applied to a micro-batch for each of several files."""
    path = scratch_path(spark, "stream")
    status = F.when(F.col("o_orderkey") % 40 != 0, F.col("o_orderstatus"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"))
    # Where a file's nulls are all together, what its batch shows is not what the table shows.
    rows.repartitionByRange(5, F.col("o_orderkey") % 40).write.parquet(f"{path}-files")
    fitted = fit_steps([nulls.dropna_by_threshold(0.05)], rows)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}-files")

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    run_batches(stream, fitted, write, path + "-checkpoint").awaitTermination()
    return spark.read.parquet(path).select("o_orderkey", "status")
