"""Text steps."""

from pyspark.sql import functions as F

from stepmill import strings
from stepmill.plans.queries.registry import query, table

_DIRTY_SQL = "'  ' || p_name || chr(9) || chr(10) || ' ' || lower(p_type) || ' '"


def _dirty():
    return F.concat(
        F.lit("  "), F.col("p_name"), F.lit("\t\n "), F.lower("p_type"), F.lit(" ")
    )


def _case_sql(text):
    return f"""array_to_string(list_transform(
        regexp_extract_all(lower({text}), '(\\p{{L}}+|[^\\p{{L}}]+)'),
        lambda w: upper(w[1]) || w[2:]), '')"""


@query(
    "squeeze_ws",
    f"SELECT p_partkey, regexp_replace({_DIRTY_SQL}, '[\\t\\n\\f\\r ]+', ' ', 'g') AS dirty FROM part",
)
def squeeze_ws(spark, sf_dir):
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", _dirty().alias("dirty"))
        .transform(strings.trim_regex_whitespace(["dirty"]))
    )



@query(
    "title_case",
    f"""
    SELECT p_partkey, {_case_sql("p_name || '''s ' || p_brand || '-' || p_type || p_partkey || 'x'")} AS label,
           p_size::VARCHAR AS p_size
    FROM part
    """,
)
def title_case(spark, sf_dir):
    label = F.concat(
        F.lit("\xa0 "), F.col("p_name"), F.lit("'s "), F.col("p_brand"), F.lit("-"), F.col("p_type"),
        F.col("p_partkey").cast("string"), F.lit("x\t"),
    )
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", label.alias("label"), "p_size")
        .transform(strings.normalize_trim_case({"title": ["label", "p_size"], "capitalize": ["label"]}))
    )


@query(
    "title_case_documents",
    f"""
    SELECT doc_id, {_case_sql("regexp_replace(text, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g')")} AS text
    FROM documents
    """,
)
def title_case_documents(spark, sf_dir):
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "text")
        .transform(strings.normalize_trim_case({"title": ["text"]}))
    )


@query(
    "capitalize",
    """
    SELECT p_partkey, upper(substr(p_name, 1, 1)) || lower(substr(p_name || ' ' || p_type, 2)) AS label
    FROM part
    """,
)
def capitalize(spark, sf_dir):
    label = F.concat(F.lit("\t"), F.col("p_name"), F.lit(" "), F.col("p_type"), F.lit(" "))
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", label.alias("label"))
        .transform(strings.normalize_trim_case({"capitalize": ["label"], "shout": ["label"]}))
    )


@query(
    "merge_cols",
    """
    SELECT p_partkey,
           trim(coalesce(CASE WHEN p_partkey % 3 <> 0 THEN p_name END, '') || ', '
                || coalesce(CASE WHEN p_partkey % 5 <> 0 THEN p_brand || ',' END, '') || ', '
                || coalesce(CASE WHEN p_partkey % 15 <> 0 THEN p_size::VARCHAR END, '') || ', '
                || CASE WHEN p_partkey % 2 = 0 THEN 'True' ELSE 'False' END
                || ', ' || coalesce(CASE WHEN p_partkey % 4 = 0 THEN (p_partkey * 10000000)::VARCHAR || '.0' END, ''),
                ', ') AS label
    FROM part
    """,
)
def merge_cols(spark, sf_dir):
    key = F.col("p_partkey")
    # Below 1e16, where the text of a double is positional.
    big = F.when(key % 4 == 0, (key * 10_000_000).cast("double"))
    return (
        table(spark, sf_dir, "part")
        .select(
            "p_partkey",
            F.when(key % 3 != 0, F.col("p_name")).alias("name"),
            F.when(key % 5 != 0, F.concat("p_brand", F.lit(","))).alias("label"),
            F.when(key % 15 != 0, F.col("p_size")).alias("size"),
            (key % 2 == 0).alias("even"),
            big.alias("big"),
        )
        .transform(strings.merge_string_columns(["name", "label", "size", "even", "big"], "label", ", "))
    )
