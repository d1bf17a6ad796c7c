"""Record normalisation and constraints."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill import records
from stepmill.plans.queries.registry import query, table

# Unicode blanks as a class for SQL regular expressions.
_BLANKS_SQL = "[\\s\\x0b\\x1c-\\x1f\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def _squeezed(text):
    return f"trim(regexp_replace({text}, '{_BLANKS_SQL}', ' ', 'g'))"


@query(
    "record_normalize",
    f"""
    SELECT doc_id,
           nullif({_squeezed("text")}, '') AS text,
           nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END, '') AS source,
           {_squeezed("lang || '  ' || source")} AS label
    FROM documents
    """,
)
def record_normalize(spark, sf_dir):
    """Whole texts with ideographic and no-break blanks and zero-width characters put in."""
    key = F.col("doc_id")
    return (
        table(spark, sf_dir, "documents")
        .select(
            "doc_id",
            F.concat(F.lit("\xa0\t"), F.regexp_replace("text", "e", "e​"), F.lit("　\n")).alias("text"),
            F.when(key % 3 == 0, F.lit(" \xa0 ")).otherwise(F.col("source")).alias("source"),
            F.concat(F.col("lang"), F.lit(" \xa0​"), F.col("source")).alias("label"),
        )
        .transform(records.normalize_record())
    )


@query(
    "record_nfkc",
    f"""SELECT doc_id, 'The (ABC) 12 fi ' || {_squeezed("text")} AS text FROM documents""",
)
def record_nfkc(spark, sf_dir):
    """Compatibility characters: full-width letters, a parenthesised form, superscripts, a ligature."""
    return (
        table(spark, sf_dir, "documents")
        .select(
            "doc_id",
            F.concat(F.lit("Ｔｈｅ\xa0（ＡＢＣ） \xb9\xb2 ﬁ "), F.col("text")).alias("text"),
        )
        .transform(records.normalize_record(order="text_first"))
    )


_MODEL = T.StructType([
    T.StructField("source", T.StringType(), nullable=False, metadata={"min_length": 1}),
    T.StructField("doc_id", T.LongType(), nullable=False),
    T.StructField("words", T.IntegerType()),
    T.StructField("origin", T.StringType()),
])

_JUDGED_SQL = """
    SELECT CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 10 = 1 THEN '' ELSE source END AS source,
           CASE WHEN doc_id % 17 = 3 THEN 'no. ' || doc_id ELSE doc_id::VARCHAR END AS doc_id,
           CASE WHEN doc_id % 19 = 4 THEN 'many' WHEN doc_id % 19 <> 5 THEN n_chars::VARCHAR END AS words
    FROM documents
"""


def _judged(spark, sf_dir):
    key = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.when(key % 17 == 3, F.concat(F.lit("no. "), key.cast("string"))).otherwise(key.cast("string")).alias("doc_id"),
        F.when(key % 10 == 0, F.lit(None)).when(key % 10 == 1, F.lit("")).otherwise(F.col("source")).alias("source"),
        F.when(key % 19 == 4, "many").when(key % 19 != 5, F.col("n_chars").cast("string")).alias("words"),
        F.col("lang").alias("not_in_the_model"),
    )


_SPLIT = records.quarantine(_MODEL, {"origin": "crawl"})


@query(
    "quarantine_good",
    f"""
    SELECT source, doc_id::BIGINT AS doc_id, words::INT::VARCHAR AS words, 'crawl' AS origin FROM ({_JUDGED_SQL})
    WHERE coalesce(source, '') <> '' AND try_cast(doc_id AS BIGINT) IS NOT NULL
      AND (words IS NULL OR try_cast(words AS INT) IS NOT NULL)
    """,
)
def quarantine_good(spark, sf_dir):
    return _SPLIT(_judged(spark, sf_dir))[0].withColumn("words", F.col("words").cast("string"))


@query(
    "quarantine_rejected",
    f"""
    SELECT *, 'crawl' AS origin, CASE WHEN source IS NULL THEN 'source: missing'
                   WHEN source = '' THEN 'source: too short'
                   WHEN try_cast(doc_id AS BIGINT) IS NULL THEN 'doc_id: not a bigint'
                   ELSE 'words: not a int' END AS reason
    FROM ({_JUDGED_SQL})
    WHERE coalesce(source, '') = '' OR try_cast(doc_id AS BIGINT) IS NULL
       OR (words IS NOT NULL AND try_cast(words AS INT) IS NULL)
    """,
)
def quarantine_rejected(spark, sf_dir):
    return _SPLIT(_judged(spark, sf_dir))[1]


@query(
    "quarantine_once",
    f"""
    WITH j AS (SELECT *, coalesce(source, '') <> '' AND try_cast(doc_id AS BIGINT) IS NOT NULL
                         AND (words IS NULL OR try_cast(words AS INT) IS NOT NULL) AS accepted FROM ({_JUDGED_SQL}))
    SELECT accepted, count(*) AS rows, count(*) AS noted, count(words) AS words, min(source) AS first_source FROM j GROUP BY accepted
    """,
)
def quarantine_once(spark, sf_dir):
    """Both sides written in one job, and counted while they are."""
    split = records.quarantine_to(_MODEL, {"origin": "crawl"})(_judged(spark, sf_dir), None)

    def summed(side, accepted, noted):
        return side.agg(F.count("*").alias("rows"), F.lit(noted).cast("bigint").alias("noted"), F.count("words").alias("words"), F.min("source").alias("first_source")).withColumn("accepted", F.lit(accepted))

    return summed(split.good, True, split.good_rows).unionByName(summed(split.rejected, False, split.rejected_rows))


@query(
    "conform_strict",
    "SELECT source, doc_id, n_chars::INT AS words, 'crawl' AS origin FROM documents",
)
def conform_strict(spark, sf_dir):
    return (
        table(spark, sf_dir, "documents")
        .select(F.col("doc_id").cast("string").alias("doc_id"), "source", F.col("n_chars").cast("string").alias("words"), "lang")
        .transform(records.conform(_MODEL, {"origin": "crawl"}))
    )


@query("project_model", "SELECT source, doc_id, n_chars AS words, 'crawl' AS origin FROM documents")
def project_model(spark, sf_dir):
    return (
        table(spark, sf_dir, "documents")
        .withColumnRenamed("n_chars", "words")
        .transform(records.project_to_model(_MODEL, {"origin": "crawl"}))
    )
