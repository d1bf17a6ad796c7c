"""The operators over the given tables, one query each, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepmill.llm import ann, bond, langid, mixing, packing, periodic, quality, sharding, simhash, substrings, topk, toxicity, urlfilter

Query = Callable[[SparkSession, str], DataFrame]

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
SHARES = {"src0": 6, "src1": 3, "src2": 2}
BLOCK_ROWS = 16
TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def encoder() -> packing.Encoder:
    import public_tokenizers

    return packing.Encoder(public_tokenizers.path(TOKENIZER))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = packing.pieces(docs, encoder).drop("text")
    return packing.packed(cut)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents graded by a model of the labelled ones."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("grade"))
    model = toxicity.train(docs, labels)
    out = toxicity.graded(docs, model)
    return out.select("doc_id", "severity", "grade", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out_of = langid.held_out(F.col("doc_id"))
    model = langid.train(docs, ~out_of)
    out = langid.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(out_of, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judged(_table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 5, 50)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs, SHARES, block_rows=BLOCK_ROWS)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    sized = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return sharding.sharded(sized, 40, keep_text=False).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 20, 20)


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return bond.hard_negatives(table.withColumn("label", moved))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out_of = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~out_of)
    out = quality.scored(docs, quality.train(docs, labels))
    return out.select("doc_id", F.coalesce(out_of, F.lit(False)).alias("held_out"), "score", "predicted")


def _with_periods(docs: DataFrame) -> DataFrame:
    """Every tenth text by hash goes on with its own words, period after period, from some word on; all others stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = docs.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    sized = found.withColumns({"g": F.expr("h div 10"), "n": F.size("words")}).withColumn("a", F.when(F.col("n") > 0, F.expr("CAST(g % n AS INT)")))
    sized = sized.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    period = F.expr("slice(words, a + 1, p)")
    again = F.flatten(F.array_repeat(period, F.expr("CAST(ceil((n - a) / p) AS INT)")))
    periodic = F.array_join(F.slice(F.concat(F.expr("slice(words, 1, a)"), again), 1, F.col("n")), " ")
    return sized.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.periodic_runs(_with_periods(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # Runs come by start, then period, so the first of equal exponents stays.
    best = F.aggregate("runs", none, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return out.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_packing, op2_toxicity, op3_substrings, op4_simhash, op5_langid, op6_urls, op7_topk, op8_mixing, op9_sharding, op10_ann, op11_negatives, op12_quality, op13_periodic)
}


def _url_sql() -> str:
    """The rules and the fitted weights as SQL over lists of character codes."""
    fits = " ".join(
        f"WHEN (host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '/{p}') THEN '{rule}'"
        for rule, _ in sorted(RULES, key=lambda r: -len(r[0]))
        for d, _, p in [rule.partition("/")]
    )
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES)
    weights = urlfilter.trained()

    def grams(column: str, kind: int) -> str:
        return (
            f"list_transform(range(1, length({column}) + 1), lambda i: ("
            f"(CASE WHEN i = 1 THEN 1 ELSE unicode({column}[i - 1]) END) * 961 + unicode({column}[i]) * 31 + "
            f"(CASE WHEN i = length({column}) THEN 2 ELSE unicode({column}[i + 1]) END) + {kind * 1777}) % {urlfilter.BUCKETS})"
        )

    # An empty host or path still has its two end marks, which make no gram of three.
    return f"""
    WITH cut AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), named AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
    ), ruled AS (
        SELECT *, CASE {fits} END AS rule,
               list_distinct(list_concat({grams('host', 0)}, {grams('path', 1)})) AS buckets FROM named
    ), scored AS (
        SELECT *, {weights[-1]} + coalesce(list_sum(list_transform(buckets, lambda b: w[b + 1])), 0) AS score
        FROM ruled, (SELECT {weights[:-1]}::DOUBLE[] AS w)
    )
    SELECT page_id, host, path, rule,
           CASE rule {verdicts} ELSE CASE WHEN score > 0 THEN 'block' ELSE 'allow' END END AS verdict
    FROM scored
    """


_TOPK_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5
"""

_NEGATIVES_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(CAST(a.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 50 = 0
), p AS (
    SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""

# The schedule is worked out slot by slot: of the released blocks the one with the earliest deadline goes.
MIXING_SQL = f"""
WITH RECURSIVE s AS (
    SELECT source, CASE source {" ".join(f"WHEN '{k}' THEN {v}" for k, v in SHARES.items())} ELSE 1 END AS share,
           row_number() OVER (ORDER BY source NULLS FIRST) AS i FROM (SELECT DISTINCT source FROM documents)
), a AS (SELECT list(share ORDER BY i) AS shares, CAST(sum(share) AS BIGINT) AS total, count(*) AS n FROM s),
plan AS (
    SELECT 0::BIGINT AS slot, list_transform(range(n), lambda x: 0::BIGINT) AS done, NULL::BIGINT AS i, NULL::BIGINT AS turn FROM a
    UNION ALL
    SELECT slot + 1, list_transform(range(1, n + 1), lambda x: done[x] + CASE WHEN x = best THEN 1 ELSE 0 END), best, done[best]
    FROM (
        SELECT slot, done, n, list_sort(list_transform(
            list_filter(range(1, n + 1), lambda x: done[x] < shares[x] AND done[x] * total // shares[x] <= slot),
            lambda x: {{'due': ((done[x] + 1) * total + shares[x] - 1) // shares[x], 'x': x}}))[1].x AS best
        FROM plan, a WHERE slot < total
    )
), d AS (
    SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST) - 1 AS r FROM documents
), b AS (
    SELECT d.*, r // {BLOCK_ROWS} AS block, r % {BLOCK_ROWS} AS within, s.i, s.share FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
), t AS (
    SELECT b.*, (block // share) * (SELECT total FROM a) + plan.slot - 1 AS slot
    FROM b JOIN plan ON plan.i = b.i AND plan.turn = b.block % b.share
)
SELECT doc_id, source, block, slot, row_number() OVER (ORDER BY slot, within) - 1 AS position FROM t
"""

SQL: dict[str, str] = {"op6_urls": _url_sql(), "op7_topk": _TOPK_SQL, "op8_mixing": MIXING_SQL, "op11_negatives": _NEGATIVES_SQL}
