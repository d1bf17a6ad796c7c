"""A corpus pipeline of five stages: language, near-duplicates, repeated passages, mixing, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all rows its predecessor kept; ``run``
writes each result as Parquet in the shared folder and reads it again for the next. All but the last return
the columns of ``documents``. What a stage lands on the way is removed when the next one starts, so its
result must be written before, as ``run`` does.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepmill.llm import langid, mixing, packing, queries, simhash, substrings
from stepmill.llm.common import apart
from stepmill.session import materialise, quoted, release, scratch, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_landed: list[str] = []


def _stage(function: Stage) -> Stage:
    """Ships the package, and removes what the stage before has landed: its result is written by now."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        release(spark, _landed)
        with scratch(spark) as tables:
            out = function(spark, docs, sf_dir)
        _landed.extend(tables)
        return out

    return run_stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the language models reject: without a letter, or unlike any language they learned.

    The models learn from all documents of the stage that have a language. If none has one, all with a
    letter stay.
    """
    model = langid.train(docs, F.lit(True))
    if not model.languages:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    held, back = apart(docs, langid.ADDED)
    return back(langid.identify(held, model).filter("accepted"))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group linked by SimHash: three-word shingles, at most 2 of 64 bits apart.

    A null text counts as empty. Repeated rows are a group; of equal doc_ids any one row stays.
    """
    return simhash.keep_one(docs, words=3, budget=2)


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out every byte of repeated 200-byte strings; documents of which nothing is left go.

    A character of which a cut took a part goes whole. ``n_chars`` follows the text.
    """
    held, back = apart(docs, substrings.ADDED)
    cut = substrings.remove_repeats(held, as_text=True).filter("n_removed = 0 OR n_removed < n_bytes")
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept"))
    names = {c.lower(): c for c in docs.columns}
    changed = {names["text"]: text}
    if "n_chars" in names:
        changed[names["n_chars"]] = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.char_length(text)).cast(docs.schema[names["n_chars"]].dataType)
    return back(cut.withColumns(changed))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix."""
    return mixing.in_mix_order(docs, queries.SHARES, block_rows=queries.BLOCK_ROWS)


def _in_given_order(docs: DataFrame, names: list[str]) -> DataFrame:
    """``names`` of all rows with ``at_file`` and ``at_row``: their places in the files they were read from, else in the table."""
    own = [quoted(c) for c in names]
    try:
        return docs.select(*own, F.col("_metadata.file_name").alias("at_file"), F.col("_metadata.row_index").alias("at_row"))
    except AnalysisException:  # not read from files
        return docs.select(*own, F.lit("").alias("at_file"), F.monotonically_increasing_id().alias("at_row"))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of at most 2048 that follow the order of the mix.

    Sequences are numbered in that order, run by run of 32,768 pieces, so that every prefix of them holds the mix's shares.
    """
    cut = packing.pieces(_in_given_order(docs, ["doc_id", "text"]), queries.encoder).drop("text")
    return packing.packed(cut, order=["at_file", "at_row", "start"]).drop("at_file", "at_row")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mix),
    ("packing", pack),
]

#: Trained models, fingerprints and token ids are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        with scratch(spark) as tables:
            docs = materialise(result, f"pipeline-{name}")
        release(spark, before)
        before = tables
    release(spark, _landed)
    return docs
