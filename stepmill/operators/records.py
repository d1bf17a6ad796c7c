"""Record constraints: text normalisation, required fields, types, projection to a model.

A model is a ``StructType``. A field that is not nullable must have a value; metadata
``{"min_length": 1}`` additionally forbids the empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill.functions import text
from stepmill.plans.pipeline import Step
from stepmill.session import quoted, require_columns, scratch_path


def text_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    require_columns(df, columns or ())
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)
    ]


def normalize_text(columns: Sequence[str] | None = None, order: str = "blanks_first") -> Step:
    """Squeeze blanks and normalise characters of the text columns (all by default).

    With ``blanks_first`` blanks are squeezed before NFKC and zero-width removal, so blanks that
    only become neighbours by that removal stay two; ``text_first`` does it the other way round.
    """
    if order not in ("blanks_first", "text_first"):
        raise ValueError(f"order is 'blanks_first' or 'text_first', not {order!r}")

    stages = [text.squeeze_blanks, text.clean_characters]
    if order == "text_first":
        stages.reverse()

    def step(df: DataFrame) -> DataFrame:
        names = text_columns(df, columns)
        for stage in stages if names else ():
            # One projection per stage, so that no stage is worked out twice inside the next.
            df = df.withColumns({n: stage(F.col(quoted(n))) for n in names})
        return df

    return step


def nullify_empty(columns: Sequence[str] | None = None) -> Step:
    """Empty text becomes null."""

    def step(df: DataFrame) -> DataFrame:
        names = text_columns(df, columns)
        return (
            df.withColumns({n: text.empty_to_null(F.col(quoted(n))) for n in names}) if names else df
        )

    return step


def normalize_record(columns: Sequence[str] | None = None, order: str = "blanks_first") -> Step:
    """:func:`normalize_text`, then :func:`nullify_empty`."""
    clean, nullify = normalize_text(columns, order), nullify_empty(columns)
    return lambda df: nullify(clean(df))


def project_to_model(model: T.StructType, defaults: dict[str, object] | None = None) -> Step:
    """Only the model's fields, in the model's order. A field the table lacks needs a default."""
    defaults = defaults or {}

    def step(df: DataFrame) -> DataFrame:
        missing = [f.name for f in model.fields if f.name not in df.columns and f.name not in defaults]
        if missing:
            raise ValueError(f"no value and no default for model fields {missing}")
        return df.select(
            *[
                F.col(quoted(f.name)) if f.name in df.columns else F.lit(defaults[f.name]).alias(f.name)
                for f in model.fields
            ]
        )

    return step


def reject_reason(model: T.StructType, df: DataFrame) -> Column:
    """Null for a good record, otherwise why its first bad field was rejected."""
    tests = []
    for field in model.fields:
        c = F.col(quoted(field.name))
        if not field.nullable:
            tests.append(F.when(c.isNull(), F.lit(f"{field.name}: missing")))
        if field.metadata.get("min_length"):
            short = F.length(c) < int(field.metadata["min_length"])
            tests.append(F.when(short, F.lit(f"{field.name}: too short")))
        if df.schema[field.name].dataType != field.dataType:
            bad = c.isNotNull() & c.try_cast(field.dataType).isNull()
            tests.append(
                F.when(bad, F.lit(f"{field.name}: not a {field.dataType.simpleString()}"))
            )
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def _typed(model: T.StructType) -> list[Column]:
    return [F.col(quoted(f.name)).try_cast(f.dataType).alias(f.name) for f in model.fields]


def _judged(df: DataFrame, model: T.StructType, defaults: dict[str, object] | None) -> DataFrame:
    """The projected records with ``__reason``, why a record is rejected.

    The partition number, never negative, pins the judgement to this place. A filter on it that is
    pushed further down would work out the fields twice (in Python too) and judge rows that never
    become records.
    """
    out = project_to_model(model, defaults)(df)
    placed = out.withColumn("__part", F.spark_partition_id())
    return placed.withColumn("__reason", F.when(F.col("__part") >= 0, reject_reason(model, out))).drop("__part")


def conform(model: T.StructType, defaults: dict[str, object] | None = None) -> Step:
    """Project to the model and type every field. A bad record fails the job, also when the bad
    field is not used later.
    """

    def step(df: DataFrame) -> DataFrame:
        reason = F.col("__reason")
        failed = F.raise_error(reason).cast("boolean")
        checked = _judged(df, model, defaults).filter(F.when(reason.isNotNull(), failed).otherwise(F.lit(True)))
        return checked.select(*_typed(model))

    return step


def quarantine(
    model: T.StructType, defaults: dict[str, object] | None = None
) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """Split into good records (typed) and rejected ones (as they came, plus ``reason``).

    Each side works out its input when it is used; :func:`quarantine_to` works it out once for both.
    """

    def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        judged = _judged(df, model, defaults)
        good = judged.filter(F.col("__reason").isNull()).select(*_typed(model))
        rejected = judged.filter(F.col("__reason").isNotNull())
        return good, rejected.withColumnRenamed("__reason", "reason")

    return split


class Quarantined(NamedTuple):
    """Both sides of a judged table, read from where they were written, and their numbers of rows."""

    good: DataFrame
    rejected: DataFrame
    good_rows: int
    rejected_rows: int


def quarantine_to(model: T.StructType, defaults: dict[str, object] | None = None) -> Callable[[DataFrame, str | None], Quarantined]:
    """Judge every record once and write both sides in one job: good records typed, rejected ones as they came, plus ``reason``.

    The folder is partitioned by ``accepted``, so reading one side reads its files alone. The rows are counted while
    they are written. Without a path the folder is a new one in the shared folder.
    """

    def split(df: DataFrame, path: str | None = None) -> Quarantined:
        path = path or scratch_path(df.sparkSession, "quarantine")
        judged = _judged(df, model, defaults)
        accepted = F.col("__reason").isNull()
        came = F.struct(*[F.col(quoted(f.name)) for f in model.fields])
        out = judged.select(
            F.when(accepted, F.struct(*_typed(model))).alias("record"),
            F.when(~accepted, came).alias("came"),
            F.col("__reason").alias("reason"),
            accepted.alias("accepted"),
        )
        seen = Observation()
        counted = out.observe(seen, F.count_if(F.col("accepted")).alias("good"), F.count_if(~F.col("accepted")).alias("rejected"))
        counted.write.partitionBy("accepted").parquet(path)
        both = df.sparkSession.read.schema(out.schema).parquet(path)
        good = both.filter("accepted").select(*[F.col("record")[f.name].alias(f.name) for f in model.fields])
        rejected = both.filter("NOT accepted").select(*[F.col("came")[f.name].alias(f.name) for f in model.fields], "reason")
        return Quarantined(good, rejected, seen.get["good"], seen.get["rejected"])

    return split
