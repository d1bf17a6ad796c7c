"""Step pipelines on streaming tables.

Steps that keep no table-wide state work on streams as they are, and so do the decisions of steps that
look at the whole table (``plans.fitted``). The latter themselves raise, on a stream and on a micro-batch:
what a batch shows would depend on how the stream is cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stepmill.plans.fitted import WholeTableStep
from stepmill.plans.pipeline import Step, transform_data
from stepmill.session import inside_stream


def write_parquet_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a parquet folder, each row exactly once, until the input is used up."""
    return (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def run_batches(
    df: DataFrame,
    steps: Iterable[Step],
    write: Callable[[DataFrame, int], object],
    checkpoint: str,
) -> StreamingQuery:
    """Apply the steps to every micro-batch and hand the result, with the batch number, to
    ``write``. A batch may come again after a failure, so ``write`` should be idempotent per number.

    Steps that look at the whole table must be fitted before: ``run_batches(df, fit_steps(steps, table), ...)``.
    """
    steps = list(steps)
    unfitted = [step.name for step in steps if isinstance(step, WholeTableStep)]
    if unfitted:
        raise ValueError(f"{unfitted} would decide by each micro-batch; fit them to a table first (fit_steps)")

    def one_batch(batch: DataFrame, number: int) -> None:
        with inside_stream():
            out = transform_data(steps, batch)
        write(out, number)

    return (
        df.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
