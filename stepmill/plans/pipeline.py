"""The step runner: a pipeline is an ordered list of ``DataFrame -> DataFrame`` steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame

Step = Callable[[DataFrame], DataFrame]


def transform_data(steps: Iterable[Step], df: DataFrame) -> DataFrame:
    """Apply the steps in order. Only the logical plan grows; the caller's action runs it."""
    return reduce(lambda frame, step: frame.transform(step), steps, df)
