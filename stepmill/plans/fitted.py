"""Steps that decide by the whole table, and the decisions they come to.

A :class:`WholeTableStep` applied to a table decides and applies in one go. Its ``fit`` gives the decision alone: a small
step that looks at nothing but its rows, can be written down as JSON, and does the same to the table, to a later
batch and to a stream.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame

from stepmill.plans.pipeline import Step
from stepmill.session import quoted, require_batch, require_columns


@dataclass(frozen=True)
class DropRows:
    """Drop rows with a missing value in any of the columns."""

    columns: tuple[str, ...]

    def __call__(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.columns)
        return df.na.drop(how="any", subset=[quoted(c) for c in self.columns]) if self.columns else df


@dataclass(frozen=True)
class MarkColumns:
    """Put these entries into the columns' metadata; ``estimated`` names the columns that were not counted exactly."""

    metadata: dict[str, dict]
    estimated: tuple[str, ...] = ()

    def __call__(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.metadata)
        for name, entries in self.metadata.items():
            df = df.withMetadata(name, {**df.schema[name].metadata, **entries})
        return df


Decision = DropRows | MarkColumns
_KINDS = {kind.__name__: kind for kind in (DropRows, MarkColumns)}


def to_json(decisions: Iterable[Decision]) -> str:
    """Decisions as text; plain steps have no such form."""
    return json.dumps([{"kind": type(d).__name__, **asdict(d)} for d in decisions])


def from_json(text: str) -> list[Decision]:
    def made(kind: str, **values) -> Decision:
        return _KINDS[kind](**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})

    return [made(**entry) for entry in json.loads(text)]


class WholeTableStep:
    """A step whose effect depends on statistics of the whole table."""

    def __init__(self, name: str, decide: Callable[[DataFrame], Decision]):
        self.name, self._decide = name, decide

    def fit(self, df: DataFrame) -> Decision:
        """Decide by this table, without changing it."""
        require_batch(df, self.name)
        return self._decide(df)

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.fit(df)(df)


def fit_steps(steps: Iterable[Step], table: DataFrame) -> list[Step]:
    """The steps with every whole-table step replaced by its decision on ``table`` as the steps before it leave it."""
    fitted = []
    for step in steps:
        step = step.fit(table) if isinstance(step, WholeTableStep) else step
        table = step(table)
        fitted.append(step)
    return fitted
