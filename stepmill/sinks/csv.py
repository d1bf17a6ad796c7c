"""CSV sinks. A target is a folder of part files, each with a header that readers take off again, and of notes on what was appended."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stepmill.functions.text import as_text
from stepmill.session import Files, quoted, require_columns

# The folder's own notes; readers pass over names that begin with an underscore.
_NOTES = "_appended"
_COLUMNS = f"{_NOTES}/columns"
# Null and empty text are both an empty cell; quotes are doubled; blanks are kept.
_FORMAT = {
    "header": True,
    "nullValue": "",
    "emptyValue": "",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _select(df: DataFrame, columns: Sequence[str] | T.StructType | None) -> DataFrame:
    names = columns.fieldNames() if isinstance(columns, T.StructType) else columns or df.columns
    require_columns(df, names)
    return df.select(*[_cell(df, name) for name in names])


def _cell(df: DataFrame, name: str):
    dtype = df.schema[name].dataType
    c = F.col(quoted(name))
    nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
    return as_text(c, dtype).alias(name) if nested else c


def append_csv(df: DataFrame, path: str, columns: Sequence[str] | T.StructType | None = None, batch: int | None = None) -> int:
    """Append the rows to the CSV folder and return how many there were.

    ``columns`` (names or a model) fixes the columns and their order; others are left out. The folder remembers
    the list of its first append, and one with another list is refused. Without rows nothing is written,
    not even the folder. The rows are counted while they are written.

    With a ``batch`` number the append is made once: rows are written aside, moved into the folder under names
    of the batch, and noted as done. The same number again writes nothing and returns the noted count; after a
    crash it first takes away what the lost attempt had moved. Only one writer at a time may use a number.
    """
    rows, folder = _select(df, columns), Files(df.sparkSession, path)
    done = None if batch is None else folder.read(f"{_NOTES}/batch-{batch}")
    if done is not None:
        _check_columns(folder, path, rows.columns)
        return int(done)
    if rows.isEmpty():
        return 0
    if folder.read(_COLUMNS) is None:
        folder.create(_COLUMNS, json.dumps(rows.columns))
    _check_columns(folder, path, rows.columns)
    written = Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append").options(**_FORMAT)
    if batch is None:
        counted.csv(path)
        return written.get["rows"]
    for name in folder.names("", f"batch-{batch}-"):
        folder.delete(name)
    staged = f"{_NOTES}/staged-{uuid.uuid4().hex}"
    counted.csv(f"{path}/{staged}")
    for name in folder.names(staged, "part-"):
        folder.move(f"{staged}/{name}", f"batch-{batch}-{name}")
    folder.delete(staged)
    folder.create(f"{_NOTES}/batch-{batch}", str(written.get["rows"]))
    return written.get["rows"]


def _check_columns(folder: Files, path: str, names: Sequence[str]) -> None:
    known = json.loads(folder.read(_COLUMNS) or "null")
    if known is not None and known != list(names):
        raise ValueError(f"{path} holds the columns {known}; cannot append {list(names)}")


def dated_path(
    location: str, prefix: str = "export", date: dt.date | None = None, output_path: str | None = None
) -> str:
    """``<location>/<prefix>_<yyyymmdd>.csv``; an explicit path wins."""
    if output_path is not None:
        return output_path
    return f"{location.rstrip('/')}/{prefix}_{(date or dt.date.today()):%Y%m%d}.csv"


def stage_export(df: DataFrame, stage_dir: str, columns: Sequence[str] | None = None) -> None:
    """Write gzip-compressed CSV part files to a stage folder on any Hadoop file system."""
    _select(df, columns).write.mode("append").options(**_FORMAT, compression="gzip").csv(stage_dir)


def append_csv_stream(
    df: DataFrame, path: str, checkpoint: str, columns: Sequence[str] | None = None
) -> StreamingQuery:
    """Append a stream to a CSV folder, each row exactly once, until the input is used up.

    The folder is one that only streams write to; it remembers its columns as that of ``append_csv`` does.
    """
    rows, folder = _select(df, columns), Files(df.sparkSession, path)
    if folder.read(_COLUMNS) is None:
        folder.create(_COLUMNS, json.dumps(rows.columns))
    _check_columns(folder, path, rows.columns)
    return (
        rows
        .writeStream.format("csv")
        .options(**_FORMAT)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
