"""Session helpers: a ready-made local session, the shared folder, and small checks."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Broadcast a side only up to this many rows; above it another strategy is used.
MAX_BROADCAST_ROWS = 1_000_000

#: Settings the library likes. None is required: without them results are the same.
RECOMMENDED = {
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(app: str = "stepmill", cores: int | str = "*") -> SparkSession:
    """A local session for tests, notebooks and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        # Small tables are spread over the cores too.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()
_notes: list[list[str]] = []
# Catalog names of landed tables that have one, by path.
_catalogued: dict[str, str] = {}
# On a local master without the setting: one folder for each application.
_local_folders: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="stepmill-")) / "stepmill.zip"
    with zipfile.ZipFile(archive, "w") as package:
        for source in sorted(root.rglob("*.py")):
            package.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    When it is unset a temporary folder is made, but only on a local master: on a cluster a
    machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="stepmill-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; never used twice."""
    path = f"{shared_folder(spark)}/stepmill/{label}-{uuid.uuid4().hex}"
    for tables in _notes:
        tables.append(path)
    return path


def catalogued(path: str, name: str) -> None:
    """Note the catalog name of a table landed at ``path``; ``release`` drops it."""
    _catalogued[path] = name


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Run ``df`` once, keep it as a parquet table in the shared folder, and read it back.

    Used where two later jobs must see the very same rows in the very same partitions (row
    numbering) or where the input must be read only once (remote pages). The table outlives lost
    executors, and later reads still get column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Note the tables landed inside the block; ``release`` them when their results are written.

    >>> with scratch(spark) as tables:
    ...     numbered = df.transform(with_row_index(["id"]))
    ...     numbered.write.parquet(target)
    >>> release(spark, tables)
    """
    tables: list[str] = []
    _notes.append(tables)
    try:
        yield tables
    finally:
        _notes.remove(tables)


class Files:
    """Small files and folder entries below a root, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._root = root.rstrip("/")
        self._system = self._path(self._root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self._path(f"{self._root}/{name}" if name else self._root)

    def read(self, name: str) -> str | None:
        """The text of a file; None if there is none."""
        if not self._system.exists(self._at(name)):
            return None
        stream = self._system.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A new file; one that exists stays as it is. It appears whole."""
        if self._system.exists(self._at(name)):
            return
        made = self._at(f"{name}-{uuid.uuid4().hex}")
        stream = self._system.create(made, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._system.rename(made, self._at(name)):
            self._system.delete(made, False)

    def names(self, folder: str, prefix: str) -> list[str]:
        """Entries of a folder whose name starts so."""
        if not self._system.exists(self._at(folder)):
            return []
        found = [entry.getPath().getName() for entry in self._system.listStatus(self._at(folder))]
        return sorted(name for name in found if name.startswith(prefix))

    def move(self, name: str, to: str) -> None:
        if not self._system.rename(self._at(name), self._at(to)):
            raise OSError(f"cannot move {self._root}/{name} to {to}")

    def delete(self, name: str) -> None:
        self._system.delete(self._at(name), True)


def release(spark: SparkSession, tables: list[str]) -> None:
    """Remove landed tables, from the catalog too. DataFrames that still read them can't be run any more."""
    while tables:
        landed = tables.pop()
        if landed in _catalogued:
            spark.sql(f"DROP TABLE IF EXISTS {_catalogued.pop(landed)}")
        path = spark._jvm.org.apache.hadoop.fs.Path(landed)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def small_table(spark: SparkSession, columns: dict[str, list], types: dict[str, pa.DataType]) -> DataFrame:
    """A table made of configuration or per-partition figures; it becomes part of the plan."""
    arrays = [pa.array(values, type=types[name]) for name, values in columns.items()]
    return spark.createDataFrame(pa.table(arrays, names=list(columns)))


def require_columns(df: DataFrame, names) -> None:
    """Raise while the plan is built when a configured column does not exist."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")


_inside_stream: ContextVar[bool] = ContextVar("inside_stream", default=False)


@contextmanager
def inside_stream() -> Iterator[None]:
    """Tables seen inside the block are parts of a stream."""
    token = _inside_stream.set(True)
    try:
        yield
    finally:
        _inside_stream.reset(token)


def require_batch(df: DataFrame, step: str) -> None:
    """Raise for steps that must look at the whole table before they can decide."""
    if df.isStreaming or _inside_stream.get():
        raise ValueError(f"{step} needs statistics of the whole table and cannot run on a stream")


def quoted(name: str) -> str:
    """Column name for ``F.col`` that may hold dots, blanks or backticks."""
    return "`" + name.replace("`", "``") + "`"
