"""Paged sources: an ordered remote row list that is pulled page by page, one partition per run of pages.

Pages are fetched on the executors and landed once as text cells in the shared folder, so that the
type vote does not fetch them again. A task streams its run: one page is in memory at a time.
"""

from __future__ import annotations

import csv
import io
import json
import re
import time
import uuid
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stepmill.session import materialise, quoted
from stepmill.sources.csv import unique_header
from stepmill.sources.typing import null_tokens, typed, vote

#: Fetches ``records[offset : offset + limit]`` as CSV text with a header.
PageFetcher = Callable[[int, int], str]

# Cells by place; ``shape`` tells whose header names them. A page's header is a row of its own, at position -1.
_ROWS_SCHEMA = "page int, row_pos int, shape bigint, cells array<string>"
_ARROW_ROWS = pa.schema([
    ("page", pa.int32()),
    ("row_pos", pa.int32()),
    ("shape", pa.int64()),
    ("cells", pa.list_(pa.string())),
])
#: Runs of pages for each core, where the source sets no bound.
RUNS_PER_CORE = 4


@dataclass(frozen=True)
class PullSettings:
    """The contract of a paged pull, checked on the driver before any task starts."""

    data_source_url: str
    offset: int = 0
    seed_limit: int = 100_000
    chunk_limit: int = 1_000
    concurrent_batch_limit: int = 25
    sleep_dur: float = 1.0

    def __post_init__(self) -> None:
        rules = [
            (self.data_source_url.endswith(".csv"), "data_source_url must end in .csv"),
            (self.seed_limit > 0, "seed_limit must be above 0"),
            (0 < self.chunk_limit <= 1_000, "chunk_limit must be from 1 to 1000"),
            (self.chunk_limit <= self.seed_limit, "chunk_limit must not exceed seed_limit"),
            (0 < self.concurrent_batch_limit <= 50, "concurrent_batch_limit must be from 1 to 50"),
            (1.0 <= self.sleep_dur <= 10.0, "sleep_dur must be from 1.0 to 10.0"),
        ]
        broken = [message for holds, message in rules if not holds]
        if broken:
            raise ValueError("; ".join(broken))

    @property
    def offsets(self) -> range:
        return range(self.offset, self.offset + self.seed_limit, self.chunk_limit)


class HttpPages:
    """Pages of an open-data API that takes ``$limit`` and ``$offset``.

    A task rests before every page, so a pull makes at most ``concurrent_batch_limit`` requests per
    pause.
    """

    def __init__(self, url: str, pause: float = 1.0) -> None:
        self.url, self.pause = url, pause

    def __call__(self, offset: int, limit: int) -> str:
        time.sleep(self.pause)
        query = urlencode({"$limit": limit, "$offset": offset}, safe="$")
        request = Request(f"{self.url}?{query}", headers={"Accept": "text/csv"})
        with urlopen(request, timeout=60) as response:  # any HTTP error fails the task
            return response.read().decode("utf-8")


class PageFolder:
    """Pages exported to ``<root>/offset=<n>/*.csv`` on any file system all executors reach.

    Answers records ``offset`` up to ``offset + limit`` whatever the size of the exported pages was: the files
    that overlap the range are opened and cut. Beyond the last record there are no rows; a page missing
    before it is an error. The export must be complete (it has a ``_SUCCESS`` mark).
    """

    def __init__(self, root: str) -> None:
        self.root = root
        self.starts: list[int] | None = None

    def __call__(self, offset: int, limit: int) -> str:
        system, root = fs.FileSystem.from_uri(self.root if "://" in self.root or self.root.startswith("file:") else f"file://{self.root}")
        if self.starts is None:
            if system.get_file_info(f"{root}/_SUCCESS").type == fs.FileType.NotFound:
                raise FileNotFoundError(f"{self.root} is not a complete export")
            found = (re.fullmatch(r"offset=(\d+)", info.base_name) for info in system.get_file_info(fs.FileSelector(root)))
            self.starts = sorted(int(m[1]) for m in found if m)
        first = max(0, bisect_right(self.starts, offset) - 1)
        out, expected = io.StringIO(newline=""), None
        writer = csv.writer(out)
        for start in self.starts[first:]:
            if expected is None and offset < start < offset + limit or expected not in (None, start):
                raise FileNotFoundError(f"{self.root} lacks the page before record {start}")
            if start >= offset + limit:
                break
            header, rows = self._page(system, root, start)
            if expected is None:
                writer.writerow(header)
            writer.writerows(rows[max(0, offset - start) : offset + limit - start])
            expected = start + len(rows)
            if expected >= offset + limit:
                break
        return out.getvalue()

    def _page(self, system: fs.FileSystem, root: str, start: int) -> tuple[list[str], list[list[str]]]:
        texts = []
        for info in sorted(system.get_file_info(fs.FileSelector(f"{root}/offset={start}")), key=lambda i: i.path):
            if info.path.endswith(".csv"):
                with system.open_input_stream(info.path) as stream:
                    texts.append(stream.read().decode("utf-8"))
        if len(texts) != 1:
            raise ValueError(f"page {start} of {self.root} is spread over {len(texts)} files")
        rows = [row for row in csv.reader(io.StringIO(texts[0], newline="")) if row]
        return (rows[0], rows[1:]) if rows else ([], [])


@dataclass
class _Run(InputPartition):
    """Consecutive pages, from ``first`` up to ``end``."""

    first: int
    end: int


def page_runs(pages: int, most: int) -> list[_Run]:
    """All pages in at most ``most`` runs of even length."""
    count = min(pages, most)
    cuts = [pages * i // count for i in range(count + 1)]
    return [_Run(first, end) for first, end in zip(cuts, cuts[1:], strict=False)]


def page_rows(text: str, page: int) -> Iterator[tuple[int, int, int, list[str | None]]]:
    """(page, row position, shape, cells) of one CSV page; position -1 is the header itself."""
    reader = csv.reader(io.StringIO(text, newline=""))
    header = next(reader, None)
    if header is None:
        return
    names = unique_header(header)
    shape = int.from_bytes(blake2b(json.dumps(names).encode(), digest_size=8).digest(), "big", signed=True)
    yield page, -1, shape, names
    position = 0
    for row in reader:
        if not row:
            continue  # blank line
        if len(row) > len(names):
            raise ValueError(f"page {page}, row {position} has more cells than the header")
        yield page, position, shape, row
        position += 1


def paged_csv_source(fetch: PageFetcher, settings: PullSettings, runs: int, name: str = "stepmill_pages") -> type[DataSource]:
    """A data source class whose partitions are at most ``runs`` runs of the pull's pages, fetched by ``fetch``."""

    class Reader(DataSourceReader):
        def partitions(self):
            return page_runs(len(settings.offsets), runs)

        def read(self, partition):
            for page in range(partition.first, partition.end):
                rows = list(page_rows(fetch(settings.offsets[page], settings.chunk_limit), page))
                if rows:
                    columns = [pa.array(values, type=f.type) for values, f in zip(zip(*rows, strict=True), _ARROW_ROWS, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=_ARROW_ROWS)

    class PagedCsv(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return _ROWS_SCHEMA

        def reader(self, schema):
            return Reader()

    return PagedCsv


def extract_paged_csv(
    spark: SparkSession,
    *,
    data_source_url: str,
    offset: int = 0,
    seed_limit: int = 100_000,
    chunk_limit: int = 1_000,
    concurrent_batch_limit: int = 25,
    sleep_dur: float = 1.0,
    fetch: PageFetcher | None = None,
    keep_position: bool = False,
) -> DataFrame:
    """Pull pages and unite them: columns in order of first appearance, types merged over pages.

    Every page asks for ``chunk_limit`` rows, the last one too. ``fetch`` defaults to
    :class:`HttpPages` for http URLs and :class:`PageFolder` for others. At most
    ``concurrent_batch_limit`` pages are fetched at the same time, but for a folder, which the whole cluster
    may read. ``keep_position`` adds ``page`` and ``row_pos``, which order the rows as the source had them.
    """
    settings = PullSettings(
        data_source_url, offset, seed_limit, chunk_limit, concurrent_batch_limit, sleep_dur
    )
    if fetch is None:
        remote = data_source_url.startswith(("http://", "https://"))
        fetch = HttpPages(data_source_url, sleep_dur) if remote else PageFolder(_qualified(spark, data_source_url))
    runs = RUNS_PER_CORE * spark.sparkContext.defaultParallelism if isinstance(fetch, PageFolder) else concurrent_batch_limit
    source = paged_csv_source(fetch, settings, runs, f"stepmill_pages_{uuid.uuid4().hex}")
    spark.dataSource.register(source)
    landed = materialise(spark.read.format(source.name()).load(), "pages")

    # One row per distinct header.
    shapes = landed.filter("row_pos = -1").groupBy("shape").agg(F.min_by("cells", "page").alias("names"), F.min("page").alias("page")).orderBy("page").collect()
    names = list(dict.fromkeys(name for row in shapes for name in row["names"]))
    if not names:
        raise ValueError(f"no columns to read in {data_source_url}")

    position = ["page", "row_pos"] if keep_position else []
    clash = set(position) & set(names)
    if clash:
        raise ValueError(f"keep_position would hide the columns {sorted(clash)}")

    def cell(name: str) -> Column:
        """The cell under this name, wherever the row's own header has it."""
        places: dict[int, list[int]] = {}
        for row in shapes:
            if name in row["names"]:
                places.setdefault(row["names"].index(name), []).append(row["shape"])
        found = [F.when(F.col("shape").isin(of), F.get("cells", F.lit(at))) for at, of in places.items()]
        return F.get("cells", F.lit(next(iter(places)))) if len(shapes) == 1 else F.coalesce(*found)

    rows = landed.filter("row_pos >= 0")
    cells = rows.select(*position, *[null_tokens(cell(name)).alias(name) for name in names])
    types, _ = vote(cells, names)
    return cells.select(*[quoted(c) for c in position], *typed(types))


def _qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme: without one Spark means its default file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(hadoop).toString().replace("file:/", "file:///", 1)


def extract_paged_csv_lite(spark: SparkSession, *, data_source_url: str, limit: int = 1_000, **options) -> DataFrame:
    """One page of at most 1,000 rows."""
    return extract_paged_csv(
        spark,
        data_source_url=data_source_url,
        seed_limit=limit,
        chunk_limit=limit,
        concurrent_batch_limit=1,
        **options,
    )


def export_pages(df: DataFrame, root: str) -> None:
    """Write a table with columns ``offset`` and ``row_pos`` as one CSV file per page."""
    (
        df.repartition("offset")
        .sortWithinPartitions("offset", "row_pos")
        .drop("row_pos")
        .write.partitionBy("offset")
        .options(header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(root)
    )
