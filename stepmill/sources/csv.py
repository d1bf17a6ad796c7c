"""CSV files with headers, read by column name, with inferred types and the usual null tokens."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stepmill.operators.columns import strict_cast
from stepmill.sources.typing import null_tokens, typed, vote
from stepmill.sources.union import union_tree

_CORRUPT = "__corrupt"
# A cell and the comma before it: quoted, or up to the next comma.
_CELL = r'(?:^|,)(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|(?!")[^,]*+)'


def unique_header(names: Sequence[str | None]) -> list[str]:
    """Header cells to column names: a repeated ``a`` becomes ``a.1``, a blank one ``Unnamed: i``."""
    out: list[str] = []
    seen: dict[str, int] = {}
    taken = {n for n in names if n}
    for i, raw in enumerate(names):
        base = raw if raw else f"Unnamed: {i}"
        name, n = base, seen.get(base, 0)
        while name in out or (n and name in taken and name != base):
            n += 1
            name = f"{base}.{n}"
        seen[base] = n
        out.append(name)
    return out


class Part(NamedTuple):
    """Files that are read alike: one header, with or without line breaks inside quotes."""

    names: tuple[str, ...]
    multi_line: bool
    paths: list[str]


def file_parts(spark: SparkSession, file_path: str, multi_line: bool | None = None) -> list[Part]:
    """The files behind a path, grouped by header and by whether some cell goes on in the next line.

    One pass over the lines, which returns a row for each file: its first line, and whether a line has
    an odd number of quotes. With ``multi_line`` given only the first split of each file is read.
    """
    try:
        lines = spark.read.text(file_path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"there is no file at {file_path}") from error
        raise
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    placed = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), place.alias("place"), (quotes % 2 == 1).alias("odd"))
    if multi_line is not None:
        placed = placed.filter("start = 0")
    found = (
        placed.groupBy("file")
        .agg(F.min_by(F.struct("value", "odd"), F.when(F.trim("value") != "", F.col("place"))).alias("first"), F.max("odd").alias("odd"))
        .filter("first.value IS NOT NULL")
        .orderBy("file")
        .collect()
    )
    parts: dict[tuple, list[str]] = {}
    for row in found:
        multi = row["odd"] if multi_line is None else multi_line
        path = re.sub(r"([\\{}\[\]*?,])", r"\\\1", unquote(row["file"]))
        if multi and row["first"]["odd"]:  # the header itself goes on in the next line
            cells = list(_reader(spark, True).csv(path, header=False).first())
        else:
            cells = next(csv.reader([row["first"]["value"].removeprefix("﻿")]))
        parts.setdefault((tuple(unique_header(cells)), multi), []).append(path)
    return [Part(names, multi, paths) for (names, multi), paths in parts.items()]


def _reader(spark: SparkSession, multi_line: bool):
    return spark.read.options(quote='"', escape='"', multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT)


def _cells(spark: SparkSession, part: Part, names: Sequence[str], whole: str | None) -> tuple[DataFrame, Column]:
    """Cells of the wanted columns as ``c0``, ``c1``, ... (null where the files lack one), and what says that a row is too long.

    Spark marks rows with too few and too many cells alike; only those are counted.
    """
    place = {name: i for i, name in enumerate(part.names)}
    fields = [T.StructField(f"p{i}", T.StringType()) for i in range(len(place))]
    rows = _reader(spark, part.multi_line).schema(T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])).csv(whole or part.paths, header=True)
    # Read with fewer columns the rows would be cut to those before they are counted, so the mark names them all.
    every = F.length(F.concat_ws("", *[f.name for f in fields])) >= 0
    marked = F.col(_CORRUPT).isNotNull() & (F.regexp_count(F.col(_CORRUPT), F.lit(_CELL)) > len(place)) & every
    cells = [null_tokens(F.col(f"p{place[n]}")).alias(f"c{i}") if n in place else F.lit(None).cast("string").alias(f"c{i}") for i, n in enumerate(names)]
    return rows.select(*cells, F.when(marked, F.col(_CORRUPT)).alias(_CORRUPT)), F.col(_CORRUPT)


def extract_csv(
    spark: SparkSession,
    file_path: str,
    *,
    schema: T.StructType | str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read a CSV file, or a folder of CSV files, by the names in each file's own header.

    Files may have their columns in any order, and a file that lacks a column of another one has nulls
    there. Types are voted over all values: bigint, double or boolean if every value fits, else text;
    dates stay text. Give ``schema`` to skip the vote (one pass over the data): its columns are looked up
    by name, others are left out, and one that no file has is an error. A row with more cells than
    its file's header is an error, whatever the cells hold; missing cells are null.

    Files without line breaks inside quotes are read in splits, the others whole, file by file; whether there
    are any is looked up with the headers unless ``multi_line`` says so.
    """
    parts = file_parts(spark, file_path, multi_line)
    if not parts:
        raise ValueError(f"no columns to read in {file_path}")
    present = list(dict.fromkeys(name for part in parts for name in part.names))
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = present if wanted is None else wanted.fieldNames()
    missing = [n for n in names if n not in present]
    if missing:
        raise ValueError(f"columns not found in {file_path}: {missing}; headers have {present}")
    # One kind of file: the path itself, not a list of all its files.
    read = [_cells(spark, part, names, file_path if len(parts) == 1 else None) for part in parts]
    table, too_long = union_tree([rows for rows, _ in read]), read[0][1]
    inner = [f"c{i}" for i in range(len(names))]
    if wanted is not None:
        message = F.concat(F.lit(f"more cells than the header in {file_path}: "), too_long)
        sound = table.filter(F.when(too_long.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        return sound.select(*[strict_cast(F.col(c), f.dataType.simpleString(), f.name).alias(f.name) for c, f in zip(inner, wanted.fields, strict=True)])
    types, (long_rows,) = vote(table, inner, F.count(too_long))
    if long_rows:
        raise ValueError(f"{long_rows} rows of {file_path} have more cells than the header")
    return table.select(*typed(types)).toDF(*names)
