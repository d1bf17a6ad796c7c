"""Periodic runs of words, by recompression.

A run is a longest stretch of words with a smallest period ``q`` that goes through at least ``power`` periods.
The words of a batch of documents become numbers, with a number of its own before, between and after the
documents. That string is recompressed: block compression turns each stretch of one symbol into a symbol,
pair compression halves the alphabet and turns each left symbol followed by a right one into a symbol,
in turns, until one symbol is left. Equal symbols of a level stand for equal words, and equal words are
cut alike except at their ends. So a longest common extension of two places climbs the levels, at most
one step to the side in each, until two symbols differ, and goes down again to the words that differ.

A run of ``power`` periods ``q`` covers a place on the grid of every ``(power - 1) * q`` words together with the place
``q`` words on. So those places of all harmonic grids whose two words agree are the candidates, and their
extensions both ways are the runs, to the word. Documents are independent: no shuffle, and a task holds
one batch of words (or one longer document).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmill.llm.common import text_of
from stepmill.session import quoted

#: Words compressed together, and extensions followed at once.
BATCH, ASKED = 1 << 18, 1 << 20


@dataclass
class Level:
    """The symbols of a level; ``up`` is the place of each one's symbol on the next level, ``first`` that of its first part below."""

    symbols: np.ndarray
    blocks: bool = False
    up: np.ndarray | None = None
    first: np.ndarray | None = None


def _sides(symbols: np.ndarray, turn: int) -> np.ndarray:
    """Left (True) or right for every symbol, another half of the alphabet each turn."""
    mixed = symbols.astype(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    mixed = (mixed ^ mixed >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(40) & np.uint64(1)).astype(bool)


def recompressed(symbols: np.ndarray) -> list[Level]:
    """The grammar's levels, from the string itself to a single symbol."""
    levels, named, turn = [Level(np.asarray(symbols, np.int64))], int(symbols.max(initial=0)) + 1, 0

    def lift(starts: np.ndarray, compressed: np.ndarray, names: np.ndarray, blocks: bool) -> None:
        below = levels[-1]
        mark = np.zeros(len(below.symbols), np.int32)
        mark[starts] = 1
        below.up, below.blocks = np.cumsum(mark, dtype=np.int32) - 1, blocks
        above = below.symbols[starts]
        above[compressed] = names
        levels.append(Level(above, first=starts.astype(np.int32)))

    while len(levels[-1].symbols) > 1:
        now = levels[-1].symbols
        starts = np.flatnonzero(np.r_[True, now[1:] != now[:-1]])
        if len(starts) < len(now):
            sizes = np.diff(np.r_[starts, len(now)])
            long = np.flatnonzero(sizes > 1)
            # A pair of numbers below 2^31 each: the string and its alphabet are that short.
            kinds, names = np.unique(now[starts[long]] << 32 | sizes[long], return_inverse=True)
            lift(starts, long, names + named, True)
            named += len(kinds)
            continue
        left = _sides(now, turn)
        turn += 1
        ahead, behind = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        pairs = np.flatnonzero(ahead if np.count_nonzero(ahead) >= np.count_nonzero(behind) else behind)
        if not len(pairs):
            continue
        kinds, names = np.unique(now[pairs] << 32 | now[pairs + 1], return_inverse=True)
        kept = np.ones(len(now), bool)
        kept[pairs + 1] = False
        starts = np.flatnonzero(kept)
        lift(starts, np.searchsorted(starts, pairs), names + named, False)
        named += len(kinds)
    return levels


def mirrored(levels: list[Level]) -> list[Level]:
    """The same levels read from the other end."""
    out = []
    for k, level in enumerate(levels):
        turned = Level(level.symbols[::-1], level.blocks)
        if level.up is not None:
            turned.up = level.up[-1] - level.up[::-1]
        if level.first is not None:
            below = len(levels[k - 1].symbols)
            turned.first = below - np.r_[level.first[1:], below][::-1].astype(np.int32)
        out.append(turned)
    return out


def extension(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols agree from the places ``x`` and ``y`` on (``x`` is never ``y``); the last symbol must be unlike all others."""

    def left_of(k: int, at: np.ndarray) -> np.ndarray | int:
        """Symbols from ``at`` to the end of its block."""
        level, above = levels[k], levels[k + 1]
        if not level.blocks:
            return 1
        parent = level.up[at] + 1
        return np.where(parent < len(above.first), above.first[np.minimum(parent, len(above.first) - 1)], len(level.symbols)) - at

    begun, ends = x, np.empty(len(x), np.int64)
    x, y, who = x.astype(np.int64), y.astype(np.int64), np.arange(len(x))
    stopped = []
    for k, level in enumerate(levels):
        same = level.symbols[x] == level.symbols[y]
        stopped.append((x[~same], y[~same], who[~same]))
        x, y, who = x[same], y[same], who[same]
        if not len(x):
            break
        above = levels[k + 1]
        inside = (above.first[level.up[x]] != x) | (above.first[level.up[y]] != y)
        step = np.where(inside, np.minimum(left_of(k, x), left_of(k, y)), 0)
        x, y = x + step, y + step
        # Blocks of unequal rests: one ends here and the other doesn't.
        apart = (above.first[level.up[x]] != x) | (above.first[level.up[y]] != y)
        stopped[-1] = tuple(np.concatenate(p) for p in zip(stopped[-1], (x[apart], y[apart], who[apart]), strict=True))
        x, y, who = (level.up[x[~apart]].astype(np.int64), level.up[y[~apart]].astype(np.int64), who[~apart])
    x, y, who = (np.zeros(0, np.int64) for _ in range(3))
    for k in range(len(stopped) - 1, -1, -1):
        if len(x):
            # The symbols above differ: so do these, or those behind an equal beginning.
            x, y = levels[k + 1].first[x].astype(np.int64), levels[k + 1].first[y].astype(np.int64)
            same = levels[k].symbols[x] == levels[k].symbols[y]
            step = np.where(same, np.minimum(left_of(k, x), left_of(k, y)), 0)
            x, y = x + step, y + step
        x, y, who = (np.concatenate(p) for p in zip((x, y, who), stopped[k], strict=True))
    ends[who] = x
    return ends - begun


def runs_of(symbols: np.ndarray, longest: int, power: int = 4, least: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and smallest periods of all runs, by start and period.

    ``symbols`` begins and ends with symbols unlike all others, and has such symbols wherever no run may go
    across; no stretch between two of them is longer than ``longest``.
    """
    size, top = len(symbols), longest // power
    if top < 1:
        return (np.zeros(0, np.int64),) * 3
    levels = recompressed(symbols)
    backward = mirrored(levels)
    cover, of = np.full(size, -1, np.int64), np.zeros(0, np.int64)
    found: list[np.ndarray] = []
    low = 1
    while low <= top:
        # Periods low to high: doubling, but no more grid places than a task should hold.
        high = low
        while high < min(2 * low - 1, top) and (high - low + 2) * (size // ((power - 1) * low) + 1) <= ASKED:
            high += 1
        q = np.arange(low, high + 1)
        count = (size - q - 1) // ((power - 1) * q) + 1
        count = np.maximum(count, 0)
        q = np.repeat(q, count)
        at = (np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)) * (power - 1) * q
        agree = symbols[at] == symbols[at + q]
        at, q = at[agree], q[agree]
        if len(of) and len(at):
            # Within a known run of a period that divides this one only that run is found again.
            run = cover[at]
            known = (run >= 0) & (run == cover[at + q])
            known[known] = q[known] % of[run[known]] == 0
            at, q = at[~known], q[~known]
        if len(at):
            ends = at + q + extension(levels, at, at + q)
            starts = at - extension(backward, size - at, size - at - q)
            enough = ends - starts >= power * q
            new = np.unique(np.c_[starts[enough], ends[enough], q[enough]], axis=0)
            # A multiple of the smallest period gives the same stretch.
            new = new[np.r_[True, (new[1:, :2] != new[:-1, :2]).any(1)]] if len(new) else new
            for number, (start, end, _) in enumerate(new.tolist(), len(of)):
                cover[start:end] = number
            of = np.r_[of, new[:, 2]]
            found.append(new)
        low = high + 1
    every = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    if len(every):
        every = every[np.r_[True, (every[1:, :2] != every[:-1, :2]).any(1)]]
    every = every[every[:, 1] - every[:, 0] >= np.maximum(least, power * every[:, 2])]
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    return every[:, 0], every[:, 1], every[:, 2]


def _folded(texts: list[bytes], power: int, least: int) -> tuple[list[int], list[np.ndarray], list[bytes]]:
    """For each text its number of words, its runs [start, length, period], and the words kept, joined by blanks."""
    words = [t.split() for t in texts]  # bytes.split() knows the six blanks of ASCII, no others
    sizes = np.array([len(w) for w in words], np.int64)
    numbers: dict[bytes, int] = {}
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in words for w in ws), np.int64, int(sizes.sum()))
    # Document i has its words behind separator i; the last separator ends the string.
    begins = np.cumsum(sizes) - sizes + np.arange(len(sizes)) + 1
    symbols = np.empty(len(flat) + len(sizes) + 1, np.int64)
    separators = np.r_[begins - 1, len(symbols) - 1]
    plain = np.ones(len(symbols), bool)
    plain[separators] = False
    symbols[plain], symbols[separators] = flat, len(numbers) + np.arange(len(separators))
    starts, ends, periods = runs_of(symbols, int(sizes.max(initial=0)), power, least)
    owner = np.searchsorted(begins, starts, side="right") - 1
    edges = np.searchsorted(owner, np.arange(len(sizes) + 1))
    each, kept = [], []
    for i, text_words in enumerate(words):
        a, b = edges[i], edges[i + 1]
        own = np.c_[starts[a:b] - begins[i], ends[a:b] - starts[a:b], periods[a:b]]
        each.append(own)
        if b > a:
            stays = np.ones(len(text_words), bool)
            for start, length, period in own.tolist():
                stays[start + period : start + length] = False
            text_words = [text_words[j] for j in np.flatnonzero(stays)]
        kept.append(b" ".join(text_words))
    return sizes.tolist(), each, kept


def periodic_runs(docs: DataFrame, *, key: str = "doc_id", text: str = "text", power: int = 4, least: int = 6) -> DataFrame:
    """``key``, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed`` of every row.

    Words are stretches without ASCII blanks. A run has a length of at least ``least`` and ``power`` times its smallest
    period, and no neighbouring word goes on with it. ``collapsed`` holds the words that are in no run behind its
    first period, joined by one blank. A null or wordless text has no words, no runs and an empty
    ``collapsed``. Null keys and repeated rows all come back; other columns of ``docs`` play no part.
    """
    if power < 2 or least < 1:
        raise ValueError("a run goes through its period at least twice")
    source = docs.select(F.col(quoted(key)).alias("key"), text_of(text).cast("binary").alias("text"))
    fields = [("key", source.schema["key"].dataType.simpleString()), ("n_words", "bigint"), ("runs", "array<struct<start:bigint,length:bigint,period:bigint>>"), ("collapsed", "string")]

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            # About six bytes a word; a longer text is a batch of its own.
            sizes = np.array([len(column[i].as_buffer()) for i in range(len(column))], np.int64)
            group = np.cumsum(sizes) // (6 * BATCH)
            cuts = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), len(sizes)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                counts, runs, kept = _folded(column.slice(begin, end - begin).to_pylist(), power, least)
                offsets = pa.array(np.r_[0, np.cumsum([len(r) for r in runs])], pa.int32())
                rows = np.concatenate(runs)
                structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, structs), pa.array(kept, pa.binary()).view(pa.string())],
                    names=[name for name, _ in fields],
                )

    out = source.mapInArrow(described, ", ".join(f"{n} {t}" for n, t in fields))
    return out.withColumnRenamed("key", key)


def brute_runs(words: list, power: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """For tests: (start, length, period) of all runs, by comparing words for every period."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // power + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end + q - at >= power * q:
                found.setdefault((at, end + q), q)
            at = max(end, at + 1) if end == at else end + 1
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, power * q))
