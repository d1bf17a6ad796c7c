"""Sharding by minimax contiguous partition of ordered atomic groups.

Rows with equal texts form a group that is never parted. Groups stand in the order of their text's digest,
which is as good as random and the same in every run. Over their running sizes the smallest capacity is
sought with which a greedy walk needs no more than the given number of shards. Beneath that capacity the cuts
are balanced: a group larger than an even share has a shard of its own, and what lies between such groups is cut
evenly over the other shards.

The walk needs only group ends close to a cut, so the driver never sees all groups. It looks at the ends
through bins (the largest end in each of some thousand bins), which bounds the capacity and with it
where each cut can lie, then at finer bins in these windows alone, until the windows' own ends are few.
Each look is one aggregation; what comes to the driver is bounded by ``bins`` (some tens times the square of the
number of shards) whatever the table holds.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepmill.llm.common import fresh, text_key, text_of, with_position
from stepmill.session import materialise, quoted


def walk(ends: list[int], capacity: int, total: int, shards: int) -> list[int] | None:
    """Greedy cuts among sorted ``ends`` with at most ``capacity`` a shard; None if the shards don't suffice."""
    cuts, at = [], 0
    for _ in range(shards - 1):
        if total - at <= capacity:
            return cuts
        place = bisect_right(ends, at + capacity)
        if place and ends[place - 1] > at:
            at = ends[place - 1]
        cuts.append(at)
    return cuts if total - at <= capacity else None


def smallest_capacity(ends: list[int], low: int, high: int, total: int, shards: int) -> int:
    """The smallest feasible capacity in [low, high]; ``high`` must be feasible."""
    while low < high:
        middle = (low + high) // 2
        if walk(ends, middle, total, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def minimax_cuts(groups: DataFrame, size: str, end: str, shards: int, bins: int = 1 << 14, few: int = 1 << 16) -> list[int]:
    """The running sizes after which the smallest-capacity walk cuts. ``end`` is the running sum of ``size``."""
    total, largest = groups.agg(F.max(end), F.max(size)).first()
    if total is None:
        return []
    low, high = max(largest, -(-total // shards)), total
    windows = [(0, total)]
    while True:
        span = sum(b - a for a, b in windows)
        width = max(1, -(-span // bins))
        inside = F.lit(False)
        for a, b in windows:
            inside = inside | F.col(end).between(a, b)
        seen = groups.filter(inside)
        looked = seen.groupBy(F.floor(F.col(end) / F.lit(width)).alias("bin")).agg(F.max(end).alias("end"), F.count("*").alias("n")).collect()
        ends = sorted(r["end"] for r in looked)
        count = sum(r["n"] for r in looked)
        # Any subset of the ends proves capacities feasible; more ends only make a walk go further.
        high = smallest_capacity(ends, low, high, total, shards) if walk(ends, high, total, shards) is not None else high
        if width == 1 or count == len(ends):
            return walk(ends, high, total, shards)
        if count <= few:
            ends = sorted(r["end"] for r in seen.select(F.col(end).alias("end")).distinct().collect())
            return walk(ends, smallest_capacity(ends, low, high, total, shards), total, shards)
        # Cut i lies beyond the walk with the lower capacity over the coarse ends, and not beyond i capacities.
        at, windows = 0, []
        for i in range(1, shards):
            place = bisect_right(ends, at + low)
            at = max(at, ends[place - 1] if place else 0)
            windows.append((at, min(total, i * high)))
        windows = _joined(windows)
        if 2 * sum(b - a for a, b in windows) > span:  # windows widen with each cut, so bins go with the shards' square
            bins *= 4


def ideal_cuts(large: list[tuple[int, int]], total: int, shards: int) -> list[int]:
    """Even places to cut: around each oversized group of ``large`` (size, end), and evenly in the runs between."""
    large, rest, alone = sorted(large, reverse=True), total, 0
    while alone < min(len(large), shards - 1) and large[alone][0] * (shards - alone) > rest:
        rest -= large[alone][0]
        alone += 1
    while True:
        runs, at = [], 0
        for size, end in sorted(large[:alone], key=lambda g: g[1]):
            runs.append((at, end - size))
            at = end
        runs.append((at, total))
        runs = [(a, b) for a, b in runs if a < b]
        if len(runs) + alone <= shards:
            break
        alone -= 1  # more runs than shards: the smallest oversized group shares
    parts = [1] * len(runs)
    for _ in range(shards - alone - len(runs) if runs else 0):
        most = max(range(len(runs)), key=lambda j: (runs[j][1] - runs[j][0]) / parts[j])
        parts[most] += 1
    places = {a + (b - a) * i // n for (a, b), n in zip(runs, parts, strict=True) for i in range(n + 1)}
    places |= {place for size, end in large[:alone] for place in (end - size, end)}
    return sorted(places - {0, total})


def balanced_cuts(groups: DataFrame, size: str, end: str, shards: int) -> list[int]:
    """Cuts with the capacity of ``minimax_cuts``, each as near to its even place as that capacity allows."""
    greedy = minimax_cuts(groups, size, end, shards)
    total = groups.agg(F.max(end)).first()[0]
    if total is None or shards == 1:
        return []
    capacity = max(b - a for a, b in zip([0, *greedy], [*greedy, total], strict=True))
    large = [(r[0], r[1]) for r in groups.select(size, end).orderBy(F.desc(size), end).limit(shards).collect()]
    ideal = ideal_cuts(large, total, shards)

    def around(places: list[int]) -> list[tuple[int, int]]:
        """For each place the last end up to it (or 0), and the first one from it on."""
        sides = [c for p in places for c in (F.max(F.when(F.col(end) <= p, F.col(end))), F.min(F.when(F.col(end) >= p, F.col(end))))]
        found = groups.agg(*sides).first()
        return [(found[2 * i] or 0, found[2 * i + 1] or total) for i in range(len(places))]

    # From each of these on, the remaining shards suffice: the same walk from the other end.
    turned = groups.select(F.col(size).alias("size"), (F.lit(total) - F.col(end) + F.col(size)).alias("end"))
    least = [total - cut for cut in minimax_cuts(turned, "size", "end", shards)]
    least += [0] * (len(ideal) - len(least))
    cuts, at = [], 0
    for place, low, sides in zip(ideal, reversed(least), around(ideal) if ideal else [], strict=True):
        fit = [e for e in (*sides, low) if max(low, at + 1) <= e <= at + capacity and e < total]
        if not fit and at < low:  # fewer places than shards may not do
            return greedy
        if not fit:  # the place lies too far: as far as the capacity goes
            fit = [e for e in around([at + capacity])[0][:1] if at < e < total] if place > at + capacity else [at]
        at = min(fit or [at], key=lambda e: abs(e - place))
        cuts.append(at)
    return cuts


def _joined(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def sharded(docs: DataFrame, shards: int, *, key: str = "doc_id", text: str = "text", overhead: int = 16, keep_text: bool = True) -> DataFrame:
    """All rows with ``size`` (bytes of the text plus ``overhead``), ``shard`` and ``slot`` (gapless from 0 in a shard).

    Rows of equal texts share a shard, so one text's copies bound how even shards can be; null is a group apart
    from the empty text, of the same size. With fewer groups than shards some shards stay empty. Slots
    go by group, then ``key``; ties and repeated rows in any order. An empty table gives no rows. Without
    ``keep_text`` the text is read for its digest and size only and doesn't travel.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    added = ["size", "shard", "slot"]
    docs = docs.select(*[quoted(c) for c in docs.columns if c.lower() not in added])
    group, row, of, all_, at, end, first = (fresh(docs, n) for n in ("_group", "_row", "_of", "_all", "_at", "_end", "_first"))
    bytes_ = F.octet_length(text_of(text)).cast("long") + overhead
    marked = docs.withColumns({group: _group(text), "size": bytes_})
    if not keep_text:
        marked, docs = marked.drop(text), docs.drop(text)
    groups = marked.groupBy(group).agg(F.sum("size").alias(all_))
    ordered = materialise(with_position(groups, [F.col(group)], at, {end: all_}).select(F.col(group).alias(of), all_, end), "groups")
    cuts = balanced_cuts(ordered, all_, end, shards)
    shard = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c < F.col(end))) if cuts else F.lit(0)
    placed = marked.join(ordered.select(of, shard.cast("int").alias("shard")), F.col(group) == F.col(of)).drop(of)
    numbered = with_position(placed, [F.col("shard"), F.col(group), F.col(quoted(key)).asc_nulls_last()], row)
    starts = numbered.groupBy(F.col("shard").alias(of)).agg(F.min(row).alias(first))  # a row a shard
    return (
        numbered.join(F.broadcast(starts), F.col("shard") == F.col(of))
        .withColumn("slot", F.col(row) - F.col(first))
        .select(*[quoted(c) for c in docs.columns], *added)
    )


def _group(text: str) -> Column:
    """Digest of the text; null has one of its own length."""
    return F.when(F.col(quoted(text)).isNull(), F.unhex(F.lit("00"))).otherwise(text_key(text_of(text)))
