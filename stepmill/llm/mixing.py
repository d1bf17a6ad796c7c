"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of rows. With share ``s`` of the total ``S``, its block ``j`` is released at slot
``floor(j * S / s)`` and due at ``ceil((j + 1) * S / s)``; in each slot the released block with the earliest
deadline goes (ties: by source). So in every prefix each source has its share of blocks to less than one
block. The schedule repeats after ``S`` slots, so only one period is worked out, from the shares alone; a
block's slot is ``(j div s) * S`` plus the slot of ``j mod s`` in the period, a lookup in a table of ``S`` rows.

When a source has no more rows its slots are passed over and the others go on; nothing is dropped or
repeated. Until the first source ends, the deviation bound holds.

Everything on rows is DataFrame operations. Rows are numbered in their sources by a range sort over the
cluster, so a source with a third of all rows is many partitions.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepmill.llm.common import fresh, with_position
from stepmill.session import quoted

#: The period's table is broadcast; this many slots are some megabytes.
MAX_PERIOD = 200_000


def period(shares: list[int]) -> list[tuple[int, int]]:
    """Earliest deadline first over one period: (source, block) of each slot, by the sources' places."""
    total = sum(shares)
    if total > MAX_PERIOD:
        raise ValueError(f"shares add up to {total}; use smaller whole numbers (at most {MAX_PERIOD} in all)")
    released: list[list[int]] = [[] for _ in range(total)]
    for source, share in enumerate(shares):
        for block in range(share):
            released[block * total // share].append(source)
    done, ready, slots = [0] * len(shares), [], []
    waiting = [0] * len(shares)
    for now in range(total):
        for source in released[now]:
            waiting[source] += 1
            if waiting[source] == 1:
                heapq.heappush(ready, (-(-(done[source] + 1) * total // shares[source]), source))
        _, source = heapq.heappop(ready)
        slots.append((source, done[source]))
        done[source] += 1
        waiting[source] -= 1
        if waiting[source]:
            heapq.heappush(ready, (-(-(done[source] + 1) * total // shares[source]), source))
    return slots


def _table(spark: SparkSession, names: list[str | None], shares: list[int]) -> DataFrame:
    """The period as rows: source, share, block in the period, slot. It enters the plan as one literal."""
    rows = [{"of_source": names[s], "share": shares[s], "turn": b, "at": at} for at, (s, b) in enumerate(period(shares))]
    kind = "array<struct<of_source: string, share: bigint, turn: bigint, at: bigint>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))


def mixed(
    docs: DataFrame, shares: Mapping[str | None, int], *, source: str = "source", order: str = "doc_id", block_rows: int = 16, default: int = 1,
    names: tuple[str, str, str] = ("block", "slot", "position"),
) -> DataFrame:
    """All rows with ``block``, ``slot`` and ``position`` (gapless from 0, the order of the mix), under ``names``.

    ``shares`` are whole numbers by source, ``default`` for sources not named (null is a source of its own).
    Within a source rows go by ``order`` (nulls last; ties and repeated rows one after another, in any
    order). Existing columns of the three names are replaced, all others stay. An empty table gives no rows.
    """
    if default < 1 or any(s < 1 for s in shares.values()):
        raise ValueError("shares are positive whole numbers")
    block, slot, position = names
    docs = docs.select(*[quoted(c) for c in docs.columns if c.lower() not in {n.lower() for n in names}])
    own = [quoted(c) for c in docs.columns]
    # The inner columns have names that no table's column has.
    name, row, of, first, within, kind, share = (fresh(docs, f"_mix_{n}") for n in ("source", "row", "of", "first", "in", "kind", "share"))
    by = [F.col(name).asc_nulls_first(), F.col(quoted(order)).asc_nulls_last()]
    placed = with_position(docs.withColumn(name, F.col(quoted(source)).cast("string")), by, row)
    starts = placed.groupBy(F.col(name).alias(of)).agg(F.min(row).alias(first))
    # One row a source: the weights' table, by contract a small one.
    found = [r[0] for r in starts.select(of).limit(MAX_PERIOD + 1).collect()]
    found.sort(key=lambda s: (s is not None, s or ""))
    total = sum(shares.get(s, default) for s in found)
    plan = _table(docs.sparkSession, found, [shares.get(s, default) for s in found])
    source_of, turn, at = (fresh(docs, f"_mix_plan_{n}") for n in ("source", "turn", "at"))
    plan = plan.select(F.col("of_source").alias(source_of), F.col("share").alias(share), F.col("turn").alias(turn), F.col("at").alias(at))
    kinds = plan.select(F.col(source_of).alias(kind), share).distinct()
    blocks = (
        placed.join(F.broadcast(starts), F.col(name).eqNullSafe(F.col(of)))
        .withColumn(within, F.col(row) - F.col(first))
        .withColumn(block, F.expr(f"{quoted(within)} div {block_rows}"))
        .join(F.broadcast(kinds), F.col(name).eqNullSafe(F.col(kind)))
    )
    slotted = blocks.join(
        F.broadcast(plan.drop(share)),
        F.col(name).eqNullSafe(F.col(source_of)) & (F.col(quoted(block)) % F.col(share) == F.col(turn)),
    )
    place = F.expr(f"{quoted(block)} div {quoted(share)}") * F.lit(total) + F.col(at)
    kept = slotted.select(*own, quoted(block), place.alias(slot), F.expr(f"{quoted(within)} % {block_rows}").alias(within))
    return with_position(kept, [F.col(quoted(slot)), F.col(within)], position).drop(within)


def in_mix_order(docs: DataFrame, shares: Mapping[str | None, int], **options) -> DataFrame:
    """The rows of ``docs``, columns unchanged, sorted in the order of the mix."""
    names = tuple(fresh(docs, f"_mix_{n}") for n in ("block", "slot", "position"))
    return mixed(docs, shares, names=names, **options).orderBy(names[2]).select(*[quoted(c) for c in docs.columns])
