"""Minimax contiguous sharding of atomic groups.

Groups (documents with equal text) are ordered by their smallest doc_id and never split; shards
are runs of consecutive groups. A binary search finds the smallest capacity with which a greedy
walk over the order needs no more shards than wanted. The cuts keep within that capacity and are
evened out, since the plain walk would leave all the slack to the last shards.
A group above the capacity gets a shard of its own, so one giant group does not set the capacity
for all the others; the largest shard is still as small as any contiguous partition allows.

The walk only needs the running sizes. They stay in a table; the driver searches a digest of at
most ``DIGEST`` blocks (first and last running size of each block of equal width), on which a
walk gives bounds for each cut, and refines just the blocks that leave a cut open, until none
does. The result is exact for any number of groups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, numbered, stored, text_or_empty

DIGEST = 1 << 16


@dataclass
class Known:
    """Group ends known so far. ``ends``: sorted, from 0 to the total; ``open[i]``: there may be
    more ends strictly between ``ends[i]`` and ``ends[i + 1]``."""

    ends: np.ndarray
    open: np.ndarray

    def step(self, at: int, capacity: int, upper: bool) -> int:
        """A bound of the end of the shard that begins behind ``at``: the last end within the
        capacity, or the next end if there is none."""
        e = self.ends
        limit = min(at + capacity, int(e[-1]))
        i = int(np.searchsorted(e, limit, "right")) - 1
        best = int(e[i])
        if upper:
            if i + 1 < len(e) and self.open[i]:
                best = max(best, limit)  # an unknown end may reach the limit
            if best <= at:
                best = int(e[np.searchsorted(e, at, "right")])
        elif best <= at:
            j = int(np.searchsorted(e, at, "right"))
            # the next known end is the next end, unless unknown ones may lie before it
            best = at if self.open[j - 1] else int(e[j])
        return best

    def walk(self, capacity: int, shards: int, upper: bool) -> list[int]:
        cuts, at = [], 0
        for _ in range(shards):
            if at < self.ends[-1]:
                at = self.step(at, capacity, upper)
            cuts.append(at)
        return cuts

    def smallest(self, shards: int, upper: bool) -> int:
        """The smallest capacity whose walk reaches the end (``upper``: may reach it)."""
        total = int(self.ends[-1])
        lo, hi = 1, max(1, total)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.walk(mid, shards, upper)[-1] >= total:
                hi = mid
            else:
                lo = mid + 1
        return lo


def _unsettled(known: Known, shards: int) -> list[tuple[int, int]]:
    """The open stretches (low, high) that some cut may lie in, merged where they touch."""
    low = known.walk(known.smallest(shards, True), shards, False)
    high = known.walk(known.smallest(shards, False), shards, True)
    e, spans = known.ends, []
    for a, b in zip(low, high, strict=True):
        i = max(0, int(np.searchsorted(e, a, "right")) - 1)
        j = int(np.searchsorted(e, b, "left"))
        for k in np.nonzero(known.open[i:j])[0] + i:
            spans.append((int(e[k]), int(e[k + 1])))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _digest(ends: DataFrame, spans: list[tuple[int, int]], blocks: int):
    """First, last and number of the group ends of each block inside the spans."""
    width = max(1, -(-sum(b - a for a, b in spans) // blocks))
    inside = F.lit(False)
    for a, b in spans:
        inside = inside | ((F.col("end") > a) & (F.col("end") < b))
    return (ends.where(inside).groupBy(F.floor(F.col("end") / width).alias("block"))
            .agg(F.min("end").alias("a"), F.max("end").alias("b"), F.count("*").alias("n"))
            .select("a", "b", "n").toPandas())


def _refined(known: Known, spans: list[tuple[int, int]], rows) -> Known:
    """What is known after the blocks' first and last ends inside the spans have been added."""
    a, b, n = (rows[c].to_numpy(np.int64) for c in ("a", "b", "n"))
    ends = np.unique(np.concatenate([known.ends, a, b]))
    still = np.zeros(len(ends) - 1, bool)
    at = np.searchsorted(ends, known.ends)
    for i in np.nonzero(known.open)[0]:
        if not any(x <= known.ends[i] < y for x, y in spans):
            still[at[i]:at[i + 1]] = True
    wide = (n > 2) & (a < b)
    for i, j in zip(np.searchsorted(ends, a[wide]), np.searchsorted(ends, b[wide]), strict=True):
        still[i:j] = True
    return Known(ends, still)


def cut_points(ends: DataFrame, total: int, shards: int, digest: int = DIGEST) -> list[int]:
    """The running sizes at which the shards end. ``ends`` has the running size behind every group
    in ``end``; the driver holds at most a few times ``digest`` of them."""
    if total <= 0:
        return [0] * shards
    known = Known(np.array([0, total], np.int64), np.array([True]))
    spans = [(0, total)]
    while spans:
        known = _refined(known, spans, _digest(ends, spans, digest))
        digest *= 2
        spans = _unsettled(known, shards)
    capacity = known.smallest(shards, False)
    return evened(known, known.walk(capacity, shards, False), capacity)


def evened(known: Known, cuts: list[int], capacity: int) -> list[int]:
    """Cuts within the same capacity that do not leave the slack to the last shards.

    ``floor[j]`` is the earliest known end from which the later shards still reach the total; each
    cut is the known end nearest to an equal share of what is left, between that and the capacity.
    """
    e, n = known.ends, len(cuts)
    floor = [0] * n
    floor[-1] = int(e[-1])
    for j in range(n - 2, -1, -1):
        i = int(np.searchsorted(e, floor[j + 1] - capacity, "left"))
        if floor[j + 1] > 0 and e[i] >= floor[j + 1]:  # one group above the capacity
            i = int(np.searchsorted(e, floor[j + 1], "left")) - 1
            if known.open[i]:
                return cuts
        floor[j] = int(e[i])
    out, at = [], 0
    for j in range(n):
        last = known.step(at, capacity, False) if at < e[-1] else at
        want = at + (int(e[-1]) - at) / (n - j)
        i = int(np.searchsorted(e, want, "left"))
        near = [int(x) for x in e[max(0, i - 1):i + 1]]
        best = min(near, key=lambda x: abs(x - want))
        at = min(max(best, floor[j], at), max(last, floor[j]))
        out.append(at)
    return out


def shard(docs: DataFrame, shards: int = 24, digest: int = DIGEST) -> DataFrame:
    """Assign every document to a shard of nearly equal bytes.

    ``docs`` needs doc_id and text; other columns are ignored, whatever their names. Row by row
    returns doc_id, size (UTF-8 bytes of the text, NULL: none, plus 8), text_crc32, shard
    (0 to ``shards`` - 1; trailing shards are empty if there are fewer groups) and slot: the place
    in the shard, gapless from 0, in the order of the group's smallest doc_id, then doc_id.

    Equal texts share a shard; NULL texts count as empty ones. Repeated rows keep a slot each;
    NULL doc_id sorts first and is ignored in a group's smallest doc_id. An empty table gives an
    empty result.
    """
    text = text_or_empty()
    raw = F.encode(text, "utf-8")
    rows = stored(docs.select(
        F.col("doc_id"), F.substring(F.unhex(F.sha2(raw, 256)), 1, 16).alias("key"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")),
        "shard-rows")
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"),
                                     F.sum("size").alias("bytes"))
    placed = stored(numbered(groups, ["first", "key"], ["bytes"], "shard-groups"), "shard-places")
    total = placed.agg(F.sum("bytes").alias("t")).first()["t"] or 0
    cuts = cut_points(placed.select((F.col("bytes_before") + F.col("bytes")).alias("end")),
                      total, shards, digest)
    number = F.lit(0)
    for c in cuts[:-1]:
        number = number + (F.col("bytes_before") >= c).cast("int")
    target = placed.select("key", "first", "n", number.alias("shard"))
    full = join_groups(rows, target, "key", "n").drop("n").withColumn("one", F.lit(1).cast("long"))
    starts = target.groupBy("shard").agg(F.sum("n").alias("rows")).collect()  # a row a shard
    before, at = {}, 0
    for r in sorted(starts, key=lambda r: r["shard"]):
        before[r["shard"]], at = at, at + r["rows"]
    ordered = numbered(full.withColumn("tie", F.xxhash64("doc_id", "size", "text_crc32")),
                       ["shard", "first", "doc_id", "tie"], ["one"], "shard-slots")
    start = F.lit(0).cast("long")
    for s, n in before.items():
        start = F.when(F.col("shard") == s, F.lit(n)).otherwise(start)
    return ordered.select("doc_id", "size", "text_crc32", "shard",
                          (F.col("one_before") - start).cast("long").alias("slot"))
