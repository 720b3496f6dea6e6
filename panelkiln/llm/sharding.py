"""Minimax contiguous partition of documents into shards.

Equal texts form an atomic group. Groups stand in the order of a hash of their text; the smallest shard capacity is
found by binary search, with a greedy check, and the order is cut there. The order is never collected: the driver sees
sums over ranges of hashes and opens only the ranges in which a cut can fall, so it holds a bounded number of sums at
any size. A document finds its shard by comparing its hash with the cuts, without a join.

Defined results: a null text counts as empty. Rows with a null or repeated doc_id are documents like others. A group
larger than an even share sets the capacity. Empty tables give no rows; with fewer groups than shards the last shards
stay empty. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, settle


def _cuts(ends: np.ndarray, capacity: int, parts: int) -> list[int] | None:
    """Greedy cuts of atoms with these running totals (from 0), or None if parts of this capacity do not suffice."""
    at, cuts, last = 0, [], len(ends) - 1
    for _ in range(parts):
        to = int(np.searchsorted(ends, ends[at] + capacity, "right")) - 1
        if to >= last:
            return cuts
        if to == at:
            return None
        cuts.append(to)
        at = to
    return None


def _least(feasible, low: int, high: int) -> int:
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if feasible(mid) else (mid + 1, high)
    return low


def smallest_capacity(sizes, parts: int) -> tuple[int, list[int]]:
    """The least capacity with which consecutive positive sizes fit into parts, and the first entries of parts 1, 2, ..."""
    ends = np.append(0, np.cumsum(np.asarray(sizes, np.int64)))
    best = _least(lambda c: _cuts(ends, c, parts) is not None, max(1, -(-int(ends[-1]) // parts)), max(1, int(ends[-1])))
    return best, _cuts(ends, best, parts)


def _loose(ends: np.ndarray, single: np.ndarray, capacity: int, parts: int) -> list[int] | None:
    """Latest places of the cuts if ranges of several groups could be cut anywhere; None if even so parts do not suffice."""
    at, places = 0, []
    for _ in range(parts):
        to = at + capacity
        if to >= ends[-1]:
            return places
        i = int(np.searchsorted(ends, to, "right")) - 1
        if single[i]:
            to = int(ends[i])
        if to <= at:
            return None
        places.append(to)
        at = to
    return None


def cut_points(groups: DataFrame, parts: int, first_bits: int = 12, step: int = 6) -> tuple[int, list[int]]:
    """(least capacity, keys that open parts 1, 2, ...) for groups (key long, size long, one row a key), in order of key.

    The driver holds sums over ranges of keys. Ranges taken as atoms bound the least capacity from above, ranges that
    could be cut anywhere bound it from below, and between the two bounds each cut has an interval. Only ranges in
    those intervals are opened into 2**step smaller ones, until the bounds meet; so the driver gets some thousands of
    sums for each opened level, however many groups there are.
    """

    def sums(part: DataFrame, below: int) -> list[tuple]:
        rows = part.groupBy(F.shiftright("key", below).alias("p") if below else F.col("key").alias("p")).agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
        return [(int(r.p) << below, below, int(r.s), int(r.n)) for r in rows]

    ranges = sorted(sums(groups, 64 - first_bits))
    while ranges:
        ends = np.append(0, np.cumsum(np.array([r[2] for r in ranges], np.int64)))
        single = np.array([r[3] == 1 for r in ranges] + [True])
        high, cuts = smallest_capacity([r[2] for r in ranges], parts)
        low = _least(lambda c, e=ends, s=single: _loose(e, s, c, parts) is not None, max(1, -(-int(ends[-1]) // parts)), high)
        if low == high:
            return high, [ranges[i][0] for i in cuts]
        late, early, opened = _loose(ends, single, high, parts), 0, set()
        for place in late:
            early = int(ends[int(np.searchsorted(ends, early + low, "right")) - 1]) if early + low < ends[-1] else early
            i, j = np.searchsorted(ends, [early, place], "right") - 1
            opened.update(x for x in range(int(i), min(int(j), len(ranges) - 1) + 1) if not single[x])
        kept = [r for i, r in enumerate(ranges) if i not in opened]
        for width in sorted({ranges[i][1] for i in opened}):
            tops = [ranges[i][0] >> width for i in opened if ranges[i][1] == width]
            kept += sums(groups.filter(F.shiftright("key", width).isin(tops)), max(0, width - step))
        ranges = sorted(kept)
    return 0, []


def shard(docs: DataFrame, shards: int = 40, overhead: int = 16, salts: int | None = None) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law ("bytes"), shard, slot and grown_shard (null), sizes near equal.

    size: UTF-8 bytes and overhead. slot: gapless from 0 within a shard, numbered in salts slices of a shard at once, so
    that neither a shard nor a group of equal texts is ever sorted in one task.
    """
    text = F.coalesce("text", F.lit(""))
    rows = settle(docs.select("doc_id", (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key")), "sizes")
    groups = settle(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    _, cuts = cut_points(groups, shards)
    number = F.lit(0)
    for cut in cuts:
        number = number + (F.col("key") >= F.lit(cut)).cast("int")
    salts = salts or max(4, -(-4 * partitions(docs.sparkSession) // shards))
    placed = rows.withColumn("shard", number).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    counts = placed.groupBy("shard", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))  # shards * salts rows
    slot = F.row_number().over(Window.partitionBy("shard", "salt").orderBy("doc_id", "key", "size"))
    numbered = placed.withColumn("r", slot).join(F.broadcast(offsets), ["shard", "salt"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("r") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
