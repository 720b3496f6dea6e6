"""Best-fit packing of documents into fixed-length sequences by the sum-of-squares rule.

A document's pieces: 1024-token pieces from its end, so that only the first may be shorter; full pieces are sequences
of their own. A short piece goes where the sum of squares of the counts of open bins per residual gap becomes smallest
(the least gap on a tie; a new bin only where no open one has room), longest pieces first. Pieces are dealt into groups of a
bounded size by a hash, each group is packed by one task, and the bins that groups leave open are packed again as
items, until one group holds them or nothing improves.

Defined results: a null or empty text is the closing id alone. Rows with a null or repeated doc_id are documents of
their own. Longer texts are cut, nothing else is. Other columns play no part. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import settle
from .tokens import CHUNK_BYTES, Ids, vocabulary_path


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item (in the order given), lengths from 1 to capacity.

    Longest first, with a new bin only where none has room, it needs about 1.001 times the least possible number on
    the driver's documents; taking new bins by the rule as well needs 1.016 times.
    """
    count = np.zeros(capacity + 1, np.int64)  # open bins per gap
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    far = np.int64(1) << 60
    for i, x in enumerate(lengths.tolist()):
        # (c[g] - 1)^2 - c[g]^2 + (c[g - x] + 1)^2 - c[g - x]^2, where a gap of 0 is not counted
        here, there = count[x:], count[: capacity - x + 1]
        change = 2 * (there - here) + 2
        change[0] -= 2 * there[0] + 1
        change[here == 0] = far
        best = int(change.argmin())
        if change[best] < far:
            gap = best + x
            b = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > x:
            open_bins[gap - x].append(b)
            count[gap - x] += 1
    return bins, offsets


def pieces(docs: DataFrame, capacity: int = 1024, end_id: int = 2, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and (with_ids) ids."""
    path = vocabulary or vocabulary_path()

    def run(batches):
        tokens = Ids(path)
        for t in K.chunks(batches, limit=CHUNK_BYTES):
            ids, first = tokens.of(t.column("text"))
            size = np.diff(first) + 1
            ids = np.insert(ids, first[1:], np.uint32(end_id))
            begin = np.cumsum(size) - size
            n = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), n)
            piece = K.ranges(np.zeros(len(n), np.int64), n)
            head = (size - capacity * (n - 1))[doc]
            start = np.where(piece == 0, 0, head + capacity * (piece - 1))
            length = np.where(piece == 0, head, capacity)
            at = begin[doc] + start
            data = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            out = {"doc_id": t.column("doc_id").combine_chunks().take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(ids.astype(np.int32)))
            yield from pa.table(out).to_batches()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def _pack_groups(items: DataFrame, groups: int, capacity: int) -> DataFrame:
    """(item, bin, base, fill): items (item, length) packed group by group; bin: an item's number that names it."""

    def run(t: pa.Table) -> pa.Table:
        item, length = t.column("item").to_numpy(), t.column("length").to_numpy()
        order = np.lexsort((item, -length))
        item, length = item[order], length[order]
        bins, base = sum_of_squares(length, capacity)
        names = item[np.unique(bins, return_index=True)[1]]
        fill = np.bincount(bins, weights=length, minlength=len(names)).astype(np.int64)
        return pa.table({"item": item, "bin": names[bins], "base": base, "fill": fill[bins]})

    return items.groupBy(F.pmod(F.xxhash64("item"), F.lit(groups)).alias("g")).applyInArrow(lambda t: run(t), "item long, bin long, base long, fill long")


def pack(docs: DataFrame, capacity: int = 1024, end_id: int = 2, vocabulary: str | None = None, with_ids: bool = False, group_items: int = 50_000) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and (with_ids) ids.

    group_items: pieces that one task packs.
    """
    # the number is fixed where the table is written, so that later steps agree on it
    all_of = settle(pieces(docs, capacity, end_id, vocabulary, with_ids).withColumn("item", F.monotonically_increasing_id()), "pieces")
    short = all_of.filter(F.col("length") < capacity).select("item", "length")
    n = short.count()
    placed, known = None, n + 1
    items, left = short, n
    while left and left < known:
        known = left
        done = settle(_pack_groups(items, -(-left // group_items), capacity), "bins")
        if placed is None:
            placed = done.select("item", "bin", "base", "fill")
        else:
            up = done.select(F.col("item").alias("bin"), F.col("bin").alias("_bin"), F.col("base").alias("_base"), F.col("fill").alias("_fill"))
            placed = settle(placed.join(up, "bin", "left").select("item", F.coalesce("_bin", "bin").alias("bin"), (F.col("base") + F.coalesce("_base", F.lit(0))).alias("base"), F.coalesce("_fill", "fill").alias("fill")), "bins")
        if known <= group_items:
            break
        # bins with room, packed again as items
        items = settle(placed.filter(F.col("fill") < capacity).groupBy("bin").agg(F.max("fill").alias("length")).withColumnRenamed("bin", "item"), "open")
        left = items.count()
    out = all_of if placed is None else all_of.join(placed, "item", "left")
    own = F.col("bin") if placed is not None else F.lit(None).cast("long")
    base = F.col("base") if placed is not None else F.lit(None).cast("long")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce(own, "item").alias("sequence_id"), F.coalesce(base, F.lit(0).cast("long")).alias("offset"), *["ids"] * with_ids)
