"""Context-triggered piecewise hashing: fingerprints of whole texts that stay alike when parts of a text change.

A hash of the last eight bytes rolls over the text; where its low bits are all ones a chunk ends, so chunks move with
their content. A block size of 2**i asks for i bits. Each chunk gives two symbols of 64 from a hash of its bytes. The
fingerprint `size:chunks:chunks at twice the size` has one block size that fits the text's length, and two
fingerprints are compared by the edit distance of their chunks wherever they share a block size.

Defined results: a null text is empty; its fingerprint is `1::`. Texts of up to 48 bytes have a chunk for each byte. A
signature has at most 64 chunks, the last of which covers all of the text that is left. Fingerprints that share no
block size, and an empty one beside another, have likeness 0; equal ones 1. In following_texts() rows with equal doc_id
stand in the order of their text's hash, rows without doc_id first; a table of one row follows itself. Other columns
play no part, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import partitions, settle

WINDOW, MOST_CHUNKS, FEWEST_CHUNKS, PER_BLOCK = 8, 64, 16, 48
SYMBOLS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", np.uint8)
CHUNK_BYTES = 2 << 20
U32 = np.uint32
VALUES = np.random.default_rng(7).integers(1, 2**32, 256).astype(U32) | U32(1)


def _ones(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte, the low bits that are ones in the hash of the last eight bytes of its row (fewer at its start)."""
    out, base = np.empty(len(buf), U32), [U32(pow(0x9E3779B1, k, 1 << 32)) for k in range(WINDOW)]

    def low(h):
        h = (h ^ (h >> U32(15))) * U32(0x85EBCA6B)
        h ^= h >> U32(13)
        return h & ~(h + U32(1))

    for at in range(0, len(buf), K.SEGMENT):
        to, back = min(len(buf), at + K.SEGMENT), min(at, WINDOW - 1)
        h = VALUES[buf[at - back : to]]
        for k in (1, 2, 4):  # sums over 2, 4 and 8 bytes
            h[k:] = h[k:] + base[k] * h[:-k]
        out[at:to] = low(h[back:])
    # the first bytes of a row again, without those of the row before
    start = np.repeat(offsets[:-1], np.minimum(np.diff(offsets), WINDOW - 1))
    place = K.ranges(np.zeros(len(offsets) - 1, np.int64), np.minimum(np.diff(offsets), WINDOW - 1))
    h = np.zeros(len(place), U32)
    for k in range(WINDOW - 1):
        has = place >= k
        h[has] += base[k] * VALUES[buf[(start + place - k)[has]]]
    out[start + place] = low(h)
    return out


def _hits(ones: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's level and the bytes that end chunks at it: the first level with at most PER_BLOCK blocks, then lower ones while chunks are few."""
    size = np.diff(offsets)
    level = np.ceil(np.log2(np.maximum(1, -(-size // PER_BLOCK)))).astype(np.int64)
    ends = np.flatnonzero(ones >= np.repeat(((1 << level) - 1).astype(U32), size))
    count = np.diff(np.searchsorted(ends, offsets))
    few = np.flatnonzero((count < FEWEST_CHUNKS) & (level > 0))
    if len(few):
        more = [ends[~np.isin(np.searchsorted(offsets, ends, "right") - 1, few)]]
        for r in few.tolist():
            own = ones[offsets[r] : offsets[r + 1]]
            while level[r] and np.count_nonzero(own >= U32((1 << level[r]) - 1)) < FEWEST_CHUNKS:
                level[r] -= 1
            more.append(offsets[r] + np.flatnonzero(own >= U32((1 << level[r]) - 1)))
        ends = np.sort(np.concatenate(more))
    return level, ends


def _signatures(buf: np.ndarray, offsets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk symbols (two bytes each) of all rows, cut behind these bytes, and the first chunk of each row (rows + 1)."""
    row = np.searchsorted(offsets, ends, "right") - 1
    rank = np.arange(len(ends)) - np.searchsorted(ends, offsets)[row]
    inner = ends[(rank < MOST_CHUNKS - 1) & (ends + 1 < offsets[row + 1])] + 1
    starts = np.sort(np.concatenate([offsets[:-1][np.diff(offsets) > 0], inner]))
    hashes = K.span_hashes(buf, starts, np.append(starts[1:], len(buf))) if len(starts) else np.zeros(0, np.uint64)
    codes = np.stack([SYMBOLS[(hashes >> np.uint64(20)).astype(np.int64) & 63], SYMBOLS[(hashes >> np.uint64(40)).astype(np.int64) & 63]], 1)
    return codes, np.searchsorted(starts, offsets)


class Prints:
    """Fingerprints of the rows of a string column: level, and the chunk symbols at it and the next one."""

    def __init__(self, column):
        buf, offsets = K.string_buffers(column)
        offsets = np.asarray(offsets, np.int64)
        ones = _ones(buf, offsets)
        self.level, ends = _hits(ones, offsets)
        double = ones[ends] >= (2 << self.level[np.searchsorted(offsets, ends, "right") - 1]) - 1
        self.codes, self.first = zip(_signatures(buf, offsets, ends), _signatures(buf, offsets, ends[double]), strict=True)

    def text(self) -> list[str]:
        a, b = ("".join(map(chr, c.ravel())) for c in self.codes)
        (i, j) = self.first
        return [f"{1 << n}:{a[2 * i[r] : 2 * i[r + 1]]}:{b[2 * j[r] : 2 * j[r + 1]]}" for r, n in enumerate(self.level.tolist())]

    def padded(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Signature k of all rows in a matrix of chunk numbers, and their lengths."""
        codes, n = self.codes[k].astype(np.int32), np.diff(self.first[k])
        out = np.full((len(n), MOST_CHUNKS), -1, np.int32)
        out[np.repeat(np.arange(len(n)), n), K.ranges(np.zeros(len(n), np.int64), n)] = codes[:, 0] * 256 + codes[:, 1]
        return out, n


def edit_distances(a: np.ndarray, m: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Edit distance (insert, delete, replace) of row i of a, m[i] entries, and row i of b, n[i] entries."""
    width, rows = b.shape[1], np.arange(len(a))
    steps = np.arange(width + 1, dtype=np.int32)
    line, out = np.tile(steps, (len(a), 1)), n.astype(np.int64).copy()
    for i in range(int(m.max(initial=0))):
        best = np.minimum(line[:, 1:] + 1, line[:, :-1] + (b != a[:, i : i + 1]))
        best = np.concatenate([line[:, :1] + 1, best], 1)
        line = np.minimum.accumulate(best - steps, 1) + steps
        done = m == i + 1
        out[done] = line[rows[done], n[done]]
    return out


def likeness(x: Prints, i: np.ndarray, y: Prints, j: np.ndarray) -> np.ndarray:
    """Likeness of fingerprints i of x to fingerprints j of y: the most, over shared block sizes, of 1 - distance / longer."""
    out = np.zeros(len(i))
    made = {(p, k): s.padded(k) for p, s in (("x", x), ("y", y)) for k in (0, 1)}
    for p in (0, 1):
        for q in (0, 1):
            at = np.flatnonzero(x.level[i] + p == y.level[j] + q)
            (a, m), (b, n) = made["x", p], made["y", q]
            m, n = m[i[at]], n[j[at]]
            d = edit_distances(a[i[at]], m, b[j[at]], n)
            out[at] = np.maximum(out[at], np.where((m > 0) & (n > 0), 1 - d / np.maximum(1, np.maximum(m, n)), (m == n).astype(float)))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and fingerprint."""

    def run(batches):
        for t in K.chunks(batches, limit=CHUNK_BYTES):
            yield from t.drop_columns(["text"]).append_column("fingerprint", pa.array(Prints(t.column("text")).text(), pa.string())).to_batches()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _edited(text: str, following: str) -> str:
    """text with its last quarter replaced by the first as many code points of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _pairs(ids: list, texts: list[str], following: list[str], kind: pa.DataType) -> pa.Table:
    """Results for texts of which each has its following one beside it."""
    edited = [_edited(a, b) for a, b in zip(texts, following, strict=True)]
    # each text once: those of the rows, their edited ones, and what follows where it is no later row of the table
    chained = [i + 1 < len(texts) and following[i] is texts[i + 1] for i in range(len(texts))]
    extra = [following[i] for i, c in enumerate(chained) if not c]
    own, new = Prints(pa.array([*texts, *extra], pa.large_string())), Prints(pa.array(edited, pa.large_string()))
    rows = np.arange(len(texts))
    after = np.where(chained, rows + 1, len(texts) + np.cumsum(~np.array(chained, bool)) - 1)
    return pa.table({
        "doc_id": pa.array(ids, kind), "n_chars": pa.array([len(x) for x in texts], pa.int64()), "edited_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
        "fingerprint": pa.array(own.text()[: len(texts)], pa.string()), "edited_fingerprint": pa.array(new.text(), pa.string()), "near_edited": likeness(own, rows, new, rows), "near_next": likeness(own, rows, own, after),
    })


def following_texts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text is the text with its last quarter replaced by the beginning of the next row's text, by doc_id; after
    the last row comes the first. Whole texts are shuffled once, into ranges of doc_id. A task passes over its range in
    order, a few texts at a time; the first and the last text of each range are kept aside, and a last text meets the
    first one of the next range in a second step, which has one row for each range.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key"), F.monotonically_increasing_id().alias("salt"))
    order = ["doc_id", "key", "salt"]
    made = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    border = "range int, first_text string, last_text string"

    def run(batches):
        held_ids, held, size, first, kept = [], [], 0, None, None

        def out(table, **more):
            for name, t in (("range", pa.int32()), ("first_text", pa.string()), ("last_text", pa.string())):
                table = table.append_column(name, pa.array(more.get(name, [None] * table.num_rows), t))
            return table.to_batches()

        for batch in batches:
            kept = batch.schema.field("doc_id").type
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for i, x in zip(ids, texts, strict=True):
                first = x if first is None else first
                held_ids.append(i)
                held.append(x)
                size += len(x)
                if size >= CHUNK_BYTES and len(held) > 1:
                    yield from out(_pairs(held_ids[:-1], held[:-1], held[1:], kept))
                    held_ids, held, size = held_ids[-1:], held[-1:], len(held[-1])
        if held:
            if len(held) > 1:
                yield from out(_pairs(held_ids[:-1], held[:-1], held[1:], kept))
            last = {"doc_id": pa.array(held_ids[-1:], kept)} | {n: pa.nulls(1, t) for n, t in (("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()))}
            yield from out(pa.table(last), range=[TaskContext.get().partitionId()], first_text=[first], last_text=held[-1:])

    dealt = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    both = settle(dealt.mapInArrow(run, f"doc_id {kind}, {made}, {border}"), "fuzzy")
    borders = both.filter(F.col("range").isNotNull())
    # ranges without texts, one row each: which comes next
    numbers = borders.select("range")
    next_of = numbers.select("range", F.coalesce(F.lead("range").over(Window.orderBy("range")), F.min("range").over(Window.partitionBy())).alias("next"))
    firsts = borders.select(F.col("range").alias("next"), F.col("first_text").alias("following"))
    ends = borders.select("doc_id", "range", "last_text").join(next_of, "range").join(firsts, "next").select("doc_id", "last_text", "following")

    def close(batches):
        for batch in batches:
            for i, a, b in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "last_text", "following")), strict=True):
                yield from _pairs([i], [a], [b], batch.schema.field("doc_id").type).to_batches()

    columns = ["doc_id", *(c.split()[0] for c in made.split(", "))]
    return both.filter(F.col("range").isNull()).select(columns).unionByName(ends.mapInArrow(close, f"doc_id {kind}, {made}"))
