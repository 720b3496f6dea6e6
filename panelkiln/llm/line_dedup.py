"""Line deduplication with a sharded minimal perfect hash index.

Every line's key gets two independent 64-bit hashes: one places it, the other is its fingerprint. The index keeps, per
shard of the first hash, a minimal perfect hash (levels of bit maps, a key lands on the first level where it is alone)
over the distinct keys that several documents hold, and arrays that it indexes: fingerprint, count of documents,
smallest doc_id. Documents probe the arrays: their packed hashes travel to the shard, and it answers with the keys to
drop. Only texts that may hold one of those are shuffled to meet them (blocks.sift); all others are finished where they
are read. Inside a chunk of documents a key is settled at once, and only its smallest document sends a probe, so a line in
a third of all documents costs its shard one entry per chunk.

Defined results: a null or empty text is one empty line. A key is dropped in a document if a smaller doc_id holds it;
a null doc_id sorts before all others, and rows that share a doc_id are one document, so a repeated row loses nothing
to its twin and gets the same result. A very long line is a key like others. Other columns play no part. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .blocks import sift
from .common import buckets, partitions, settle

NULL_ID = -(1 << 63)
#: Text bytes that one chunk splits into lines: places of its bytes take some 20 times as much.
CHUNK_BYTES = 3 << 20
PACKED = "bucket int, kind int, keys binary, prints binary, docs binary, counts binary"
INDEX = "bucket int, shards int, size long, levels binary, level_bytes binary, prints binary, counts binary, docs binary"
PRINT_VALUES = np.random.default_rng(77).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _ids(column) -> np.ndarray:
    return column.combine_chunks().cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def _bucket(docs: np.ndarray, n: int) -> np.ndarray:
    """Bucket of a document; _bucket_column() gives the same."""
    return np.mod(docs ^ (docs >> 20), n)


def _bucket_column(doc: F.Column, n: int) -> F.Column:
    doc = F.coalesce(doc, F.lit(NULL_ID))
    return F.pmod(doc.bitwiseXOR(F.shiftright(doc, 20)), F.lit(n)).cast("int")


def _lines(buf: np.ndarray, offsets: np.ndarray):
    """Starts and ends of all lines, and their rows. The i-th start belongs to the i-th end."""
    breaks = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    per_row = np.diff(np.searchsorted(breaks, offsets)) + 1
    return starts, ends, np.repeat(np.arange(len(per_row)), per_row)


def _keys(column, least: int):
    """Line numbers whose key is long enough, their two hashes, and the row and borders of every line."""
    buf, offsets = K.string_buffers(column)
    starts, ends, row = _lines(buf, offsets)
    solid = np.flatnonzero(~K.SPACES[buf])
    i, j = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    points = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=points[1:])
    some = np.flatnonzero(i < j)
    s, e = solid[i[some]], solid[j[some] - 1] + 1
    long = points[e] - points[s] >= least
    some, s, e = some[long], s[long], e[long]
    return some, K.span_hashes(buf, s, e, K.BYTE_VALUES[K.LOWER]), K.span_hashes(buf, s, e, PRINT_VALUES[K.LOWER]), row, starts, ends


def _pack(bucket, kind, keys, prints, docs, counts):
    order, cut = K.grouped(bucket)
    rows = [(int(bucket[order[i]]), kind, *(x[order[i:j]].tobytes() for x in (keys, prints, docs, counts))) for i, j in zip(cut[:-1], cut[1:], strict=True)]
    names = PACKED.replace(" int", "").replace(" binary", "").split(", ")
    return pa.record_batch([pa.array([r[c] for r in rows], pa.int32() if c < 2 else pa.binary()) for c in range(6)], names)


def _unpack(t):
    return tuple(K.ints(t.column(c), k) for c, k in (("keys", np.uint64), ("prints", np.uint64), ("docs", np.int64), ("counts", np.uint32)))


def _map(least: int, n: int):
    def run(batches):
        for t in K.chunks(batches, limit=CHUNK_BYTES):
            ids = _ids(t.column("doc_id"))
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            at, keys, prints, row, _, _ = _keys(t.column("text").combine_chunks().take(pa.array(order)), least)
            if not len(at):
                continue
            docs = ids[row[at]]
            by, cut = K.grouped(keys)  # stable: by document within a key
            fresh = np.append(True, (keys[by[1:]] != keys[by[:-1]]) | (docs[by[1:]] != docs[by[:-1]]))
            by = by[fresh]  # one entry for a key and document
            k, d = keys[by], docs[by]
            first = np.append(True, k[1:] != k[:-1])
            heads = np.flatnonzero(first)
            counts = np.diff(np.append(heads, len(by))).astype(np.uint32)
            yield _pack(((k[heads] >> np.uint64(20)) % np.uint64(n)).astype(np.int64), 0, k[heads], prints[by[heads]], d[heads], counts)
            late = ~first
            if late.any():
                none = np.zeros(int(late.sum()), np.uint64)
                yield _pack(_bucket(d[late], n), 1, k[late], none, d[late], none.astype(np.uint32))

    return run


def build_levels(keys: np.ndarray, gamma: float = 2.0, most: int = 100) -> list[np.ndarray]:
    """Bit maps of a minimal perfect hash over distinct keys."""
    levels = []
    while len(keys):
        if len(levels) == most:
            raise ValueError("keys repeat")
        size = max(64, (int(gamma * len(keys)) + 7) // 8 * 8)
        at = _place(keys, len(levels), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, bool)
        bits[at[alone]] = True
        levels.append(bits)
        keys = keys[~alone]
    return levels


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (K.mix(keys + np.uint64(level + 1) * np.uint64(K.R_WORD)) % np.uint64(size)).astype(np.int64)


def probe_levels(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Each key's index, a different one below len(keys) for each member; -1 or any index for a stranger."""
    out, left, base = np.full(len(keys), -1), np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        at = _place(keys[left], level, len(bits))
        found = bits[at]
        rank = np.cumsum(bits)
        out[left[found]] = base + rank[at[found]] - 1
        base += int(rank[-1])
        left = left[~found]
    return out


def _build(n: int):
    return lambda t: _build_one(t, n)


def _build_one(t: pa.Table, shards: int) -> pa.Table:
    keys, prints, docs, counts = _unpack(t.filter(pa.array(t.column("kind").to_numpy() == 0)))
    by, cut = K.grouped(keys)
    heads = by[cut[:-1]]
    low = np.minimum.reduceat(docs[by], cut[:-1]) if len(heads) else docs
    high = np.maximum.reduceat(docs[by], cut[:-1]) if len(heads) else docs
    total = np.add.reduceat(counts[by], cut[:-1]) if len(heads) else counts
    shared = (low < high) | (total > np.uint32(1))
    k, p, low, total = keys[heads][shared], prints[heads][shared], low[shared], total[shared]
    levels = build_levels(k)
    at = probe_levels(levels, k)
    arrays = [np.empty(len(k), x.dtype) for x in (p, total, low)]
    for array, x in zip(arrays, (p, total, low), strict=True):
        array[at] = x
    bits = [np.packbits(x) for x in levels]
    row = [t.column("bucket")[0].as_py() if t.num_rows else 0, shards, len(k), b"".join(x.tobytes() for x in bits), np.array([len(x) for x in bits], np.int64).tobytes(), *(x.tobytes() for x in arrays)]
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
    return pa.table([pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)], ["bucket", "shards", "size", "levels", "level_bytes", "prints", "counts", "docs"])


def _probe(n: int):
    def run(probes: pa.Table, index: pa.Table) -> pa.Table:
        out = []
        local = _unpack(probes.filter(pa.array(probes.column("kind").to_numpy() == 1)))
        if len(local[0]):
            out.append(_pack(_bucket(local[2], n), 2, local[0], local[1], local[2], local[3]))
        keys, prints, docs, counts = _unpack(probes.filter(pa.array(probes.column("kind").to_numpy() == 0)))
        if len(keys) and index.num_rows:
            row = index.slice(0, 1)
            sizes, bits = K.ints(row.column("level_bytes"), np.int64), K.string_buffers(row.column("levels"))[0]
            ends = np.cumsum(sizes)
            levels = [np.unpackbits(bits[e - s : e]).astype(bool) for s, e in zip(sizes, ends, strict=True)]
            held, first = K.ints(row.column("prints"), np.uint64), K.ints(row.column("docs"), np.int64)
            at = probe_levels(levels, keys)
            drop = at >= 0
            drop[drop] = (held[at[drop]] == prints[drop]) & (first[at[drop]] < docs[drop])
            out.append(_pack(_bucket(docs[drop], n), 2, keys[drop], prints[drop], docs[drop], counts[drop]))
        none = np.zeros(0, np.uint64)
        return pa.Table.from_batches(out or [_pack(none.astype(np.int64), 2, none, none, none.astype(np.int64), none.astype(np.uint32))])

    return run


def _apply(least: int, with_text: bool):
    def one(texts: pa.Table, gone_keys: np.ndarray) -> pa.Table:
        column = texts.column("text").combine_chunks()
        at, hashes, _, row, starts, ends = _keys(column, least)
        ids = _ids(texts.column("doc_id"))
        gone = np.zeros(len(starts), bool)
        gone[at] = np.isin(_pair(hashes, ids[row[at]]), gone_keys)
        buf, offsets = K.string_buffers(column)
        data, border = buf.tobytes(), np.searchsorted(row, np.arange(len(ids) + 1))
        lost = np.add.reduceat(gone.astype(np.int64), border[:-1]) if len(ids) else np.zeros(0, np.int64)
        kept = []
        for r in range(len(ids)):
            if lost[r]:
                mine = np.flatnonzero(~gone[border[r] : border[r + 1]]) + border[r]
                kept.append(b"\n".join([data[s:e] for s, e in zip(starts[mine].tolist(), ends[mine].tolist(), strict=True)]))
            else:
                kept.append(data[offsets[r] : offsets[r + 1]])
        out = {"doc_id": texts.column("doc_id"), "n_lines": pa.array(np.diff(border)), "n_dropped": pa.array(lost), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())}
        if with_text:
            out["kept_text"] = pa.array([x if lost[r] or column[r].is_valid else None for r, x in enumerate(kept)], pa.binary()).cast(pa.string())
            out |= {c: texts.column(c) for c in texts.column_names if c.startswith("_own_")}
        return pa.table(out)

    def run(texts: pa.Table, drops: pa.Table) -> pa.Table:
        keys, _, docs, _ = _unpack(drops)
        gone_keys = _pair(keys, docs)
        parts = [one(t, gone_keys) for t in K.chunks(texts.to_batches(), limit=CHUNK_BYTES)]
        return pa.concat_tables(parts or [one(texts.slice(0, 0), gone_keys)])

    return run


def _pair(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return K.mix(keys + K.mix(docs.astype(np.int64).view(np.uint64)))


def _docs_of(batches):
    for b in batches:
        yield pa.record_batch({"doc": pa.array(K.distinct(K.ints(b.column("docs"), np.int64)))})


def _probes(docs: DataFrame, least: int, n: int) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_map(least, n), PACKED).repartition(partitions(docs.sparkSession), "bucket")


def build_index(docs: DataFrame, least: int = 10, shards: int | None = None) -> DataFrame:
    """The index as a table with a row per shard, to keep and to probe with more documents later."""
    n = shards or buckets(docs)
    return _probes(docs, least, n).groupBy("bucket").applyInArrow(_build(n), INDEX)


def drop_lines(docs: DataFrame, least: int = 10, with_text: bool = True, keep: tuple = (), shards: int | None = None, index: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256 and (with_text) kept_text and the columns named in keep.

    least: code points in a key that counts. shards: groups of packed rows, each held by one task, so the number should
    grow with the data (by default by the bytes of text). index: one made by build_index with the same
    setting of least, whose shards it keeps; by default it is built from docs.
    """
    made = index.select("shards").first() if index is not None else None
    n = made.shards if made else shards or buckets(docs)
    probes = _probes(docs, least, n)
    index = index if index is not None else probes.groupBy("bucket").applyInArrow(_build(n), INDEX)
    drops = settle(probes.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(_probe(n), PACKED), "drops")
    own = [F.col(f"`{c}`").alias(f"_own_{c}") for c in (keep if with_text else ())]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *own)
    some, others = sift(texts, F.coalesce("doc_id", F.lit(NULL_ID)), drops.select("docs").mapInArrow(_docs_of, "doc long"), "doc")
    some = some.withColumn("bucket", _bucket_column(F.col("doc_id"), n)).repartition(partitions(docs.sparkSession), "bucket")
    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", kept_text string" * with_text
    schema += "".join(f", `_own_{c}` {kind}" for c, kind in docs.select(*(f"`{c}`" for c in keep)).dtypes) if own else ""
    cut = some.groupBy("bucket").cogroup(drops.groupBy("bucket")).applyInArrow(_apply(least, with_text), schema)
    text = F.coalesce("text", F.lit(""))
    whole = others.select("doc_id", (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.sha2(text, 256).alias("kept_sha256"), *([F.col("text").alias("kept_text")] if with_text else []), *(F.col(f"`_own_{c}`") for c in (keep if with_text else ())))
    return cut.unionByName(whole).withColumnsRenamed({f"_own_{c}": c for c in keep})
