"""Substring deduplication over a de Bruijn graph of token k-mers.

Nodes are (k-1)-mers of words, edges are the k-mers of the documents, named by hashes of 64 bits. An edge that occurs
again is a repeat. A path of repeats does not branch while its own coordinates and those of its earliest occurrence
advance together; there it is compacted into one span. Where a source ends or another one is earlier, a new path begins,
so no table of nodes and their degrees is needed. Steps:

1. map: each document's edges get a hash and a minimizer (the least hash among the short word grams inside the
   edge), so that neighbouring edges fall into the same bucket. Edges that repeat inside a chunk of documents are
   settled there, and only the first of each goes on, so that a passage in a third of all documents costs a bucket
   one entry per chunk.
2. bucket: edges are grouped by (minimizer, hash); every edge but the earliest gets the earliest one's coordinates,
   and runs along a path are compacted.
3. glue: runs meet by document, and those that continue each other across bucket borders join into one span.
4. verify: spans meet their source document, which adds a digest of the source words; then they meet their own
   document, where a span is removed only if its words have that digest. Only texts that may hold a span or a source are
   shuffled for this (blocks.sift); all others are finished where they are read.

Rows between steps hold packed arrays for a bucket, never for a single edge. Two different edges of one minimizer with
equal hashes of 64 bits would hide a repeat (about one in 10**7 for a million edges under one minimizer); none is ever
removed wrongly, because of the digest. Edges that share one minimizer are one task's work.

Defined results: a null text has no words. Null doc_ids sort before all others. Rows that share a doc_id share its
coordinates: of two equal windows the one with the smaller (doc_id, start) is earlier, and at equal coordinates
neither is, so a repeated row gets the same result as its twin. A text shorter than the window loses nothing. Other
columns play no part. An empty table gives an empty result. doc_id is an integer; the smallest long stands for null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .blocks import sift
from .common import buckets as buckets_of
from .common import partitions, settle

#: Doc_id of a null in packed arrays.
NULL_ID = -(1 << 63)
#: Words in a minimizer's gram.
GRAM = 8
PACKED = "bucket int, kind int, docs binary, starts binary, counts binary, a binary, b binary"


def _delta(x: np.ndarray) -> bytes:
    return np.diff(x, prepend=np.int64(0)).tobytes()


def _undelta(blobs) -> np.ndarray:
    buf, offs = K.string_buffers(blobs)
    return np.concatenate([np.zeros(0, np.int64), *(np.cumsum(buf[i:j].view(np.int64)) for i, j in zip(offs[:-1], offs[1:], strict=True))])


def _ids(column) -> np.ndarray:
    return column.combine_chunks().cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def _bucket(docs: np.ndarray, n: int) -> np.ndarray:
    """Bucket of a document; _bucket_column() gives the same."""
    return np.mod(docs ^ (docs >> 20), n)


def _bucket_column(doc: F.Column, n: int) -> F.Column:
    doc = F.coalesce(doc, F.lit(NULL_ID))
    return F.pmod(doc.bitwiseXOR(F.shiftright(doc, 20)), F.lit(n)).cast("int")


def _pack(bucket: np.ndarray, kind: int, docs, starts, counts, a, b=None, of_b=None):
    """Tables with a row per bucket; b: entries per row of counts (edge hashes), or of_b: one per run."""
    order, cut = K.grouped(bucket)
    names = PACKED.replace(" int", "").replace(" binary", "").split(", ")
    rows = []
    begin = np.cumsum(counts) - counts
    for i, j in zip(cut[:-1], cut[1:], strict=True):
        o = order[i:j]
        tail = of_b[o].astype(np.int32).tobytes() if b is None else b[K.ranges(begin[o], counts[o])].tobytes()
        rows.append((int(bucket[o[0]]), kind, _delta(docs[o]), starts[o].astype(np.int32).tobytes(), counts[o].astype(np.int32).tobytes(), a[o].tobytes(), tail))
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.record_batch([pa.array(c, pa.int32() if n in ("bucket", "kind") else pa.binary()) for n, c in zip(names, columns, strict=True)], names)


def _runs(docs, starts, source, source_starts):
    """Compacts entries (sorted by document and start) that continue each other in both coordinates: first entries and lengths."""
    n = len(docs)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    go_on = (docs[1:] == docs[:-1]) & (starts[1:] == starts[:-1] + 1) & (source[1:] == source[:-1]) & (source_starts[1:] == source_starts[:-1] + 1)
    first = np.flatnonzero(np.append(True, ~go_on))
    return first, np.diff(np.append(first, n))


def _map(k: int, n: int):
    def run(batches):
        for t in K.chunks(batches):
            ids = _ids(t.column("doc_id"))
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            h, first = K.words_of(t.column("text").combine_chunks().take(pa.array(order)))
            edge, row, at = K.windows_of(h, first, k)
            if not len(edge):
                continue
            least = K.sliding(K.rolling(h, GRAM), k - GRAM + 1)[at]
            start, docs = at - first[row], ids[row]
            # repeats inside this chunk
            by, cut = K.grouped(edge)
            source = np.empty(len(edge), np.int64)
            source[by] = np.repeat(by[cut[:-1]], np.diff(cut))
            again = np.flatnonzero((source != np.arange(len(edge))) & ((docs[source] != docs) | (start[source] != start)))
            src = source[again]
            f, size = _runs(docs[again], start[again], docs[src], start[src])
            if len(f):
                yield _pack(_bucket(docs[again[f]], n), 1, docs[again[f]], start[again[f]], size, docs[src[f]], of_b=start[src[f]])
            # the others, as runs under one minimizer
            own = np.flatnonzero(source == np.arange(len(edge)))
            m = least[own]
            new = np.append(True, (m[1:] != m[:-1]) | (own[1:] != own[:-1] + 1) | (row[own[1:]] != row[own[:-1]]))
            f = np.flatnonzero(new)
            size = np.diff(np.append(f, len(own)))
            yield _pack(((m[f] >> np.uint64(20)) % np.uint64(n)).astype(np.int64), 0, docs[own[f]], start[own[f]], size, m[f], b=edge[own])

    return run


def _unpack(t: pa.Table, b_kind):
    return _undelta(t.column("docs")), K.ints(t.column("starts"), np.int32).astype(np.int64), K.ints(t.column("counts"), np.int32).astype(np.int64), K.ints(t.column("a"), np.uint64), K.ints(t.column("b"), b_kind)


def _resolve(n: int):
    def run(t: pa.Table) -> pa.Table:
        kind = t.column("kind").to_numpy()
        out = [x for x in (_unpack(t.filter(pa.array(kind == 1)), np.int32),) if len(x[0])]
        out = [(d, s, c, a.view(np.int64), b.astype(np.int64)) for d, s, c, a, b in out]
        docs, starts, counts, m, hashes = _unpack(t.filter(pa.array(kind == 0)), np.uint64)
        if len(docs):
            o = np.lexsort((starts, docs))
            at = K.ranges((np.cumsum(counts) - counts)[o], counts[o])
            counts = counts[o]
            within = K.ranges(np.zeros(len(counts), np.int64), counts)
            docs, starts, m, hashes = np.repeat(docs[o], counts), np.repeat(starts[o], counts) + within, np.repeat(m[o], counts), hashes[at]
            with np.errstate(over="ignore"):
                key = K.mix(m ^ (hashes * np.uint64(K.R_WORD)))
            by = np.argsort(key, kind="stable")
            fresh = np.append(True, (m[by[1:]] != m[by[:-1]]) | (hashes[by[1:]] != hashes[by[:-1]]))
            first = np.flatnonzero(fresh)
            source = np.empty(len(docs), np.int64)
            source[by] = np.repeat(by[first], np.diff(np.append(first, len(by))))
            again = np.flatnonzero((docs[source] != docs) | (starts[source] != starts))
            src = source[again]
            f, size = _runs(docs[again], starts[again], docs[src], starts[src])
            out.append((docs[again[f]], starts[again[f]], size, docs[src[f]], starts[src[f]]))
        none = np.zeros(0, np.int64)
        out.append((none,) * 5)
        docs, starts, counts, src, at = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.Table.from_batches([_pack(_bucket(docs, n), 2, docs, starts, counts, src, of_b=at)])

    return run


def _glue(n: int):
    def run(t: pa.Table) -> pa.Table:
        docs, starts, counts, src, at = _unpack(t, np.int32)
        src, at = src.view(np.int64), at.astype(np.int64)
        o = np.lexsort((starts, docs))
        docs, starts, counts, src, at = docs[o], starts[o], counts[o], src[o], at[o]
        go_on = (docs[1:] == docs[:-1]) & (starts[1:] == (starts + counts)[:-1]) & (src[1:] == src[:-1]) & (at[1:] == (at + counts)[:-1])
        f = np.flatnonzero(np.append(True, ~go_on)) if len(docs) else np.zeros(0, np.int64)
        size = np.add.reduceat(counts, f) if len(f) else counts
        return pa.Table.from_batches([_pack(_bucket(src[f], n), 3, docs[f], starts[f], size, src[f], of_b=at[f])])

    return run


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _texts(t: pa.Table):
    """(doc_id, text bytes or None) of each row."""
    return zip(_ids(t.column("doc_id")).tolist(), t.column("text").cast(pa.binary()).to_pylist(), strict=True)


def _source(k: int, n: int):
    def run(texts: pa.Table, spans: pa.Table) -> pa.Table:
        docs, starts, counts, src, at = _unpack(spans, np.int32)
        src = src.view(np.int64)
        by, cut = K.grouped(src)
        want = {int(src[by[i]]): by[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)}
        rows, digests = [], []
        for doc, text in _texts(texts) if len(docs) else ():
            if (mine := want.get(doc)) is not None and text:
                w = text.split()
                for x in mine.tolist():
                    if at[x] + counts[x] + k - 1 <= len(w):
                        rows.append(x)
                        digests.append(_digest(w[at[x] : at[x] + counts[x] + k - 1]))
        rows = np.array(rows, np.int64)
        held = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        order, cut = K.grouped(_bucket(docs[rows], n))
        out = [(int(b), 4, _delta(docs[rows[o]]), starts[rows[o]].astype(np.int32).tobytes(), counts[rows[o]].astype(np.int32).tobytes(), held[o].tobytes(), b"") for i, j in zip(cut[:-1], cut[1:], strict=True) for o in (order[i:j],) for b in (_bucket(docs[rows[o[:1]]], n)[0],)]
        names = PACKED.replace(" int", "").replace(" binary", "").split(", ")
        return pa.table([pa.array([r[c] for r in out], pa.int32() if c < 2 else pa.binary()) for c in range(7)], names)

    return run


def _docs_of(batches):
    for b in batches:
        docs = [_undelta(b.column("docs")), K.ints(b.column("a"), np.int64)]
        yield pa.record_batch({"doc": pa.array(K.distinct(np.concatenate(docs)))})


def _whole(k: int, with_text: bool):
    """_apply() for texts without spans."""
    apply, none = _apply(k, with_text), pa.table({"docs": pa.array([], pa.binary()), "starts": pa.array([], pa.binary()), "counts": pa.array([], pa.binary()), "a": pa.array([], pa.binary())})

    def run(batches):
        for t in K.chunks(batches):
            yield from apply(t, none).to_batches()

    return run


def _apply(k: int, with_text: bool):
    def run(texts: pa.Table, spans: pa.Table) -> pa.Table:
        docs, starts, counts = _undelta(spans.column("docs")), K.ints(spans.column("starts"), np.int32), K.ints(spans.column("counts"), np.int32)
        digests = K.string_buffers(spans.column("a"))[0].reshape(-1, 16)
        by, cut = K.grouped(docs)
        mine = {int(docs[by[i]]): by[i:j].tolist() for i, j in zip(cut[:-1], cut[1:], strict=True)}
        words, removed, hashes, kept_texts = [], [], [], []
        for doc, text in _texts(texts):
            w = (text or b"").split()
            gone = np.zeros(len(w), bool)
            for x in mine.get(doc, ()):
                i, j = int(starts[x]), int(starts[x]) + int(counts[x]) + k - 1
                if j <= len(w) and _digest(w[i:j]) == digests[x].tobytes():
                    gone[i:j] = True
            n = int(gone.sum())
            kept = b" ".join([x for x, g in zip(w, gone.tolist(), strict=True) if not g] if n else w)
            words.append(len(w))
            removed.append(n)
            hashes.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept)
        out = {"doc_id": texts.column("doc_id").cast(pa.int64()), "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(hashes, pa.string())}
        return pa.table(out | ({"kept_text": pa.array(kept_texts, pa.binary()).cast(pa.string())} if with_text else {}))

    return run


def remove_repeats(docs: DataFrame, k: int = 20, with_text: bool = True, buckets: int | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and (with_text) kept_text, without the words of windows seen earlier.

    k: words in a window, at least 8. buckets: groups of packed rows; each is held by one task, so it should grow with
    the data (by default with the bytes of text).
    """
    if k < GRAM:
        raise ValueError(f"k is at least {GRAM}")
    n = buckets or buckets_of(docs, 2)
    parts = partitions(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    edges = texts.mapInArrow(_map(k, n), PACKED)
    runs = edges.groupBy("bucket").applyInArrow(_resolve(n), PACKED)
    paths = settle(runs.groupBy("bucket").applyInArrow(_glue(n), PACKED), "paths")

    some, others = sift(texts, F.coalesce("doc_id", F.lit(NULL_ID)), paths.select("docs", "a").mapInArrow(_docs_of, "doc long"), "doc")
    keyed = some.select(_bucket_column(F.col("doc_id"), n).alias("bucket"), "doc_id", "text").repartition(parts, "bucket")
    sources = keyed.groupBy("bucket").cogroup(paths.groupBy("bucket")).applyInArrow(_source(k, n), PACKED)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    cut = keyed.groupBy("bucket").cogroup(sources.groupBy("bucket")).applyInArrow(_apply(k, with_text), schema)
    return cut.unionByName(others.mapInArrow(_whole(k, with_text), schema))
