"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

A text is the set of its five-word shingles (hashes of 48 bits; words lie between ASCII white space, unchanged). Equal
sets are one set with a weight before anything else. Each set has `trees` MinHash labels of up to `depth` values, whose
prefixes are the tries' branches. Sets that share a prefix at the current depth meet. The first depth is the longest
at which a pair exactly at the threshold meets with the chance `recall`. The prefix is then shortened by one value at a
time while the recall that the found pairs let expect is below `target`: a pair of similarity s meets in trees * s^depth
branches on average, so each meeting stands for one over that many pairs, of which the chance at s is found. Where most
links are far above the threshold the first depth is enough; where many lie near it the forest goes on.

Where a branch's sets meet they are not paired off. A leader is drawn, all members near it by a coarse signature get
a link to it, those very near leave, and so on; Jaccard distance is a metric, so two sets at 0.8 end up linked
through a leader. The links' components are small clusters of candidates, each shipped once with whole sets, and
inside a cluster every pair is verified exactly, in blocks. Tasks give back counts of links and a spanning forest.

Defined results: a null or blank text has no shingles, 0 links and its own class. A text of one to four words has one
shingle, all its words. Rows with a null doc_id get a null class if no other document is linked with them. A repeated
row is another document and links with its twin. A very long text keeps all its shingles. Other columns play no
part. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .blocks import block_pairs, may_meet, sift
from .common import components, free, partitions, settle

MASK = np.uint64((1 << 48) - 1)
#: Coarse signature: similarity from which a member gets a link to the leader, and from which it needs no other.
NEAR, VERY_NEAR = 0.45, 0.7


def shingle_sets(column, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and where each row's begin (rows + 1); up to 65536 rows."""
    h, first = K.words_of(column)
    n = np.diff(first)
    parts = [K.windows_of(h, first, w)[:2]]
    for k in range(1, w):
        if (n == k).any():
            v, row, _ = K.windows_of(h, first, k)
            parts.append((v[n[row] == k], row[n[row] == k]))
    values, rows = (np.concatenate(x) for x in zip(*parts, strict=True))
    both = K.distinct((rows.astype(np.uint64) << np.uint64(48)) | (values & MASK))
    return both & MASK, np.searchsorted(both >> np.uint64(48), np.arange(len(n) + 1))


def _set_keys(values, first):
    """128 bits that name each row's set."""
    out = np.zeros((len(first) - 1, 2), np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        with np.errstate(over="ignore"):
            for c, salt in enumerate((K.R_BYTE, K.R_WORD)):
                out[some, c] = np.add.reduceat(K.mix(values * np.uint64(salt) + np.uint64(salt)), first[some])
    return out


def _signatures(values, first, m: int, seed: int = 1) -> np.ndarray:
    r = np.random.default_rng(seed)
    xor = r.integers(0, 2**63, m, dtype=np.int64).astype(np.uint64)
    times = r.integers(0, 2**63, m, dtype=np.int64).astype(np.uint64) | np.uint64(1)
    some = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, m), np.uint32)
    if not len(some):
        return out
    got = np.empty((len(some), m), np.uint32)
    # some rows at a time, so that the values stay in cache
    with np.errstate(over="ignore"):
        x = K.mix(values)
        at = 0
        while at < len(some):
            to = max(at + 1, int(np.searchsorted(first[some], first[some[at]] + 32768)))
            lo, hi = first[some[at]], first[some[to - 1] + 1]
            part, begin = x[lo:hi], first[some[at:to]] - lo
            for p in range(m):
                got[at:to, p] = np.minimum.reduceat((part ^ xor[p]) * times[p], begin) >> np.uint64(32)
            at = to
    out[some] = got
    return out


def _sliced(batches, rows: int = 50_000):
    for t in K.chunks(batches, limit=3 << 20):
        for at in range(0, t.num_rows, rows):
            yield t.slice(at, rows).combine_chunks()


def _blobs(matrix: np.ndarray) -> pa.Array:
    n = matrix.shape[1] * matrix.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(n), len(matrix), [None, pa.py_buffer(np.ascontiguousarray(matrix).tobytes())]).cast(pa.binary())


def _sign(w: int, m: int):
    def run(batches):
        for t in _sliced(batches):
            values, first = shingle_sets(t.column("text"), w)
            yield from pa.table({"doc_id": t.column("doc_id"), "text_key": t.column("text_key"), "set_key": _blobs(_set_keys(values, first)), "n": pa.array(np.diff(first)), "signature": _blobs(_signatures(values, first, m))}).to_batches()

    return run


def _labels(trees: int, width: int, depth: int):
    def run(batches):
        for b in batches:
            n = b.num_rows
            sig = K.string_buffers(b.column("signature"))[0].view(np.uint32).reshape(n, trees, width) if n else np.zeros((0, trees, width), np.uint32)
            with np.errstate(over="ignore"):
                label = np.repeat(np.arange(1, trees + 1, dtype=np.uint64)[None, :] * np.uint64(K.R_WORD), n, 0)
                for d in range(depth):
                    label = K.mix(label ^ sig[:, :, d]) + np.uint64(K.R_BYTE)
            coarse = sig[:, :, ::2].reshape(n, -1).astype(np.uint8)
            yield pa.record_batch([pa.array(label.reshape(-1).view(np.int64)), b.column("rep").take(pa.array(np.repeat(np.arange(n), trees))), _blobs(np.repeat(coarse, trees, 0))], ["label", "rep", "coarse"])

    return run


def _codes(t: pa.Table, names) -> np.ndarray:
    code = np.zeros(t.num_rows, np.uint64)
    with np.errstate(over="ignore"):
        for c in names:
            code = K.mix(code ^ t.column(c).to_numpy().astype(np.int64).view(np.uint64)) + np.uint64(K.R_WORD)
    return code


def _lead(least: float, depth: int, trees: int):
    """A spanning forest of the links of members to leaders, all branches at once: in each round every branch with members
    left draws a leader. The last row (ids -1) sums over the links that look at least `least` similar: the pairs that they
    stand for (total), and those of them that are found by chance (found)."""

    def run(t: pa.Table) -> pa.Table:
        order, cut = K.grouped(_codes(t, ("label", "i", "j")))
        rep = t.column("rep").to_numpy()[order]
        n = len(rep)
        coarse = K.string_buffers(t.column("coarse"))[0].reshape(n, -1)[order] if n else np.zeros((0, 1), np.uint8)
        branch = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        left, active, root = np.ones(n, bool), np.arange(n), np.arange(n)
        found, total = 0.0, 0.0
        while len(active):
            waiting = active[left[active]]
            leader_of = np.full(len(cut) - 1, -1)
            leader_of[branch[waiting[::-1]]] = waiting[::-1]
            active = active[leader_of[branch[active]] >= 0]
            lead = leader_of[branch[active]]
            near = (coarse[active] == coarse[lead]).mean(1) if len(active) else np.zeros(0)
            link = (near >= NEAR) & (active != lead)
            if link.any():
                root = K.forest(n, root[active[link]], root[lead[link]])[root]
            s = near[link & (near >= least)]
            pairs = 1 / (trees * s**depth)
            found, total = found + float((pairs * chance(s, depth, trees)).sum()), total + float(pairs.sum())
            left[active[(near >= VERY_NEAR) | (active == lead)]] = False
        child = np.flatnonzero((root != np.arange(n)) & (rep != rep[root])) if n else active
        m = len(child)
        return pa.table({"a": np.append(rep[child], -1), "b": np.append(rep[root[child]], -1), "found": np.append(np.zeros(m), found), "total": np.append(np.zeros(m), total)})

    return run


def _shared(values: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets."""
    m = len(values)
    flat, owner = np.concatenate(values), np.repeat(np.arange(m), [len(v) for v in values])
    order, cut = K.grouped(flat)
    counts = np.diff(cut)
    held = np.repeat(counts > 1, counts)
    owner, column = owner[order][held], np.repeat(np.cumsum(counts > 1) - 1, counts)[held]
    out = np.zeros((m, m), np.float64)
    step = max(256, (4 << 20) // m)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        i, j = np.searchsorted(column, [at, at + step])
        x = np.zeros((m, step), np.float32)
        x[owner[i:j], column[i:j] - at] = 1
        out += x @ x.T
    return out


def _verify(least: float):
    def run(t: pa.Table) -> pa.Table:
        order, cut = K.grouped(_codes(t, ("cluster", "i", "j")))
        rep, weight, side, i, j = (t.column(c).to_numpy() for c in ("rep", "weight", "side", "i", "j"))
        buf, offs = K.string_buffers(t.column("members"))
        ids, gains, left, right = [], [], [], []
        for s, e in zip(cut[:-1], cut[1:], strict=True):
            o = order[s:e]
            if len(o) < 2:
                continue
            values = [buf[offs[x] : offs[x + 1]].view(np.uint64) for x in o]
            size = np.array([len(v) for v in values], np.float64)
            both = _shared(values)
            union = size[:, None] + size[None, :] - both
            linked = both >= least * union - 1e-9
            np.fill_diagonal(linked, False)
            if i[o[0]] != j[o[0]]:
                linked &= side[o][:, None] != side[o][None, :]
            x, y = np.nonzero(linked)
            if not len(x):
                continue
            gain = np.bincount(x, weights=weight[o[y]], minlength=len(o)).astype(np.int64)
            ids.append(rep[o])
            gains.append(gain)
            by = np.argsort(rep[o], kind="stable")
            number = np.empty(len(o), np.int64)
            number[by] = np.arange(len(o))
            root = K.forest(len(o), number[x], number[y])
            child = np.flatnonzero(root != np.arange(len(o)))
            left.append(rep[o[by[child]]])
            right.append(rep[o[by[root[child]]]])
        cat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
        a, g, c = cat(ids), cat(gains), cat(left)
        return pa.table({"a": np.concatenate([a, c]), "b": np.concatenate([a, cat(right)]), "links": np.concatenate([g, np.zeros(len(c), np.int64)])})

    return run


def _members(w: int):
    """Rows with the set of their text, where it is the set that was asked for."""

    def run(batches):
        for t in _sliced(batches):
            values, first = shingle_sets(t.column("text"), w)
            asked = K.string_buffers(t.column("set_key"))[0].reshape(-1, 16)
            fine = np.flatnonzero((_set_keys(values, first).view(np.uint8).reshape(-1, 16) == asked).all(1))
            data, ends = values.tobytes(), (first * 8).tolist()
            keep = t.take(pa.array(fine)).drop_columns(["text", "set_key"])
            yield from keep.append_column("members", pa.array([data[ends[x] : ends[x + 1]] for x in fine.tolist()], pa.binary())).to_batches()

    return run


def chance(s, depth: int, trees: int):
    """Chance that two sets of similarity s share a prefix of this depth in some tree."""
    return 1 - (1 - s**depth) ** trees


def near_texts(docs: DataFrame, least: float = 0.8, w: int = 5, trees: int = 12, depth: int = 6, recall: float = 0.99, target: float = 0.995, block: int = 1024, branch_block: int = 20_000) -> DataFrame:
    """Per row: doc_id, class_id (smallest doc_id that links reach), n_links, n_shingles, kept and text_key.

    least: smallest Jaccard similarity of a link. w: words in a shingle. trees, depth: labels and their longest prefix.
    recall: smallest chance that a pair at the threshold meets, which sets the first depth. target: share of all linked pairs
    that should meet, by the estimate from those found, until which prefixes are shortened. block: sets of a cluster that one task verifies at once. n_links counts all other
    documents linked directly, copies included. kept: one row of each class, that of the smallest doc_id (nulls last).
    """
    least_buckets = partitions(docs.sparkSession, 4)
    source = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = settle(source.mapInArrow(_sign(w, trees * depth), "doc_id long, text_key long, set_key binary, n long, signature binary").withColumn("row", F.monotonically_increasing_id()), "signatures")
    # a class keeps its first row: by doc_id, nulls last, then by text and row
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "row")
    some = signed.filter("n > 0")
    sets = settle(some.groupBy("set_key", "n").agg(F.count("*").alias("weight"), F.min("doc_id").alias("least_id"), F.min(place).alias("place"), F.first("signature").alias("signature")).withColumn("rep", F.monotonically_increasing_id()), "sets")
    at = depth
    while at > 1 and chance(least, at, trees) < recall:  # too long a prefix whatever the data
        at -= 1
    while True:
        rows = sets.select("rep", "signature").mapInArrow(_labels(trees, depth, at), "label long, rep long, coarse binary")
        met = block_pairs(rows, ["label"], F.col("rep"), branch_block, least_buckets, F.octet_length("coarse") + 64)
        edges = settle(met.select("label", "rep", "coarse", "i", "j", "bucket").groupBy("bucket").applyInArrow(_lead(least, at, trees), "a long, b long, found double, total double"), "candidates")
        seen = edges.filter("a < 0").agg(F.sum("found").alias("found"), F.sum("total").alias("total")).first()
        if at == 1 or not seen.total or seen.found / seen.total >= target:
            break
        at -= 1
    clusters = components(edges.filter("a >= 0").select("a", "b"))
    wanted = settle(sets.select("rep", "set_key", "n", "weight", "least_id").join(clusters.select(F.col("id").alias("rep"), F.col("root").alias("cluster")), "rep"), "clusters")
    pairs = block_pairs(wanted, ["cluster"], F.col("rep"), block, least_buckets, F.col("n") * 8 + 64)
    asked = may_meet(docs.select(F.col("doc_id").cast("long").alias("_id"), "text"), "_id", wanted, "least_id")
    texts = asked.join(pairs, F.col("_id").eqNullSafe(F.col("least_id"))).select("rep", "weight", "cluster", "i", "j", "side", "bucket", "set_key", "text")
    members = texts.mapInArrow(_members(w), "rep long, weight long, cluster long, i int, j int, side int, bucket int, members binary")
    found = settle(members.groupBy("bucket").applyInArrow(_verify_once(least), "a long, b long, links long"), "links")
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b")).withColumnRenamed("id", "rep")
    named = settle(sets.drop("signature").join(links, "rep", "left").join(roots, "rep", "left").select("set_key", "least_id", "place", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root")), "named")
    least_of = named.groupBy("root").agg(F.min("least_id").alias("class_id"), F.min("place")["row"].alias("kept_row"))
    named = named.join(least_of, "root").select("set_key", "n_links", "class_id", "kept_row")
    linked = some.select("doc_id", "text_key", "n", "set_key", "row").join(named, "set_key").select("doc_id", "class_id", "n_links", F.col("n").alias("n_shingles"), (F.col("row") == F.col("kept_row")).alias("kept"), "text_key")
    alone = signed.filter("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("n").alias("n_shingles"), F.lit(True).alias("kept"), "text_key")
    return linked.unionByName(alone)


def _verify_once(least: float):
    """_verify on each set once: rows that share a doc_id can bring the same set twice."""
    check = _verify(least)

    def run(t: pa.Table) -> pa.Table:
        code = _codes(t, ("cluster", "i", "j", "rep"))
        _, first = np.unique(code, return_index=True)
        return check(t.take(pa.array(first)) if len(first) < t.num_rows else t)

    return run


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """docs with one row of each class; all columns stay, whatever their names. Of rows with equal doc_id and text the first
    by all their columns stays."""
    found = near_texts(docs.select("doc_id", "text"), **settings).groupBy("doc_id", "text_key").agg(F.count("*").alias("n"), F.max("n_shingles").alias("s"), F.bool_or("kept").alias("kept"))
    own_id, own_key, kept = free(docs, "found_id", "found_key", "found_kept")
    # rows that go, and rows that have a twin to lose; all others stay without a shuffle of their texts
    acted = settle(found.filter("not kept or n > 1 and s > 0").select("doc_id", "text_key", "kept"), "acted")
    some, others = sift(docs, F.col("doc_id").cast("long"), acted, "doc_id")
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    both = some.join(acted.toDF(own_id, own_key, kept), F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (key == F.col(own_key)), "left")
    single = both.filter(F.col(kept).isNull()).select(docs.columns)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    twins = both.filter(kept).groupBy("doc_id", own_key).agg(F.min_by(whole, F.to_json(whole)).alias("first")).select("first.*")
    return others.unionByName(single).unionByName(twins)
