"""Embedding near-duplicates by an exact metric range join.

Vectors are scaled to length 1, where a cosine of at least t is a distance of at most r = sqrt(2 - 2t). A label whose
vectors fill one block is one group's work. In a larger one pivots (a bounded hash sample of the label's vectors)
partition the vectors into cells by the nearest pivot; a cell is one block or several, and each block keeps the range of
its vectors' distances to every pivot. By the triangle inequality two blocks whose ranges to some pivot lie more than r
apart hold no link. All other pairs of blocks of a label are compared, each pair independently: Spark's Cartesian product
reads the blocks from their table again for each partition on its other side, so no vector is ever replicated on disk or
in a shuffle, however little the pivots prune. Tasks give back counts and a spanning forest of the links found, never all pairs.

Equal vectors of a label are one vector with a weight before the join, so copies cost nothing.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component, or whose label is null,
links with nothing: 0 links, its own component, kept. So do vectors of different lengths. Components in double precision are
first scaled by a power of two for each vector, so that those near the limits of a double keep their cosine (squares of
single-precision ones cannot leave a double's range). Rows with a null vec_id give rows with a null component and are
counted as neighbours. A repeated row counts as another vector: it links with its twin. Other columns play no part. An
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .common import components, partitions, settle

#: Distances near 0 come from cosines near 1 and are exact to about 2e-8.
SLACK = 1e-7
#: Rows of a tile of cosines, and pairs near the threshold that are computed again at once.
TILE, AGAIN = 2048, 1 << 15

ROWS = "vec_id long, label int, dims int, v binary"
PLACED = "label int, dims int, cell int, v binary, ids array<long>"
#: A block: its vectors (only where the label has more), ranges of distances to the pivots, then each vector's weight, least
#: vec_id, links and root within the block, and the ids of all rows with their vector's place.
BLOCKS = "label int, dims int, first long, v binary, lo array<double>, hi array<double>, weights array<long>, least array<long>, links array<long>, roots array<int>, ids array<long>, owner array<int>"


def _matrix(column, kind: str) -> np.ndarray:
    buf, offsets = K.string_buffers(column)
    return buf.view(kind).reshape(len(offsets) - 1, -1).astype(np.float64) if len(offsets) > 1 else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _linked(a: np.ndarray, b: np.ndarray, least: float, same: bool):
    """Index pairs of rows of a and b (of a with itself: each pair once) with a cosine of at least `least`, tile by tile.

    Cosines in single precision settle what is further from the threshold than their error; the others are computed in double.
    """
    near = 2.4e-7 * (a.shape[1] + 8)
    na, nb = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    ua, ub = (a / na[:, None]).astype(np.float32), (b / nb[:, None]).astype(np.float32)
    for s in range(0, len(a), TILE):
        for t in range(s if same else 0, len(b), TILE):
            c = ua[s : s + TILE] @ ub[t : t + TILE].T
            x, y = np.nonzero(c >= least - near)
            sure = c[x, y] > least + near
            x, y = x + s, y + t
            if same and s == t:
                once = x < y
                x, y, sure = x[once], y[once], sure[once]
            ask = np.flatnonzero(~sure)
            for k in range(0, len(ask), AGAIN):
                o = ask[k : k + AGAIN]
                sure[o] = (a[x[o]] * b[y[o]]).sum(1) / (na[x[o]] * nb[y[o]]) >= least
            if sure.any():
                yield x[sure], y[sure]


def _joined(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray, least: float, same: bool):
    """Linked rows that each row of a and b has on the other side, and the root of each (a's rows, then b's; one side where same)."""
    la, lb, n = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), len(a) if same else len(a) + len(b)
    root = np.arange(n)
    for x, y in _linked(a, b, least, same):
        la += np.bincount(x, weights=wb[y], minlength=len(a)).astype(np.int64)
        lb += np.bincount(y, weights=wa[x], minlength=len(b)).astype(np.int64)
        root = K.forest(n, np.concatenate([np.arange(n), x]), np.concatenate([root, y if same else y + len(a)]))
    return la, lb, root


def _binary(kind: str):
    def run(batches):
        for b in batches:
            values, dims = b.column("e").flatten().to_numpy(zero_copy_only=False), b.column("dims").to_numpy().astype(np.int64)
            if len(dims) and kind == "<f8":  # by a power of two, so that no square overflows or vanishes and no digit changes
                most = np.maximum.reduceat(np.abs(values), np.cumsum(dims) - dims)
                values = np.ldexp(values, np.repeat(-np.frexp(most)[1], dims))
            data, ends = values.astype(kind).tobytes(), np.append(0, np.cumsum(dims)) * int(kind[2:])
            yield pa.record_batch([b.column("vec_id"), b.column("label"), b.column("dims"), pa.array([data[s:t] for s, t in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())], ["vec_id", "label", "dims", "v"])

    return run


def _place(pivots: dict[tuple[int, int], np.ndarray], kind: str):
    """A batch's distinct vectors with the ids of their rows, and the cell of each: the nearest pivot of its label."""

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(["label", "dims", "v"], use_threads=False).aggregate([("vec_id", "list")])
            label, dims = t.column("label").to_numpy(), t.column("dims").to_numpy()
            cell, v = np.zeros(t.num_rows, np.int32), t.column("v").combine_chunks()
            code = label.astype(np.int64) << 32 | dims
            for c in np.unique(code).tolist() if pivots else ():
                p = pivots.get((c >> 32, c & 0xFFFFFFFF))
                if p is not None:
                    at = np.flatnonzero(code == c)
                    cell[at] = (_unit(_matrix(v.take(pa.array(at)), kind)) @ p.T).argmax(1)
            yield from pa.table([t.column("label"), t.column("dims"), pa.array(cell), t.column("v"), t.column("vec_id_list")], ["label", "dims", "cell", "v", "ids"]).to_batches()

    return run


def _pack(pivots: dict[tuple[int, int], np.ndarray], kind: str, least: float):
    """Blocks of one bucket, each compared with itself."""
    types = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}[k]) for n, k in (x.split() for x in BLOCKS.split(", "))])

    def run(t: pa.Table) -> pa.Table:
        key = ["label", "dims", "cell", "sub"]
        first = int(t.column("bucket")[0].as_py()) << 32 if t.num_rows else 0
        lists = t.column("ids").combine_chunks()
        t = t.append_column("row", pa.array(np.arange(t.num_rows))).group_by([*key, "more", "v"], use_threads=False).aggregate([("row", "list")]).sort_by([(k, "ascending") for k in key])
        keys = np.stack([t.column(k).to_numpy().astype(np.int64) for k in key]) if t.num_rows else np.zeros((4, 0), np.int64)
        cut = np.flatnonzero(np.append(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)), True)) if t.num_rows else np.zeros(1, np.int64)
        v, out = t.column("v").combine_chunks(), []
        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            of = t.column("row_list").slice(s, e - s).combine_chunks()
            own = lists.take(of.flatten())
            ids = own.flatten()
            owner = np.repeat(np.repeat(np.arange(e - s), of.value_lengths().to_numpy()), own.value_lengths().to_numpy()).astype(np.int32)
            weights = np.bincount(owner, minlength=e - s)
            low = pa.table({"o": owner, "i": ids}).group_by("o", use_threads=False).aggregate([("i", "min")]).sort_by("o").column("i_min")
            x = _matrix(v.slice(s, e - s), kind)
            la, lb, root = _joined(x, x, weights, weights, least, True)
            p, more = pivots.get((int(keys[0, s]), int(keys[1, s]))), t.column("more")[s].as_py()
            d = np.sqrt(np.maximum(0, 2 - 2 * _unit(x) @ p.T)) if more and p is not None else None
            out.append((int(keys[0, s]), int(keys[1, s]), first, b"".join(v.slice(s, e - s).to_pylist()) if more else None, None if d is None else d.min(0), None if d is None else d.max(0), weights, low.to_pylist(), weights - 1 + la + lb, root.astype(np.int32), ids.to_pylist(), owner))
            first += e - s
        return pa.table([pa.array([r[i] for r in out], f.type) for i, f in enumerate(types)], schema=types)

    return run


def _cross(kind: str, least: float):
    """Links between two blocks: (vector, null, links) and (vector, root, 0)."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dims, fa, fb = (batch.column(c)[i].as_py() for c in ("dims", "first", "b_first"))
                a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), kind).reshape(-1, dims).astype(np.float64) for c in ("v", "b_v"))
                wa, wb = (batch.column(c)[i].values.to_numpy() for c in ("weights", "b_weights"))
                la, lb, root = _joined(a, b, wa, wb, least, False)
                name = np.concatenate([fa + np.arange(len(a)), fb + np.arange(len(b))])
                links = np.concatenate([la, lb])
                some, child = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(root)))
                to = pa.array(np.append(np.zeros(len(some), np.int64), name[root[child]]), mask=np.arange(len(some) + len(child)) < len(some))
                yield pa.record_batch([pa.array(np.append(name[some], name[child])), to, pa.array(np.append(links[some], np.zeros(len(child), np.int64)))], ["a", "b", "links"])

    return run


def near_vectors(vectors: DataFrame, least: float = 0.98, cell_rows: int = 2000, most_pivots: int = 64, block: int = 8192, part_bytes: int = 4 << 20, pivot_bytes: int = 16 << 20) -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept, for (vec_id, embedding, label).

    least: smallest cosine of a link. cell_rows: vectors that a pivot should have; most_pivots: per label and length;
    pivot_bytes: of all pivots, which tasks hold. block, part_bytes: rows and bytes of a block; a pair of blocks is the unit of work.
    """
    spark = vectors.sparkSession
    r = float(np.sqrt(2 - 2 * least))
    single = vectors.schema["embedding"].dataType.elementType.typeName() in ("float", "byte", "short")
    kind, item = ("<f4", 4) if single else ("<f8", 8)
    e = F.transform("embedding", lambda x: x.cast("float" if single else "double"))
    fine = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(F.size("embedding") > 0, F.lit(False))
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(e, lambda x: x != 0)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), e.alias("e"), F.coalesce(fine & finite & some, F.lit(False)).alias("fine"))
    good = base.filter("fine").select("vec_id", "label", F.size("e").alias("dims"), "e")
    # only labels of several blocks have pivots and cells
    key = ["label", "dims"]
    room = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(part_bytes) / (F.col("dims") * item))))
    large = settle(good.groupBy(*key).agg(F.count("*").alias("size")).filter(F.col("size") > room).withColumn("want", F.least(F.lit(most_pivots), F.ceil(F.col("size") / cell_rows))), "large")
    asked = large.agg(F.sum(F.col("want") * F.col("dims") * item)).first()[0] or 0
    large = large.withColumn("want", F.floor(F.col("want") * min(1.0, pivot_bytes / max(1, asked))))
    # a hash sample that holds a bounded number for each label
    drawn = good.join(F.broadcast(large), key).withColumn("h", F.xxhash64("e")).filter(F.pmod("h", F.lit(1 << 40)) < F.ceil(F.lit(8.0 * (1 << 40)) * F.col("want") / F.col("size"))).dropDuplicates([*key, "h"])
    place = F.row_number().over(Window.partitionBy(*key).orderBy("h"))
    chosen = drawn.withColumn("k", place).filter("k <= want").select("vec_id", *key, "e").mapInArrow(_binary(kind), ROWS)
    held: dict[tuple[int, int], list] = {}
    for p in chosen.select(*key, "v").collect() if asked else ():
        held.setdefault((p.label, p.dims), []).append(np.frombuffer(p.v, kind).astype(np.float64))
    pivots = {k: _unit(np.stack(p)) for k, p in held.items()}
    placed = good.mapInArrow(_binary(kind), ROWS).mapInArrow(_place(pivots, kind), PLACED)
    # a cell larger than a block is dealt into several by a hash that equal vectors share
    cells = placed.join(F.broadcast(large.select(*key)), key).groupBy(*key, "cell").agg(F.count("*").alias("m"))
    cells = settle(cells.select(*key, "cell", F.ceil(F.col("m") / room).alias("subs")), "cells")
    total = vectors.agg(F.sum(F.size("embedding").cast("long") * item)).first()[0] or 0
    buckets = max(partitions(spark, 2), -(-int(total) // (2 * part_bytes)))
    dealt = placed.join(F.broadcast(cells), [*key, "cell"], "left").withColumn("more", F.col("subs").isNotNull())
    dealt = dealt.withColumn("sub", F.pmod(F.xxhash64("v"), F.coalesce("subs", F.lit(1)))).drop("subs")
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64(*key, "cell", "sub"), F.lit(buckets)).cast("long"))
    blocks = settle(dealt.groupBy("bucket").applyInArrow(_pack(pivots, kind, least), BLOCKS), "blocks")
    # ranges of distances to a pivot that lie further apart than a link
    one = blocks.filter("v is not null").select(*key, "first", "v", "weights", "lo", "hi")
    two = one.withColumnsRenamed({c: f"b_{c}" for c in one.columns})
    gap = lambda lo, hi: F.coalesce(F.exists(F.zip_with(lo, hi, lambda x, y: x - y), lambda d: d > r + SLACK), F.lit(False))
    meet = (F.col("label") == F.col("b_label")) & (F.col("dims") == F.col("b_dims")) & (F.col("first") < F.col("b_first")) & ~gap("lo", "b_hi") & ~gap("b_lo", "hi")
    pairs = one.join(two.hint("shuffle_replicate_nl"), meet).select("dims", "first", "b_first", "v", "b_v", "weights", "b_weights")
    found = settle(pairs.mapInArrow(_cross(kind, least), "a long, b long, links long"), "links")
    each = blocks.select("first", F.posexplode(F.arrays_zip("weights", "least", "links", "roots")))
    nodes = each.select((F.col("first") + F.col("pos")).alias("rep"), F.col("col.least").alias("least_id"), F.col("col.links").alias("inside"), (F.col("first") + F.col("col.roots")).alias("root"))
    more = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(nodes.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(found.filter("b is not null").select("a", "b")))
    named = nodes.drop("root").join(more, "rep", "left").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    named = settle(named.select("rep", "least_id", (F.col("inside") + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root")), "named")
    # the smallest vec_id of each component
    least_of = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(least_of, "root").select("rep", "n_links", "component_id")
    members = blocks.select("first", F.explode(F.arrays_zip("ids", "owner")).alias("x")).select(F.col("x.ids").alias("vec_id"), (F.col("first") + F.col("x.owner")).alias("rep"))
    linked = members.join(named, "rep").select("vec_id", "n_links", "component_id")
    alone = base.filter("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
