"""Recursive means by an affine scan: a row maps the mean so far, e, to a * e + b, and maps compose.

The maps come from Spark's columns; numpy composes them along the rows of a task, a batch at a time, and carries the last
composition to the next batch, so a group of any length needs one batch's memory. A large group is cut into slices
(operators.slices): each composes its own maps, the slices' compositions are scanned in the same way, and a join hands
the mean at a slice's beginning to its rows.

Defined results: a null or NaN value carries the mean on, and the next value weighs the mean less for each missing row:
after m of them e becomes (q**(m+1) * e + a * x) / (q**(m+1) + a), q = 1 - a. Rows before a group's first value are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import free, settle
from ..spec import PanelSpec
from .slices import join_group, sliced


def compose(start: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A, B): e -> A * e + B from the beginning of each row's segment (where start is true) to the row, in log2(rows) steps."""
    a, b, whole, k = a.copy(), b.copy(), start.copy(), 1
    while k < len(a) and not whole[k:].all():
        live = ~whole[k:]
        b[k:] = np.where(live, a[k:] * b[:-k] + b[k:], b[k:])
        a[k:] = np.where(live, a[k:] * a[:-k], a[k:])
        whole[k:] |= whole[:-k]
        k *= 2
    return a, b


def affine_scan(df: DataFrame, keys: list[str], order: list[str], maps: dict[str, tuple[str, str]]) -> DataFrame:
    """df with each pair of map columns (a, b) composed from the first row of the keys, by order. Replaces the columns.

    df is partitioned by the keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(k) for k in keys]
            start = np.zeros(batch.num_rows, bool)
            start[0] = before != tuple(k[0].as_py() for k in own)
            for k in own:
                codes = k.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                start[1:] |= codes[1:] != codes[:-1]
            before = tuple(k[-1].as_py() for k in own)
            head = int(start.argmax()) if start.any() else len(start)  # rows that go on from the batch before
            for name, (ca, cb) in maps.items():
                a, b = compose(start, *(batch.column(c).to_numpy(zero_copy_only=False) for c in (ca, cb)))
                if head:
                    b[:head] += a[:head] * held[name][1]
                    a[:head] *= held[name][0]
                held[name] = a[-1], b[-1]
                for c, x in ((ca, a), (cb, b)):
                    batch = batch.set_column(batch.schema.get_field_index(c), c, pa.array(x))
            yield batch

    return df.sortWithinPartitions(*keys, *order).mapInArrow(run, df.schema)


def recursive_means(df: DataFrame, spec: PanelSpec, wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """df with, for each name, the recursive mean of a value with weight alpha: e_0 = x_0, e_i = alpha * x_i + (1 - alpha) * e_(i-1)."""
    ids = list(range(len(wanted)))
    values = dict(zip(free(df, *(f"value{i}" for i in ids)), wanted.values(), strict=True))
    rows = df.select("*", *(F.nanvl(c.cast("double"), F.lit(None)).alias(v) for v, (c, _) in values.items()))
    if spec.slice_rows:
        rows, cut, own = sliced(rows, spec, 0)
        keys = [spec.group, cut.slice]
    else:
        cut, own, keys = spec, None, [spec.group]
    order, w = [spec.order, *spec.tiebreak], cut.window()
    names = free(rows, "pos", *(f"{p}{i}" for i in ids for p in ("age", "a", "b")), *(f"since{i}" for i in ids))
    pos, since = names[0], dict(zip(values, names[1 + 3 * len(ids) :], strict=True))
    of = {v: names[1 + 3 * i : 4 + 3 * i] for i, v in enumerate(values)}
    # numbers inside a slice stay as they are where rows tie: they are written down
    placed = rows.repartition(*keys).select("*", F.row_number().over(w).alias(pos))
    if own:
        placed = settle(placed, "slices")
        lasts = placed.groupBy(*keys).agg(F.max(pos).alias("m"), *(F.max(F.when(F.col(v).isNotNull(), F.col(pos))).alias(f"last{i}") for i, v in enumerate(values)))
        earlier = Window.partitionBy(spec.group).orderBy(cut.slice).rowsBetween(Window.unboundedPreceding, -1)
        base = F.coalesce(F.sum("m").over(earlier), F.lit(0))
        based = lasts.select(*keys, base.alias("base"), *((base + F.col(f"last{i}")).alias(f"last{i}") for i in ids))
        placed = join_group(placed, based.select(*keys, *((F.col("base") - F.max(f"last{i}").over(earlier)).alias(since[v]) for i, v in enumerate(values))), keys).repartition(*keys)
    else:
        placed = placed.select("*", *(F.lit(None).cast("long").alias(since[v]) for v in values))
    by_place = cut.window() if not own else Window.partitionBy(*keys).orderBy(pos)
    ages = []
    for v in values:
        last = F.last(F.when(F.col(v).isNotNull(), F.col(pos)), ignorenulls=True).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
        ages.append(F.coalesce(F.col(pos) - last, F.col(pos) + F.col(since[v])).alias(of[v][0]))
    maps = []
    for v, (_, alpha) in values.items():
        age, a, b = of[v]
        q = F.pow(F.lit(1 - alpha), F.col(age))
        maps += [F.when(F.col(v).isNull(), 1.0).when(F.col(age).isNull(), 0.0).otherwise(q / (q + alpha)).alias(a), F.when(F.col(v).isNull(), 0.0).when(F.col(age).isNull(), F.col(v)).otherwise(alpha * F.col(v) / (q + alpha)).alias(b)]
    scanned = affine_scan(placed.select("*", *ages).select("*", *maps), keys, [pos], {v: (of[v][1], of[v][2]) for v in values})
    start = {v: F.lit(0.0) for v in values}
    if own:
        scanned = settle(scanned, "scanned")
        ends = scanned.groupBy(*keys).agg(*(F.max_by(c, pos).alias(c) for v in values for c in of[v][1:]))
        ends = affine_scan(ends.repartition(spec.group), [spec.group], [cut.slice], {v: (of[v][1], of[v][2]) for v in values})
        begin = ends.select(spec.group, (F.col(cut.slice) + 1).alias(cut.slice), *(F.col(of[v][2]).alias(f"{of[v][2]}_begin") for v in values))
        scanned = join_group(scanned, begin, keys, "left")
        start = {v: F.coalesce(f"{of[v][2]}_begin", F.lit(0.0)) for v in values}
    out = [F.when(F.col(v).isNotNull() | F.col(of[v][0]).isNotNull(), F.col(of[v][1]) * start[v] + F.col(of[v][2])).alias(name) for name, v in zip(wanted, values, strict=True)]
    return scanned.select(*df.columns, *out)
