"""Correlations of thousands of columns over incomplete rows, in one pass.

With x the values (0 where missing) and m the marks of present values, every pair's sums over its complete rows are
entries of x'x, m'x, m'(x*x) and m'm. Each task adds them up in tiles of columns, batch by batch, and gives one row a
tile; tiles are added in two levels, so that no task reads what all tasks have made. The driver gets the finished
coefficients, one number for each pair of columns.

Defined results: null and NaN are missing. A pair whose complete rows are fewer than two, or of which one side is
constant there, has no coefficient (NaN). The diagonal is 1 for a column that varies. An empty table gives NaN.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import partitions

SCHEMA = "i int, j int, part long, sums binary"
#: Share of a pair's mean square that its variance must exceed, by what doubles can tell.
LEAST_SHARE = 1e-13


def _shifts(values: DataFrame, rows: int = 64) -> np.ndarray:
    """A value near each column's own, from a few rows: any shift gives the same coefficients, a near one keeps the squares small."""
    x = values.limit(rows).toPandas().to_numpy(np.float64).reshape(-1, len(values.columns))
    x[~np.isfinite(x)] = np.nan
    return np.array([0.0 if np.isnan(c).all() else np.nanmean(c) for c in x.T]) if len(x) else np.zeros(x.shape[1])


def _partial(columns: list[str], shifts: np.ndarray, tile: int):
    edges = [*range(0, len(columns), tile), len(columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = []
            for a, b in zip(edges, edges[1:], strict=False):
                x = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(a, b)]).astype(np.float64) - shifts[a:b, None]
                m = np.isfinite(x)
                whole = bool(m.all())
                x = x if whole else np.where(m, x, 0.0)
                blocks.append((x, x * x, m.astype(np.float64), whole))
            n = batch.num_rows
            for i, (x, xx, m, whole) in enumerate(blocks):
                for j, (y, yy, o, full) in enumerate(blocks[: i + 1]):
                    # x'y, then over the rows where the other is present: sums of x, y, x*x, y*y, and the number of rows
                    s = np.empty((6, len(x), len(y)))
                    s[0] = x @ y.T
                    s[1], s[3] = (x.sum(1)[:, None], xx.sum(1)[:, None]) if full else (x @ o.T, xx @ o.T)
                    s[2], s[4] = (y.sum(1)[None, :], yy.sum(1)[None, :]) if whole else (m @ y.T, m @ yy.T)
                    s[5] = n if whole and full else m @ o.T
                    if (i, j) in total:
                        total[i, j] += s
                    else:
                        total[i, j] = s
        part = TaskContext.get().partitionId()
        for (i, j), s in total.items():
            yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "j": pa.array([j], pa.int32()), "part": pa.array([part], pa.int64()), "sums": pa.array([s.tobytes()])})

    return run


def _add(t: pa.Table) -> pa.Table:
    total = None
    for blob in t.column("sums"):
        s = np.frombuffer(blob.as_buffer())
        total = s.copy() if total is None else total + s
    return pa.table({"i": t.column("i")[:1], "j": t.column("j")[:1], "part": t.column("part")[:1], "sums": pa.array([total.tobytes()])})


def _coefficients(t: pa.Table) -> pa.Table:
    out = []
    for blob in t.column("sums"):
        sxy, sx, sy, sxx, syy, n = np.frombuffer(blob.as_buffer()).reshape(6, -1)
        with np.errstate(divide="ignore", invalid="ignore"):
            vx, vy = sxx - sx * sx / n, syy - sy * sy / n
            r = np.clip((sxy - sx * sy / n) / np.sqrt(vx * vy), -1, 1)
            r[(n < 2) | ~(vx > LEAST_SHARE * sxx) | ~(vy > LEAST_SHARE * syy)] = np.nan
        out.append(r.tobytes())
    return t.set_column(t.schema.get_field_index("sums"), "sums", pa.array(out, pa.binary()))


def tiles(df: DataFrame, columns: list[str], tile: int = 512) -> DataFrame:
    """(i, j, part, sums): coefficients of column tile i against tile j <= i, row by row, as doubles."""
    values = df.select(*(F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(columns)))
    sums = values.mapInArrow(_partial(columns, _shifts(values), tile), SCHEMA)
    fan = max(2, isqrt(partitions(df.sparkSession)))
    first = sums.withColumn("part", F.col("part") % fan).groupBy("i", "j", "part").applyInArrow(_add, SCHEMA)
    return first.withColumn("part", F.lit(0).cast("long")).groupBy("i", "j").applyInArrow(lambda t: _coefficients(_add(t)), SCHEMA)


def correlation_matrix(df: DataFrame, columns: list[str], tile: int = 512) -> np.ndarray:
    """Each pair of columns over the rows where both are present."""
    n = len(columns)
    out = np.full((n, n), np.nan)
    if n:
        for r in tiles(df, columns, tile).toLocalIterator():
            a, b = r.i * tile, r.j * tile
            s = np.frombuffer(bytes(r.sums)).reshape(min(tile, n - a), min(tile, n - b))
            out[a : a + s.shape[0], b : b + s.shape[1]], out[b : b + s.shape[1], a : a + s.shape[0]] = s, s.T
    np.fill_diagonal(out, np.where(np.isnan(np.diag(out)), np.nan, 1.0))
    return out
