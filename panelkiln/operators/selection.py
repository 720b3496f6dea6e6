"""Feature selection and the evolve loop. Statistics come from one pass; the driver sees one number per column."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rowmath
from ..sources.column_groups import ColumnGroups, batched
from ..spec import PanelSpec
from . import gram, stats
from .slices import join_group
from .windows import average_rank

#: From a frame and names of its columns to the names that stay.
Reduction = Callable[[DataFrame, list[str]], list[str]]


def zero_variance(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns that vary."""
    return [r.feature for r in stats.variances(df, columns).filter("variance > 0").collect()]


def uncorrelated(df: DataFrame, columns: list[str], most: float = 0.95) -> list[str]:
    """Columns that vary, but those of which an earlier one that varies, kept or not, has |r| above most; in schema order. One pass."""
    r = abs(gram.correlation_matrix(df, columns))
    vary = ~np.isnan(np.diag(r))
    return [c for j, c in enumerate(columns) if vary[j] and not (r[:j, j][vary[:j]] > most).any()]


def top_by_target(df: DataFrame, columns: list[str], target: str | None, n: int) -> list[str]:
    """The n columns with the largest |r| with the target, or variance where there is none; names settle ties."""
    score = stats.target_correlations(df, columns, target).withColumnRenamed("corr", "score") if target else stats.variances(df, columns).withColumnRenamed("variance", "score")
    return [r.feature for r in score.orderBy(F.col("score").desc_nulls_last(), "feature").limit(n).collect()]


def top_ranked(columns: Iterable[str], ranking: Iterable[str], n: int) -> list[str]:
    have = set(columns)
    return [c for c in ranking if c in have][:n]


def hash_cut(columns: Iterable[str], n: int, seed: int = 42) -> list[str]:
    """n columns by a hash of the name."""
    from hashlib import sha256

    columns = list(columns)
    kept = set(sorted(columns, key=lambda c: sha256(f"{seed}:{c}".encode()).digest())[:n])
    return [c for c in columns if c in kept]


def select_chain(df: DataFrame, columns: list[str], n: int, ranking: Iterable[str] | None = None, most: float = 0.95) -> list[str]:
    """Variance, correlation, ranking and hash cut, each only while more than n columns are left."""
    for step in (lambda c: zero_variance(df, c), lambda c: uncorrelated(df, c, most), lambda c: top_ranked(c, ranking, n) if ranking else c, lambda c: hash_cut(c, n)):
        if len(columns) > n:
            columns = step(columns)
    return columns


def bounded_reduction(df: DataFrame, columns: list[str], target: str, drop: float, least: int, keep_noise: bool = True) -> list[str]:
    """Drops at most the share `drop` of the columns, keeps at least `least`, and noise columns if asked for."""
    noise = [c for c in columns if c.startswith("random_baseline_")]
    rest = [c for c in columns if c not in noise]
    kept = set(top_by_target(df, rest, target, max(least, ceil(len(rest) * (1 - drop)))))
    return [c for c in columns if c in kept or keep_noise and c in noise]


def above_noise(df: DataFrame, columns: list[str], target: str) -> list[str]:
    """Columns whose |r| with the target exceeds that of every noise column."""
    score = {r.feature: r["corr"] or 0.0 for r in stats.target_correlations(df, columns, target).collect()}
    bar = max((s for c, s in score.items() if c.startswith("random_baseline_")), default=0.0)
    return [c for c in columns if not c.startswith("random_baseline_") and score[c] > bar]


def candidates(columns: list[str], pairs: int = 30, squares: int = 50) -> Iterator[tuple[str, Column]]:
    """Pair sums and products, then squares, one at a time in a fixed order."""
    for i, a in enumerate(columns[:pairs]):
        for b in columns[i + 1 : pairs]:
            yield f"{a}_add_{b}", F.col(a) + F.col(b)
            yield f"{a}_mul_{b}", F.col(a) * F.col(b)
    for c in columns[:squares]:
        yield f"{c}_square", F.col(c) * F.col(c)


def generation_step(df: DataFrame, spec: PanelSpec, columns: list[str], target_count: int, pairs: int = 30, squares: int = 50, groups: int = 10, ranks: int = 0) -> tuple[DataFrame, list[str]]:
    """New features in a fixed order, cut at target_count features: pair sums and products, squares, group mean and deviation, ranks."""
    made = {k: v for k, v in candidates(columns, pairs, squares) if k not in df.columns}
    room = max(0, target_count - len(columns))
    made = dict(list(made.items())[:room])
    df = rowmath.add(df, made)
    names = list(made)
    # an aggregate combines map-side, a window would sort whole groups
    stat = {f"{c}_{spec.group}_{k}": f(c) for c in columns[:groups] for k, f in (("mean", F.avg), ("std", F.stddev_samp))}
    stat = dict([(k, v) for k, v in stat.items() if k not in df.columns][: room - len(names)])
    if stat:
        df = join_group(df, df.groupBy(spec.group).agg(*(v.alias(k) for k, v in stat.items())), [spec.group], "left")
        names += stat
    for c in columns[: max(0, min(ranks, room - len(names)))]:
        df = average_rank(df, c)
        names.append(f"rank_{c}")
    return df, [*columns, *names]


def _by_family(df: DataFrame, names: list[str], families: dict[str, Reduction] | None) -> list[str]:
    """names after each family's own reduction; a family is the names that hold its pattern."""
    for pattern, reduce in (families or {}).items():
        family = [c for c in names if pattern in c]
        kept = set(reduce(df, family)) if family else set()
        names = [c for c in names if c not in family or c in kept]
    return names


def evolve(df: DataFrame, spec: PanelSpec, columns: list[str], iterations: int, target_count: int, path: str, drop: float = 0.3, least: int = 5, hook: Reduction | None = None, families: dict[str, Reduction] | None = None) -> tuple[DataFrame, list[str], list[dict]]:
    """Generates, reduces (hook, or bounded_reduction) and writes a Parquet checkpoint per iteration; returns also the history.

    families: pattern of names -> a reduction of its own for the columns made so far whose name holds it, before the hook.
    """
    history, keys = [], [c for c in df.columns if c not in columns]
    for i in range(iterations):
        wide, names = generation_step(df, spec, columns, target_count)
        names = _by_family(wide, names, families)
        columns = hook(wide, names) if hook else bounded_reduction(wide, names, spec.target, drop, least)
        at = f"{path.rstrip('/')}/iteration={i}"
        wide.select(*keys, *columns).write.mode("overwrite").option("compression", "zstd").parquet(at)
        df = df.sparkSession.read.parquet(at)
        history.append({"iteration": i, "generated": len(names), "kept": len(columns)})
    return df, columns, history


def evolve_in_batches(store: ColumnGroups, columns: list[str], target: str, iterations: int, batch: int = 300, drop: float = 0.3, most: float | None = 0.95, pairs: int = 30, squares: int = 50, hook: Reduction | None = None, families: dict[str, Reduction] | None = None) -> tuple[list[str], list[dict]]:
    """(columns kept, history of batches): generates columns batch by batch; each batch is reduced and its kept columns are written
    to the store before the next is made, so no frame is wider than the sources, the target and one batch.

    A batch loses the share `drop` with the least |r| with the target (or what hook drops), after each family's own
    reduction, and, unless most is None, columns with |r| above it with an earlier one of the batch. The next
    iteration makes its columns from all that are kept.
    """
    history = []
    for i in range(iterations):
        sources = columns[: max(pairs, squares)]
        known, kept_here = set(store.columns()), []
        fresh = ((n, c) for n, c in candidates(columns, pairs, squares) if n not in known)
        for k, part in enumerate(batched(fresh, batch)):
            wide = store.read([*dict.fromkeys([*sources, target])], with_row=True).select("*", *(c.alias(n) for n, c in part))
            names = _by_family(wide, [n for n, _ in part], families)
            names = hook(wide, names) if hook else bounded_reduction(wide, names, target, drop, 1)
            names = uncorrelated(wide, names, most) if most is not None and len(names) > 1 else names
            store.add(f"iteration{i}_batch{k}", wide, names)
            kept_here += names
            history.append({"iteration": i, "batch": k, "generated": len(part), "kept": len(names), "width": len(wide.columns)})
        columns = [*columns, *kept_here]
    return columns, history
