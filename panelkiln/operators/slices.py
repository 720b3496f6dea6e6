"""Groups of any size: rows numbered range by range, and windows over slices of a group.

A window partitioned by group sorts a whole group in one task. Here the rows of large groups are numbered within their
group (a range partitioning cuts a large group among many tasks, and counts of its parts give the offsets), cut into
slices of a fixed number of rows, and the rows next to a border are sent to the neighbouring slice as well. A window
over (group, slice) then sees every row that its frame needs. Groups of one slice at most are not numbered.

Frames of a bounded reach need no numbers. Where the order has few values (dates), counts of each value, or of ranges of
the first tiebreak within one, tell which slices a row belongs to, so rows are shuffled once, for the window (dealt).

Defined results: those of the same window over whole groups. Rows that the order cannot tell apart stand in any order,
as in a window. A null group is a group. An empty table stays empty.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import free, partitions, settle
from ..spec import PanelSpec


def join_group(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """df with the columns of other that df lacks, on keys of which nulls are equal."""
    other = other.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    out = df.join(other, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*(f"__{k}" for k in keys))


def numbered(df: DataFrame, spec: PanelSpec, pos: str) -> DataFrame:
    """df with each row's place in its group, from 0, without a task that holds a group: two shuffles of counts, one of rows."""
    at, part, first, m, salt = free(df, "at", "part", "first_at", "m", "salt")
    order = [spec.group, spec.order, *spec.tiebreak]
    spread = df.withColumn(salt, F.monotonically_increasing_id())  # parts rows that the order cannot tell apart
    dealt = spread.repartitionByRange(partitions(df.sparkSession), *order, salt).sortWithinPartitions(*order, salt).drop(salt)
    rows = settle(dealt.withColumn(at, F.monotonically_increasing_id()), "numbered").withColumn(part, F.shiftright(at, 33))
    counts = rows.groupBy(spec.group, part).agg(F.min(at).alias(first), F.count("*").alias(m))
    earlier = F.sum(m).over(Window.partitionBy(spec.group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(spec.group, part, (F.coalesce(earlier, F.lit(0)) - F.col(first)).alias(m))
    return join_group(rows, offsets, [spec.group, part]).withColumn(pos, F.col(at) + F.col(m)).drop(at, part, m)


def sliced(df: DataFrame, spec: PanelSpec, before: int, after: int = 0) -> tuple[DataFrame, PanelSpec, str]:
    """(rows, spec, own): rows in slices, each with `before` rows ahead of it and `after` behind it; own marks those that belong to their slice."""
    piece, own, pos, n = free(df, "slice", "own", "place", "n_rows")
    size = max(spec.slice_rows, before, after, 1)
    large = settle(df.groupBy(spec.group).agg(F.count("*").alias(n)).filter(F.col(n) > size), "large-groups")
    small = join_group(df, large, [spec.group], "left_anti").select("*", F.lit(0).cast("long").alias(piece), F.lit(True).alias(own))
    if large.isEmpty():
        return small, replace(spec, slice=piece, slice_rows=None), own
    rows = join_group(numbered(join_group(df, large, [spec.group], "left_semi"), spec, pos), large, [spec.group])
    here, inside = F.expr(f"`{pos}` div {size}"), F.col(pos) % size
    # a row near the end of its slice goes to the next one too, one near the beginning to the one before
    next_one = F.when((inside >= size - before) & (F.col(pos) - inside + size < F.col(n)), here + 1)
    last_one = F.when((inside < after) & (here > 0), here - 1)
    targets = F.filter(F.array(here, next_one, last_one), lambda x: x.isNotNull())
    both = rows.select(*df.columns, F.explode(targets).alias(piece), here.alias(own)).withColumn(own, F.col(piece) == F.col(own))
    return both.unionByName(small), replace(spec, slice=piece, slice_rows=None), own


#: Values of the order that dealt() counts, and slices that it makes, at most; parts of a slice, the least that a neighbour gets.
VALUES, SLICES, PARTS = 100_000, 4096, 16


def dealt(df: DataFrame, spec: PanelSpec, before: int, after: int = 0) -> tuple[DataFrame, PanelSpec, str]:
    """As sliced(), but slices are of unequal size, not numbered on end, and reach further than before and after.

    Rows are told their slices by broadcast counts, so no table of them is written and no shuffle numbers them. sliced()
    does the work where the order has too many values, or where one range of them holds several slices' rows.
    """
    g, o = spec.group, spec.order
    piece, own, n, kinds, low, high, k, part, end, to, of = free(df, "slice", "own", "n_rows", "kinds", "low", "high", "k", "part", "end", "to", "of")
    size = max(spec.slice_rows, before, after, 1)
    large = settle(df.groupBy(g).agg(F.count("*").alias(n), F.approx_count_distinct(o).alias(kinds)).filter(F.col(n) > size), "large-groups")
    total, most = large.agg(F.sum(n), F.sum(kinds)).first()
    if not total:
        return df.select("*", F.lit(0).cast("long").alias(piece), F.lit(True).alias(own)), replace(spec, slice=piece, slice_rows=None), own
    if most > VALUES:
        return sliced(df, spec, before, after)
    size = max(size, -(-total // SLICES))
    rows = join_group(df.select(*dict.fromkeys([g, o, *spec.tiebreak[:1]])), F.broadcast(large.select(g)), [g], "left_semi")
    whole = bool(spec.tiebreak) and isinstance(df.schema[spec.tiebreak[0]].dataType, T.IntegralType)
    tie = F.col(spec.tiebreak[0]).cast("double") if whole else F.lit(None).cast("double")
    values = rows.groupBy(g, o).agg(F.count("*").alias(n), F.min(tie).alias(low), F.max(tie).alias(high))
    values = settle(values.withColumn(k, F.when(F.col(low).isNull(), 1).otherwise(F.ceil(F.col(n) / max(1, size // PARTS)))), "values")
    # a value of many rows is cut into k ranges of the first tiebreak (nulls stand first)
    known = F.broadcast(values.filter(F.col(k) > 1).drop(n))
    inside = F.when(tie.isNull() | F.col(k).isNull(), F.lit(0)).otherwise(F.least(F.col(k) - 1, F.floor((tie - F.col(low)) / (F.col(high) - F.col(low) + 1) * F.col(k))))
    cut = lambda d: join_group(d, known, [g, o], "left").withColumn(part, inside).drop(low, high, k)
    counts = settle(cut(rows).groupBy(g, o, part).agg(F.count("*").alias(n)), "counts")
    if counts.agg(F.max(n)).first()[0] > 8 * size:
        return sliced(df, spec, before, after)
    w = Window.partitionBy(g).orderBy(o, part)
    placed = counts.withColumn(end, F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn(of, F.expr(f"(`{end}` - `{n}`) div {size}"))
    nearby = placed.select("*", F.lead(of).over(w).alias(high), F.lag(of).over(w).alias(low), (F.col(end) - F.col(n)).alias(k))
    targets = [F.array(of)]
    if before:  # the slices that begin less than `before` rows after this part's end
        targets.append(F.collect_list(F.when(F.col(high) != F.col(of), F.col(high))).over(Window.partitionBy(g).orderBy(end).rangeBetween(0, before - 1)))
    if after:  # those that end less than `after` rows before its beginning
        targets.append(F.collect_list(F.when(F.col(low) != F.col(of), F.col(low))).over(Window.partitionBy(g).orderBy(k).rangeBetween(1 - after, 0)))
    told = settle(nearby.select(g, o, part, of, F.concat(*targets).alias(to)), "slices")
    both = join_group(cut(df), F.broadcast(told), [g, o, part], "left")
    home = F.coalesce(of, F.lit(0).cast("long"))
    both = both.select(*df.columns, F.explode(F.coalesce(to, F.array(F.lit(0).cast("long")))).alias(piece), home.alias(own))
    return both.withColumn(own, F.col(piece) == F.col(own)), replace(spec, slice=piece, slice_rows=None), own


def halo(before: Callable[[dict], int] = lambda a: 0, after: Callable[[dict], int] = lambda a: 0):
    """For an operator fn(df, spec, ...) whose rows need `before` earlier and `after` later rows of their group: where spec
    has slice_rows, it runs over slices."""

    def wrap(fn):
        names = inspect.signature(fn)

        @wraps(fn)
        def run(*args, **kwargs):
            a = arguments(*args, **kwargs)
            if not a["spec"].slice_rows:
                return fn(**a)
            a["df"], a["spec"], own = dealt(a["df"], a["spec"], before(a), after(a))
            return fn(**a).filter(own).drop(own, a["spec"].slice)

        def arguments(*args, **kwargs) -> dict:
            bound = names.bind(*args, **kwargs)
            bound.apply_defaults()
            return bound.arguments | {k: list(v) for k, v in bound.arguments.items() if k in ("columns", "sizes", "steps", "fns", "words") and v is not None}

        def reach(*args, **kwargs) -> tuple[int, int]:
            a = arguments(*args, **kwargs)
            return before(a), after(a)

        run.reach = reach
        return run

    return wrap


def together(df: DataFrame, spec: PanelSpec, *steps: tuple) -> DataFrame:
    """df with the columns of several operators that have a halo, in one slicing. A step is an operator and its arguments
    after df and spec; none may read what an earlier one made."""
    if not spec.slice_rows:
        for fn, *rest in steps:
            df = fn(df, spec, *rest)
        return df
    reach = [fn.reach(df, spec, *rest) for fn, *rest in steps]
    out, cut, own = dealt(df, spec, max(b for b, _ in reach), max(a for _, a in reach))
    for fn, *rest in steps:
        out = fn(out, cut, *rest)
    return out.filter(own).drop(own, cut.slice)


def running_sum(df: DataFrame, spec: PanelSpec, column: str, out: str) -> DataFrame:
    """The sum of column up to and including each row; in a large group, slice by slice with the sums of the slices before."""
    if not spec.slice_rows:
        return df.withColumn(out, F.sum(column).over(spec.window().rowsBetween(Window.unboundedPreceding, 0)))
    both, cut, own = sliced(df, spec, 0)
    g, s, total = cut.group, cut.slice, free(both, "earlier")[0]
    both = settle(both, "slices")
    ends = both.groupBy(g, s).agg(F.sum(column).alias(total))
    before = F.sum(total).over(Window.partitionBy(g).orderBy(s).rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(g, s, before.alias(total))
    inner = both.withColumn(out, F.sum(column).over(cut.window().rowsBetween(Window.unboundedPreceding, 0)))
    summed = F.when(F.col(out).isNull() & F.col(total).isNull(), None).otherwise(F.coalesce(F.col(out), F.lit(0)) + F.coalesce(F.col(total), F.lit(0)))
    return join_group(inner, ends, [g, s]).withColumn(out, summed).drop(total, own, s)
