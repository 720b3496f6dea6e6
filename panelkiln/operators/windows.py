"""Time-series features per group. All share the panel's window, so that one exchange and one sort serve them.

Where the spec has slice_rows, windows run over slices of large groups with the rows that their frames reach (halo), and
sums without an end add up slices, so no task holds a group.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import floor, log10

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import free
from ..spec import PanelSpec
from .order import value_counts
from .scan import recursive_means
from .slices import halo, join_group, numbered, running_sum

BASE = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min, "sum": F.sum}


def rolled(c: Column, spec: PanelSpec, n: int, fn: str, min_periods: int = 1, ddof: int = 1) -> Column:
    """fn of the last n rows; null while fewer than min_periods values are there."""
    w = spec.window().rowsBetween(-(n - 1), 0)
    out = (F.stddev_pop if fn == "std" and ddof == 0 else BASE[fn])(c).over(w)
    return out if min_periods <= 1 else F.when(F.count(c).over(w) >= min_periods, out)


@halo(before=lambda a: max(a["sizes"]) - 1)
def rolling(df: DataFrame, spec: PanelSpec, columns: Iterable[str], sizes: Iterable[int] = (3, 7, 14, 28, 56), fns: Iterable[str] = ("mean", "std", "max", "min"), min_periods: int | None = 1, ddof: int = 1, mean_max_only_above: int | None = None) -> DataFrame:
    """{c}_roll_{n}_{fn}. min_periods None: full windows only. mean_max_only_above: larger windows get no std and min."""
    out = {}
    for c in columns:
        for n in sizes:
            for fn in fns:
                if mean_max_only_above is None or n <= mean_max_only_above or fn not in ("std", "min"):
                    out[f"{c}_roll_{n}_{fn}"] = rolled(F.col(c), spec, n, fn, n if min_periods is None else min_periods, ddof)
    return spec.check(df).select("*", *(v.alias(k) for k, v in out.items()))


@halo(before=lambda a: max(a["steps"]))
def lags(df: DataFrame, spec: PanelSpec, columns: Iterable[str], steps: Iterable[int] = (1, 2, 3, 5, 7, 14, 28)) -> DataFrame:
    """{c}_lag_{k}."""
    return spec.check(df).select("*", *(F.lag(c, k).over(spec.window()).alias(f"{c}_lag_{k}") for c in columns for k in steps))


@halo(after=lambda a: max(a["steps"]))
def leads(df: DataFrame, spec: PanelSpec, column: str, steps: Iterable[int] = (1, 5)) -> DataFrame:
    """{c}_next_{k}, and {c}_up_{k}: 1 if the return until then is positive."""
    out = []
    for k in steps:
        to = F.lead(column, k).over(spec.window())
        out += [to.alias(f"{column}_next_{k}"), (to > F.col(column)).cast("int").alias(f"{column}_up_{k}")]
    return df.select("*", *out)


@halo(before=lambda a: max([*a["steps"], 1]))
def returns(df: DataFrame, spec: PanelSpec, column: str, steps: Iterable[int] = (1, 5, 10, 20), logs: bool = True) -> DataFrame:
    """{c}_ret_{k} = x / lag - 1; {c}_logret for one step."""
    w = spec.window()
    out = [(F.try_divide(F.col(column), F.lag(column, k).over(w)) - 1).alias(f"{column}_ret_{k}") for k in steps]
    if logs:
        out.append(F.ln(F.try_divide(F.col(column), F.lag(column, 1).over(w))).alias(f"{column}_logret"))
    return df.select("*", *out)


@halo(before=lambda a: a["n"] - 1)
def distances(df: DataFrame, spec: PanelSpec, column: str, n: int) -> DataFrame:
    """x against the mean, maximum and minimum of full windows: {c}_to_{fn}_{n} = x / fn - 1."""
    return df.select("*", *((F.try_divide(F.col(column), rolled(F.col(column), spec, n, fn, n)) - 1).alias(f"{column}_to_{fn}_{n}") for fn in ("mean", "max", "min")))


@halo(before=lambda a: a["n"])
def momentum(df: DataFrame, spec: PanelSpec, column: str, n: int) -> DataFrame:
    """{c}_mom_{n} = x / lag_n - 1 and {c}_vol_{n}: sample deviation of n one-step returns."""
    w = spec.window()
    one = df.withColumn("_r", F.try_divide(F.col(column), F.lag(column, 1).over(w)) - 1)
    return one.select(*df.columns, (F.try_divide(F.col(column), F.lag(column, n).over(w)) - 1).alias(f"{column}_mom_{n}"), rolled(F.col("_r"), spec, n, "std", n).alias(f"{column}_vol_{n}"))


@halo(before=lambda a: a["n"])
def rsi(df: DataFrame, spec: PanelSpec, column: str, n: int = 14) -> DataFrame:
    """{c}_rsi_{n} = 100 - 100 / (1 + mean gain / mean loss), simple means over full windows; 100 where nothing was lost."""
    d = F.col(column) - F.lag(column, 1).over(spec.window())
    one = df.withColumn("_g", F.greatest(d, F.lit(0.0))).withColumn("_l", F.greatest(-d, F.lit(0.0)))
    one = one.withColumn("_g", F.when(F.lag(column, 1).over(spec.window()).isNotNull(), F.col("_g"))).withColumn("_l", F.when(F.lag(column, 1).over(spec.window()).isNotNull(), F.col("_l")))
    gain, loss = rolled(F.col("_g"), spec, n, "mean", n), rolled(F.col("_l"), spec, n, "mean", n)
    return one.withColumn("_gain", gain).withColumn("_loss", loss).select(*df.columns, F.when(F.col("_loss") == 0, F.lit(100.0)).otherwise(100 - F.try_divide(F.lit(100.0), 1 + F.try_divide(F.col("_gain"), F.col("_loss")))).alias(f"{column}_rsi_{n}"))


@halo(before=lambda a: a["n"] - 1)
def bollinger(df: DataFrame, spec: PanelSpec, column: str, n: int = 20, k: float = 2.0) -> DataFrame:
    """{c}_bb_upper, _lower and _width (over the mean), over full windows."""
    mean, std = rolled(F.col(column), spec, n, "mean", n), rolled(F.col(column), spec, n, "std", n)
    return df.select("*", (mean + k * std).alias(f"{column}_bb_upper"), (mean - k * std).alias(f"{column}_bb_lower"), F.try_divide(2 * k * std, mean).alias(f"{column}_bb_width"))


@halo(before=lambda a: max(a["sizes"]) - 1)
def sma(df: DataFrame, spec: PanelSpec, words: Iterable[str] = ("price", "close", "volume"), sizes: Iterable[int] = (5, 10, 20), most: int | None = None) -> DataFrame:
    """{c}_sma_{n} of the columns whose name holds one of the words (only the first `most` where that is given)."""
    names = [c for c in spec.features(df) if any(x in c.lower() for x in words)][:most]
    return df.select("*", *(rolled(F.col(c), spec, n, "mean", n).alias(f"{c}_sma_{n}") for c in names for n in sizes))


@halo(before=lambda a: 1)
def volume_steps(df: DataFrame, spec: PanelSpec, price: str, volume: str) -> DataFrame:
    """obv_step: volume, signed by the step of price (first row 0)."""
    d = F.signum(F.col(price) - F.lag(price, 1).over(spec.window()))
    return df.withColumn("obv_step", F.coalesce(d * F.col(volume), F.lit(0.0)))


def on_balance_volume(df: DataFrame, spec: PanelSpec, price: str, volume: str) -> DataFrame:
    """obv: running sum of volume, signed by the step of price (first row 0), and obv_step."""
    return running_sum(volume_steps(df, spec, price, volume), spec, "obv_step", "obv")


@halo(before=lambda a: max(a["n"] - 1, 1))
def volume_features(df: DataFrame, spec: PanelSpec, volume: str, n: int = 10) -> DataFrame:
    """log_volume, its change from the row before, and the volume over its mean of n rows."""
    v, mean = F.log1p(volume), rolled(F.col(volume), spec, n, "mean", n)
    return df.select("*", v.alias("log_volume"), (v - F.lag(v).over(spec.window())).alias("log_volume_change"), F.try_divide(F.col(volume), mean).alias(f"volume_to_mean_{n}"))


def bar_steps(df: DataFrame, open_: str, high: str, low: str, close: str, volume: str) -> DataFrame:
    """Row-wise bar features: price_change, price_range and volume_change."""
    change = F.col(close) - F.col(open_)
    return df.select("*", change.alias("price_change"), (F.col(high) - F.col(low)).alias("price_range"), (F.col(volume) * change).alias("volume_change"))


def _scan(df: DataFrame, spec: PanelSpec, alpha: float, sums: dict[str, tuple[Column, float]]) -> DataFrame:
    """Adds, for each name: (value, q), the sum over earlier rows j <= i of value_j * q**(i - j).

    A group is cut into blocks of B rows with q**B about 1e-100: a row takes its block's prefix sum and the end value of
    the block before; what lies further back weighs less than a double can tell. So no group is scanned as a whole
    beyond its row numbers, and not for those either where the spec has slice_rows.
    """
    q = min(q for _, q in sums.values())
    size = max(1, floor(100 / -log10(q))) if 0 < q < 1 else 1
    n, b, r, *v = free(df, "row_in_group", "block", "row_in_block", *(f"part_{k}" for k in sums), *(f"end_{k}" for k in sums), *(f"sum_{k}" for k in sums))
    part, end, inner = (dict(zip(sums, v[i * len(sums) :], strict=False)) for i in range(3))
    one = numbered(df, spec, n) if spec.slice_rows else df.withColumn(n, F.row_number().over(spec.window()) - 1)
    one = one.withColumn(b, F.floor(F.col(n) / size)).withColumn(r, F.col(n) % size)
    one = one.select("*", *((F.coalesce(value, F.lit(0.0)) * F.pow(F.lit(q), -F.col(r))).alias(part[k]) for k, (value, q) in sums.items()))
    inside = Window.partitionBy(spec.group, b).orderBy(n).rowsBetween(Window.unboundedPreceding, 0)
    ends = one.groupBy(spec.group, b).agg(*(F.sum(part[k]).alias(end[k]) for k in sums)).withColumn(b, F.col(b) + 1)
    both = join_group(one.select("*", *(F.sum(part[k]).over(inside).alias(inner[k]) for k in sums)), ends, [spec.group, b], "left")
    out = [((F.col(inner[k]) + F.coalesce(F.col(end[k]), F.lit(0.0)) * F.pow(F.lit(q), F.lit(size))) * F.pow(F.lit(q), F.col(r))).alias(k) for k, (_, q) in sums.items()]
    return both.select(*df.columns, *out)


def ewm_mean(df: DataFrame, spec: PanelSpec, column: str, span: float, null_output: bool = False) -> DataFrame:
    """{c}_ewm_{span}: weights (1 - 2 / (span + 1))**age, adjusted. A null counts as a step without a value; its own row gets
    the value so far, or null with null_output."""
    q, x = 1 - 2 / (span + 1), F.col(column).cast("double")
    s = _scan(df, spec, 1 - q, {"_x": (x, q), "_w": (x.isNotNull().cast("double"), q)})
    out = F.try_divide(F.col("_x"), F.col("_w"))
    return s.select(*df.columns, (F.when(F.col(column).isNotNull(), out) if null_output else out).alias(f"{column}_ewm_{span:g}"))


def ewm_std(df: DataFrame, spec: PanelSpec, column: str, span: float) -> DataFrame:
    """{c}_ewm_std_{span}: bias-corrected deviation under the weights of ewm_mean; null for the first value."""
    q = 1 - 2 / (span + 1)
    centre = df.agg(F.avg(column)).first()[0] or 0.0  # keeps the squares small
    x = F.col(column).cast("double") - F.lit(float(centre))
    one = x.isNotNull().cast("double")
    s = _scan(df, spec, 1 - q, {"_x": (x, q), "_xx": (x * x, q), "_w": (one, q), "_ww": (one, q * q)})
    w, mean = F.col("_w"), F.try_divide(F.col("_x"), F.col("_w"))
    var = F.try_divide((F.try_divide(F.col("_xx"), w) - mean * mean) * w * w, F.when(w * w - F.col("_ww") > 1e-12, w * w - F.col("_ww")))
    return s.select(*df.columns, F.when(var.isNotNull(), F.sqrt(F.greatest(var, F.lit(0.0)))).alias(f"{column}_ewm_std_{span:g}"))


def ema(df: DataFrame, spec: PanelSpec, column: str, span: float) -> DataFrame:
    """{c}_ema_{span}: e_0 = x_0, e_i = a * x_i + (1 - a) * e_(i-1), a = 2 / (span + 1). A missing value carries the mean on, and the
    next value weighs it less for each missing row (operators.scan)."""
    return recursive_means(df, spec, {f"{column}_ema_{span:g}": (F.col(column), 2 / (span + 1))})


def macd(df: DataFrame, spec: PanelSpec, column: str, fast: float = 12, slow: float = 26, signal: float = 9) -> DataFrame:
    """macd = ema(fast) - ema(slow), its ema as macd_signal, and macd_hist."""
    f, s = free(df, "fast", "slow")
    both = recursive_means(df, spec, {f: (F.col(column), 2 / (fast + 1)), s: (F.col(column), 2 / (slow + 1))})
    both = both.select(*df.columns, (F.col(f) - F.col(s)).alias("macd"))
    return recursive_means(both, spec, {"macd_signal": (F.col("macd"), 2 / (signal + 1))}).withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))


@halo(before=lambda a: 1)
def _volume_delta(df: DataFrame, spec: PanelSpec, volume: str) -> DataFrame:
    return df.withColumn("volume_delta", F.col(volume) - F.lag(volume, 1).over(spec.window()))


def technical(df: DataFrame, spec: PanelSpec, close: str, volume: str) -> DataFrame:
    """RSI 14 (simple means), volume step, EMA 12 and 26, MACD per group."""
    step = rsi(_volume_delta(df, spec, volume), spec, close)
    means = recursive_means(step, spec, {f"{close}_ema_{n}": (F.col(close), 2 / (n + 1)) for n in (12, 26)})
    return macd(means, spec, close)


def average_rank(df: DataFrame, column: str, within: str | None = None, most: int = 100_000) -> DataFrame:
    """rank_{c}: rank with ties averaged, over the whole table or within a column's groups; null for null.

    Over the whole table only the distinct values are ordered, range by range (operators.order): a window holds one range
    of about `most` values, or one row for each range.
    """
    name = f"rank_{column}"
    if within:
        w = Window.partitionBy(within)
        ties = Window.partitionBy(within, column)
        return df.withColumn(name, F.when(F.col(column).isNotNull(), F.rank().over(w.orderBy(F.col(column).asc_nulls_last())) + (F.count("*").over(ties) - 1) / 2))
    counts, part = value_counts(df.filter(F.col(column).isNotNull()), column, most)
    before = counts.groupBy(part).agg(F.sum("n").alias("t"))
    offset = before.select(part, (F.sum("t").over(Window.orderBy(part)) - F.col("t")).alias("o"))
    run = F.sum("n").over(Window.partitionBy(part).orderBy(column))
    (v,) = free(df, "ranked_value")
    ranked = counts.join(F.broadcast(offset), part).select(F.col(column).alias(v), (F.col("o") + run - F.col("n") + (F.col("n") + 1) / 2).alias(name))
    return df.join(ranked, F.col(column) == F.col(v), "left").drop(v)


@halo(before=lambda a: max([*(n - 1 for n in a["sizes"]), *a["steps"], 0]))
def rolling_and_lags(df: DataFrame, spec: PanelSpec, columns: Iterable[str], sizes: Iterable[int], steps: Iterable[int]) -> DataFrame:
    """Rolling and lag features in one select."""
    w, columns = spec.window(), list(columns)
    out = [rolled(F.col(c), spec, n, fn).alias(f"{c}_roll_{n}_{fn}") for c in columns for n in sizes for fn in ("mean", "std", "max", "min")]
    return spec.check(df).select("*", *out, *(F.lag(c, k).over(w).alias(f"{c}_lag_{k}") for c in columns for k in steps))


def generate(df: DataFrame, spec: PanelSpec, columns: Iterable[str], sizes: Iterable[int], steps: Iterable[int], spans: Iterable[float] = ()) -> DataFrame:
    """Rolling and lag features in one select, then exponentially weighted means."""
    columns = list(columns)
    df = rolling_and_lags(df, spec, columns, sizes, steps)
    for c in columns:
        for s in spans:
            df = ewm_mean(df, spec, c, s)
    return df
