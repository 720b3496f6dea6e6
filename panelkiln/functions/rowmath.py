"""Row-wise math features as generated expressions: one select, no Python in tasks."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable
from functools import reduce
from itertools import combinations, combinations_with_replacement
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Expressions in one select; above it code generation gives up, so wide plans are cut.
MOST_EXPRESSIONS = 200


def _lim(x: Column, a: float) -> Column:
    return F.least(F.greatest(x, F.lit(-a)), F.lit(a))


def transforms(eps: float = 1e-10) -> dict[str, Callable[[Column], Column]]:
    """Name and expression of each basic transform; eps keeps the reciprocal finite."""
    return {
        "log": lambda x: F.ln(F.greatest(x, F.lit(1e-10))),
        "log1p": lambda x: F.log1p(F.abs(x)),
        "exp": lambda x: F.exp(F.least(x, F.lit(10.0))),
        "expm1": lambda x: F.expm1(F.least(x, F.lit(10.0))),
        "square": lambda x: x * x,
        "sqrt": lambda x: F.sqrt(F.abs(x)),
        "cube": lambda x: x * x * x,
        "cbrt": lambda x: F.cbrt(x),
        "reciprocal": lambda x: F.lit(1.0) / (F.abs(x) + eps),
        "sigmoid": lambda x: F.lit(1.0) / (F.exp(-x) + 1),
        "sin": lambda x: F.sin(_lim(x, 10.0)),
        "cos": lambda x: F.cos(_lim(x, 10.0)),
        "tanh": lambda x: F.tanh(_lim(x, 10.0)),
        "tan": lambda x: F.tan(_lim(x, 1.5)),
        "sinh": lambda x: F.sinh(_lim(x, 5.0)),
        "cosh": lambda x: F.cosh(_lim(x, 5.0)),
        "sin_scaled": lambda x: F.sin(F.tanh(x) * pi),
        "cos_scaled": lambda x: F.cos(F.tanh(x) * pi),
        "tanh_scaled": lambda x: F.tanh(F.tanh(x) * pi),
    }


def _num(c: str) -> Column:
    return F.col(c).cast("double")


def add(df: DataFrame, made: dict[str, Column]) -> DataFrame:
    """df with the made columns, in selects of a bounded width."""
    items = list(made.items())
    for at in range(0, len(items), MOST_EXPRESSIONS):
        df = df.select("*", *(c.alias(n) for n, c in items[at : at + MOST_EXPRESSIONS]))
    return df


def basic(columns: Iterable[str], names: Iterable[str], eps: float = 1e-10) -> dict[str, Column]:
    table = transforms(eps)
    return {f"{c}_{n}": table[n](_num(c)) for c in columns for n in names}


def power_columns(columns: Iterable[str], degree: int) -> dict[str, Column]:
    return {f"{c}_pow{d}": F.pow(_num(c), F.lit(float(d))) for c in columns for d in range(2, degree + 1)}


def polynomial(columns: Iterable[str], degree: int = 2) -> dict[str, Column]:
    """All monomials up to degree, without the constant; named by their factors."""
    columns = list(columns)
    return {"*".join(t): reduce(lambda a, b: a * b, map(_num, t)) for d in range(1, degree + 1) for t in combinations_with_replacement(columns, d)}


def pair_products(columns: Iterable[str], most: int = 2000, seed: int = 42) -> dict[str, Column]:
    pairs = list(combinations(list(columns), 2))
    pairs = pairs if len(pairs) <= most else sorted(random.Random(seed).sample(pairs, most))
    return {f"{a}*{b}": _num(a) * _num(b) for a, b in pairs}


def near_pairs(columns: Iterable[str], first: int = 20, reach: int = 10, eps: float = 1e-8) -> dict[str, Column]:
    """Sum, product and ratio a / (|b| + eps) of columns at most `reach` - 1 places apart."""
    columns, out = list(columns), {}
    for i, a in enumerate(columns[:first]):
        for b in columns[i + 1 : i + reach]:
            out |= {f"{a}_add_{b}": _num(a) + _num(b), f"{a}_mul_{b}": _num(a) * _num(b), f"{a}_div_{b}": _num(a) / (F.abs(_num(b)) + eps)}
    return out


def edge_pairs(columns: Iterable[str], edge: int = 5, least: float = 1e-4) -> dict[str, Column]:
    """Products of the first and last columns; a ratio where both names hold "price" and the divisor is large enough."""
    columns = list(columns)
    chosen = columns if len(columns) <= 2 * edge else columns[:edge] + columns[-edge:]
    out = {}
    for a, b in combinations(chosen, 2):
        out[f"{a}_x_{b}"] = _num(a) * _num(b)
        if "price" in a.lower() and "price" in b.lower():
            out[f"{a}_ratio_{b}"] = F.when(F.abs(_num(b)) >= least, F.try_divide(_num(a), _num(b)))
    return out


def k_products(columns: Iterable[str], k: int, most: int = 50_000, seed: int = 42) -> dict[str, Column]:
    """Products of 2 to k columns, a null counting as 1; at most most // k for each order."""
    columns, out = list(columns), {}
    for d in range(2, k + 1):
        all_of = list(combinations(columns, d))
        for t in all_of if len(all_of) <= most // k else sorted(random.Random(seed).sample(all_of, most // k)):
            out["_".join(t) + f"_prod{d}"] = reduce(lambda a, b: a * b, (F.coalesce(_num(c), F.lit(1.0)) for c in t))
    return out


def row_statistics(columns: Iterable[str], name: str, quantiles: Iterable[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> dict[str, Column]:
    """Mean, sample deviation, bias-corrected skew and excess kurtosis and linear quantiles over columns, nulls skipped.

    Skew is null under 3 values, kurtosis under 4, both at no variance.
    """
    # sums over the columns themselves, without lambda functions, stay in generated code
    names = list(columns)
    cols = [F.nanvl(_num(c), F.lit(None).cast("double")) for c in names]
    total = lambda xs: sum((F.coalesce(x, F.lit(0.0)) for x in xs), F.lit(0.0))
    n = total(x.isNotNull().cast("double") for x in cols)
    mean = F.try_divide(total(cols), n)
    m2, m3, m4 = (total(reduce(lambda a, b: a * b, [x - mean] * p) for x in cols) for p in (2, 3, 4))
    std = F.when(n >= 2, F.sqrt(F.try_divide(m2, n - 1)))
    skew = F.when((n >= 3) & (m2 > 0), F.try_divide(n * F.sqrt(n - 1), n - 2) * F.try_divide(m3, F.pow(m2, F.lit(1.5))))
    kurt = F.when((n >= 4) & (m2 > 0), F.try_divide(n * (n + 1) * (n - 1) * m4, (n - 2) * (n - 3) * m2 * m2) - F.try_divide(3 * (n - 1) * (n - 1), (n - 2) * (n - 3)))
    # sort_array is generated code; without a condition around it the sorted array is shared by all quantiles
    s = F.sort_array(F.array_compact(F.array(*cols)))

    def quantile(q: float) -> Column:
        at = (n - 1) * q
        low, high = F.floor(at).cast("int"), F.ceil(at).cast("int")
        a, b = F.get(s, low), F.get(s, high)
        return a + (b - a) * (at - low)  # without values no place holds any

    return {f"{name}_mean": mean, f"{name}_std": std, f"{name}_skew": skew, f"{name}_kurt": kurt} | {f"{name}_q{round(100 * q)}": quantile(q) for q in quantiles}


def noise_columns(keys: Iterable[str], mean: float, std: float, count: int = 3, seed: int = 42) -> dict[str, Column]:
    """random_baseline_{i}: normal noise from the row's key (Box-Muller), the same for any partitioning."""
    from ..operators.clean import key_number

    keys, m, out = list(keys), float(1 << 52), {}
    for i in range(count):
        u, v = ((key_number(keys, seed + 2 * i + j) + 1) / (m + 1) for j in (0, 1))
        out[f"random_baseline_{i}"] = F.lit(mean) + std * F.sqrt(-2 * F.ln(u)) * F.cos(2 * pi * v)
    return out


def all_transforms(columns: Iterable[str], basic_names: Iterable[str] = ("log1p", "sqrt", "square", "reciprocal"), trig: bool = True, degree: int = 2, pairs: int = 2000) -> dict[str, Column]:
    columns = list(columns)
    out = basic(columns, basic_names)
    out |= basic(columns, ("sin_scaled", "cos_scaled", "tanh_scaled")) if trig else {}
    out |= power_columns(columns, degree) if degree > 1 else {}
    return out | (pair_products(columns, pairs) if pairs else {})
