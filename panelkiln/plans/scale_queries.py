"""Queries over groups that hold a large share of all rows, and over many columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import custom
from ..operators import slices, windows
from ..spec import PanelSpec
from .define import KEYS, NULLS, ORDERS, Tables, W, frame, query, rounded

#: Three groups, one of which holds half of all rows, in slices.
HOT = PanelSpec("l_returnflag", "l_shipdate", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), target=None, slice_rows=10_000)
HK = "l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey"
HW = "(partition by l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)"
FNS = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}


def _hot(t: Tables, *columns: str):
    return t.lineitem.select(*HK.split(", "), *columns)


@query(f"select {HK}, l_extendedprice, " + ", ".join(f"round({f}(l_extendedprice) over {frame(n, HW)}, {1 if k == 'std' else 4}) as l_extendedprice_roll_{n}_{k}" for n in (3, 7, 28) for k, f in FNS.items()) + " from lineitem")
def hot_rolling_lineitem(t: Tables):
    df = windows.rolling(_hot(t, "l_extendedprice"), HOT, ["l_extendedprice"], (3, 7, 28))
    made = [c for c in df.columns if "_roll_" in c]
    return rounded(rounded(df, 1, *(c for c in made if "std" in c)), 4, *(c for c in made if "std" not in c))


@query(f"select {HK}, l_extendedprice, " + ", ".join(f"lag(l_extendedprice, {k}) over {HW} as l_extendedprice_lag_{k}" for k in (1, 2, 3, 5, 7, 14, 28)) + " from lineitem")
def hot_lags_lineitem(t: Tables):
    return windows.lags(_hot(t, "l_extendedprice"), HOT, ["l_extendedprice"])


@query(f"select {HK}, l_extendedprice, " + ", ".join(f"lead(l_extendedprice, {k}) over {HW} as l_extendedprice_next_{k}, (lead(l_extendedprice, {k}) over {HW} > l_extendedprice)::int as l_extendedprice_up_{k}" for k in (1, 5)) + " from lineitem")
def hot_targets_lineitem(t: Tables):
    return windows.leads(_hot(t, "l_extendedprice"), HOT, "l_extendedprice")


@query(f"select {HK}, l_quantity, l_extendedprice, round(coalesce(sign(l_extendedprice - lag(l_extendedprice) over {HW}) * l_quantity, 0), 4) as obv_step, round(sum(s) over ({HW[1:-1]} rows unbounded preceding), 4) as obv from (select *, coalesce(sign(l_extendedprice - lag(l_extendedprice) over {HW}) * l_quantity, 0) as s from lineitem)")
def hot_volume_lineitem(t: Tables):
    return rounded(windows.on_balance_volume(_hot(t, "l_quantity", "l_extendedprice"), HOT, "l_extendedprice", "l_quantity"), 4, "obv", "obv_step")


_D = f"select *, l_quantity - lag(l_quantity) over {HW} as d, l_quantity / lag(l_quantity) over {HW} - 1 as r from lineitem"


@query(
    f"""with d as ({_D}), w as (select *, count(d) over {frame(14, HW)} as c, avg(greatest(d, 0)) over {frame(14, HW)} as g, avg(greatest(-d, 0)) over {frame(14, HW)} as l, count(*) over {frame(20, HW)} as n, avg(l_quantity) over {frame(20, HW)} as m, stddev_samp(l_quantity) over {frame(20, HW)} as s, count(r) over {frame(10, HW)} as k, stddev_samp(r) over {frame(10, HW)} as v from d)
select {HK}, l_quantity, case when c >= 14 then case when l = 0 then 100.0 else round(100 - 100 / (1 + g / l), 4) end end as l_quantity_rsi_14, case when n >= 20 then round(m + 2 * s, 4) end as l_quantity_bb_upper, case when n >= 20 then round(m - 2 * s, 4) end as l_quantity_bb_lower, case when n >= 20 then round(4 * s / m, 4) end as l_quantity_bb_width,
round(l_quantity / lag(l_quantity, 10) over {HW} - 1, 4) as l_quantity_mom_10, case when k >= 10 then round(v, 4) end as l_quantity_vol_10 from w"""
)
def hot_indicators_lineitem(t: Tables):
    df = _hot(t, "l_quantity")
    out = slices.together(df, HOT, (windows.rsi, "l_quantity"), (windows.bollinger, "l_quantity"), (windows.momentum, "l_quantity", 10))
    return rounded(out, 4, *out.columns[len(df.columns) :])


def _last_rows(span: int, rows: int) -> str:
    """The recursive mean by its last rows; what lies before them weighs less than a double can tell."""
    q, a = 1 - 2 / (span + 1), 2 / (span + 1)
    x = f"list_reverse(array_agg(l_extendedprice) over {frame(rows, HW)})"
    return f"list_sum(list_transform(range(len(x)), lambda k: x[k + 1] * pow({q!r}, k) * case when k = len(x) - 1 then 1 else {a!r} end)) as e from (select {HK}, l_extendedprice, {x} as x from lineitem)"


@query(f"select {HK}, l_extendedprice, round(e, 4) as l_extendedprice_ema_5 from (select {HK}, l_extendedprice, {_last_rows(5, 120)})")
def hot_ema_lineitem(t: Tables):
    return rounded(windows.ema(_hot(t, "l_extendedprice"), HOT, "l_extendedprice", 5), 4, "l_extendedprice_ema_5")


_Q, _A = repr(1 - 2 / 13), repr(2 / 13)


@query(
    f"""with recursive r as (select *, row_number() over {W} as n from {NULLS}),
e as (select o_custkey, n, price as e, 1.0::double as w from r where n = 1
union all select r.o_custkey, r.n, case when price is null then e when e is null then price else (w * {_Q} * e + {_A} * price) / (w * {_Q} + {_A}) end, case when price is not null or e is null then 1.0::double else w * {_Q} end from e join r on r.o_custkey = e.o_custkey and r.n = e.n + 1)
select {KEYS}, price, round(e, 4) as price_ema_12 from r join e using (o_custkey, n)"""
)
def ema_gaps_orders(t: Tables):
    return rounded(windows.ema(t.panel(True), ORDERS, "price", 12), 4, "price_ema_12")


class SlopeModel:
    """A user's model: the sum of each feature times its own slope."""

    def __init__(self, features: list[str]):
        self.features = features

    def fit(self, df, label: str = "target"):
        self.slopes = df.agg(*(F.regr_slope(label, f).alias(f) for f in self.features)).first()
        return self

    def transform(self, df):
        return df.withColumn("prediction", sum((F.col(f) * self.slopes[f] for f in self.features), F.lit(0.0)))


@query(
    """with r as (select o_custkey::double as c, day(o_orderdate)::double as d, o_totalprice / 1000 + 3 * day(o_orderdate) as y, row_number() over (order by o_orderkey) - 1 as i, count(*) over () as n from orders),
s as (select regr_slope(y, c) as sc, regr_slope(y, d) as sd from r),
b as (select r.*, o.c as oc, o.d as od, sc, sd from r join r o on o.i = (r.i + r.n // 2) % r.n cross join s)
select 'cust' as feature, round(avg(pow(sc * oc + sd * d - y, 2)) - avg(pow(sc * c + sd * d - y, 2)), 4) as importance from b
union all select 'day', round(avg(pow(sc * c + sd * od - y, 2)) - avg(pow(sc * c + sd * d - y, 2)), 4) from b"""
)
def user_importance_orders(t: Tables):
    day = F.dayofmonth("o_orderdate").cast("double")
    rows = t.orders.select("o_orderkey", F.col("o_custkey").cast("double").alias("cust"), day.alias("day"), (F.col("o_totalprice") / 1000 + 3 * day).alias("target"))
    return rounded(custom.user_importance(SlopeModel(["cust", "day"]).fit(rows), rows, ["cust", "day"], order=["o_orderkey"]), 4, "importance")
