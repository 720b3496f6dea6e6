"""Window, math and history queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rowmath
from ..operators import history, spectral, windows
from ..shared import folder
from .define import BAR, BARS, NULLS, ORDERS, PANEL, Tables, W, frame, query, rounded

K = ["o_custkey", "o_orderdate", "o_orderkey"]
KEYS = "o_custkey, o_orderdate, o_orderkey"
FNS = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}


def _roll(n, fns=FNS, c="price"):
    return ", ".join(f"round({f}({c}) over {frame(n)}, 6) as {c}_roll_{n}_{k}" for k, f in fns.items())


@query(f"select {KEYS}, price, {_roll(7)}, {', '.join(f'lag(price, {k}) over {W} as price_lag_{k}' for k in (1, 2, 3))} from {PANEL}")
def rolling_orders(t: Tables):
    return rounded(windows.generate(t.panel(), ORDERS, ["price"], [7], [1, 2, 3]), 6, *(f"price_roll_7_{f}" for f in FNS))


@query(f"select {KEYS}, price, " + ", ".join(f"case when count(price) over {frame(n)} >= {n} then round({f}(price) over {frame(n)}, 6) end as price_roll_{n}_{k}" for n in (5, 20) for k, f in (FNS | {'std': 'stddev_pop'}).items()) + f" from {NULLS}")
def rolling_full_orders(t: Tables):
    df = windows.rolling(t.panel(True), ORDERS, ["price"], [5, 20], min_periods=None, ddof=0)
    return rounded(df, 6, *(c for c in df.columns if "_roll_" in c))


@query(f"select {KEYS}, price, " + ", ".join(_roll(n, FNS if n <= 14 else {'mean': 'avg', 'max': 'max'}) for n in (3, 7, 14, 28, 56)) + f" from {PANEL}")
def rolling_default_orders(t: Tables):
    df = windows.rolling(t.panel(), ORDERS, ["price"], mean_max_only_above=14)
    return rounded(df, 6, *(c for c in df.columns if "_roll_" in c))


@query(f"select {KEYS}, price, " + ", ".join(f"case when count(price) over {frame(n)} >= {n} then round({f}(price) over {frame(n)}, 6) end as price_roll_{n}_{k}" for n in (2, 5, 10, 20, 50, 100) for k, f in (('mean', 'avg'), ('std', 'stddev_samp'))) + f" from {PANEL}")
def rolling_wide_orders(t: Tables):
    df = windows.rolling(t.panel(), ORDERS, ["price"], (2, 5, 10, 20, 50, 100), ("mean", "std"), min_periods=None)
    return rounded(df, 6, *(c for c in df.columns if "_roll_" in c))


@query(f"select {KEYS}, price, " + ", ".join(f"lag(price, {k}) over {W} as price_lag_{k}" for k in (1, 2, 3, 5, 7, 14, 28)) + f" from {NULLS}")
def lag_orders(t: Tables):
    return windows.lags(t.panel(True), ORDERS, ["price"])


@query(f"select {KEYS}, price, lead(price, 1) over {W} as price_next_1, (lead(price, 1) over {W} > price)::int as price_up_1, lead(price, 5) over {W} as price_next_5, (lead(price, 5) over {W} > price)::int as price_up_5 from {PANEL}")
def lead_target_orders(t: Tables):
    return windows.leads(t.panel(), ORDERS, "price")


@query(f"select {KEYS}, price, " + ", ".join(f"round(price / lag(price, {k}) over {W} - 1, 6) as price_ret_{k}" for k in (1, 5, 10, 20)) + f", round(ln(price / lag(price, 1) over {W}), 6) as price_logret from {PANEL}")
def returns_orders(t: Tables):
    return rounded(windows.returns(t.panel(), ORDERS, "price"), 6)


@query(f"with b as {BAR} select event_type, day, round(volume, 6) as volume, round(ln(1 + volume), 6) as log_volume, round(ln(1 + volume) - lag(ln(1 + volume)) over (partition by event_type order by day), 6) as log_volume_change, case when count(volume) over w >= 10 then round(volume / avg(volume) over w, 6) end as volume_to_mean_10 from b window w as (partition by event_type order by day rows between 9 preceding and current row)")
def log_volume_bars(t: Tables):
    df = windows.volume_features(t.bars(), BARS, "volume")
    return rounded(df.select("event_type", "day", "volume", "log_volume", "log_volume_change", "volume_to_mean_10"))


@query(f"select {KEYS}, price, " + ", ".join(f"case when count(price) over {frame(10)} >= 10 then round(price / {f}(price) over {frame(10)} - 1, 6) end as price_to_{k}_10" for k, f in (("mean", "avg"), ("max", "max"), ("min", "min"))) + f" from {PANEL}")
def distance_orders(t: Tables):
    return rounded(windows.distances(t.panel(), ORDERS, "price", 10), 6)


@query(f"with r as (select *, price / lag(price, 1) over {W} - 1 as r from {PANEL}) select {KEYS}, price, round(price / lag(price, 10) over {W} - 1, 6) as price_mom_10, case when count(r) over {frame(10)} >= 10 then round(stddev_samp(r) over {frame(10)}, 6) end as price_vol_10 from r")
def momentum_orders(t: Tables):
    return rounded(windows.momentum(t.panel(), ORDERS, "price", 10), 6)


RSI = f"""with d as (select *, price - lag(price) over {W} as d from {PANEL}), g as (select *, case when d is not null then greatest(d, 0) end as g, case when d is not null then greatest(-d, 0) end as l from d),
m as (select {KEYS}, price, count(g) over {frame(14)} as n, avg(g) over {frame(14)} as g, avg(l) over {frame(14)} as l from g)
select {KEYS}, price, case when n >= 14 then case when l = 0 then 100.0 else round(100 - 100 / (1 + g / l), 6) end end as price_rsi_14 from m"""


@query(RSI)
def rsi_orders(t: Tables):
    return rounded(windows.rsi(t.panel(), ORDERS, "price", 14), 6)


@query(f"with m as (select *, count(price) over {frame(20)} as n, avg(price) over {frame(20)} as a, stddev_samp(price) over {frame(20)} as s from {PANEL}) select {KEYS}, price, case when n >= 20 then round(a + 2 * s, 6) end as price_bb_upper, case when n >= 20 then round(a - 2 * s, 6) end as price_bb_lower, case when n >= 20 then round(4 * s / a, 6) end as price_bb_width from m")
def bollinger_orders(t: Tables):
    return rounded(windows.bollinger(t.panel(), ORDERS, "price"), 6)


@query(f"select {KEYS}, price, " + ", ".join(f"case when count(price) over {frame(n)} >= {n} then round(avg(price) over {frame(n)}, 6) end as price_sma_{n}" for n in (5, 10, 20)) + f" from {PANEL}")
def sma_orders(t: Tables):
    return rounded(windows.sma(t.panel(), ORDERS), 6)


@query(f"with b as {BAR}, s as (select event_type, day, close, volume, coalesce(sign(close - lag(close) over (partition by event_type order by day)) * volume, 0.0) as st from b) select event_type, day, round(st, 6) as obv_step, round(sum(st) over (partition by event_type order by day rows unbounded preceding), 4) as obv from s")
def obv_events(t: Tables):
    df = windows.on_balance_volume(t.bars(), BARS, "close", "volume").select("event_type", "day", "obv_step", "obv")
    return rounded(rounded(df, 6, "obv_step"), 4, "obv")


@query(f"with b as {BAR} select event_type, day, round(close - open, 6) as price_change, round(high - low, 6) as price_range, round(volume * (close - open), 4) as volume_change from b")
def bar_steps_events(t: Tables):
    df = windows.bar_steps(t.bars(), "open", "high", "low", "close", "volume").select("event_type", "day", "price_change", "price_range", "volume_change")
    return rounded(rounded(df, 6, "price_change", "price_range"), 4, "volume_change")


def _ewm(span):
    q = 1 - 2 / (span + 1)
    return f"with r as (select *, row_number() over {W} as n from {NULLS}) select a.o_custkey, a.o_orderdate, a.o_orderkey, a.price, round(sum(b.price * pow({q!r}, a.n - b.n)) / sum(case when b.price is not null then pow({q!r}, a.n - b.n) end), 6) as price_ewm_{span} from r a join r b on a.o_custkey = b.o_custkey and b.n <= a.n group by all"


@query(_ewm(20))
def ewm_orders(t: Tables):
    return rounded(windows.ewm_mean(t.panel(True), ORDERS, "price", 20), 6, "price_ewm_20")


_Q = repr(1 - 2 / 21)


@query(f"""with r as (select *, row_number() over {W} as n from {NULLS}),
s as (select a.o_custkey, a.o_orderdate, a.o_orderkey, a.price, sum(b.price * pow({_Q}, a.n - b.n)) as s1, sum(case when b.price is not null then pow({_Q}, a.n - b.n) end) as w, sum(case when b.price is not null then pow({_Q}, 2 * (a.n - b.n)) end) as w2, sum((b.price - m.m) * pow({_Q}, a.n - b.n)) as c1, sum((b.price - m.m) * (b.price - m.m) * pow({_Q}, a.n - b.n)) as c2
from r a join r b on a.o_custkey = b.o_custkey and b.n <= a.n cross join (select avg(price) as m from r) m group by all)
select {KEYS}, price, case when w * w - w2 > 1e-12 then round(sqrt(greatest((c2 / w - (c1 / w) * (c1 / w)) * w * w / (w * w - w2), 0)), 3) end as price_ewm_std_20 from s""")
def ewm_std_orders(t: Tables):
    return rounded(windows.ewm_std(t.panel(True), ORDERS, "price", 20), 3, "price_ewm_std_20")


def _ema_cte(name, source, column, span):
    a = 2 / (span + 1)
    return f"{name} as (select a.o_orderkey, sum(case when b.n = 1 then b.{column} else {a!r} * b.{column} end * pow({1 - a!r}, a.n - b.n)) as e from {source} a join {source} b on a.o_custkey = b.o_custkey and b.n <= a.n group by a.o_orderkey)"


@query(f"""with r as (select *, row_number() over {W} as n from {PANEL}), {_ema_cte('f', 'r', 'price', 12)}, {_ema_cte('s', 'r', 'price', 26)},
m as (select r.*, f.e - s.e as macd from r join f using (o_orderkey) join s using (o_orderkey)), {_ema_cte('g', 'm', 'macd', 9)}
select {KEYS}, price, round(macd, 4) as macd, round(g.e, 4) as macd_signal, round(macd - g.e, 4) as macd_hist from m join g using (o_orderkey)""")
def macd_orders(t: Tables):
    return rounded(windows.macd(t.panel(), ORDERS, "price"), 4, "macd", "macd_signal", "macd_hist")


@query(f"with r as (select *, row_number() over {W} as n from {PANEL}), {_ema_cte('f', 'r', 'price', 12)} select {KEYS}, price, round(f.e, 4) as price_ema_12 from r join f using (o_orderkey)")
def ema_orders(t: Tables):
    return rounded(windows.ema(t.panel(), ORDERS, "price", 12), 4, "price_ema_12")


@query("select l_orderkey, l_linenumber, l_quantity, l_partkey, rank() over (order by l_quantity) + (count(*) over (partition by l_quantity) - 1) / 2 as rank_l_quantity from lineitem")
def avg_rank_lineitem(t: Tables):
    return windows.average_rank(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey"), "l_quantity")


@query("select o_orderkey, o_orderdate, o_totalprice, rank() over (partition by o_orderdate order by o_totalprice) + (count(*) over (partition by o_orderdate, o_totalprice) - 1) / 2 as rank_o_totalprice from orders")
def date_rank_orders(t: Tables):
    return windows.average_rank(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), "o_totalprice", within="o_orderdate")


# row-wise math

L = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
LK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _made(t: Tables, made, digits=6):
    df = rowmath.add(t.lineitem.select(*LK, *NUM), made)
    return rounded(df.select(*LK, *(F.col(f"`{c}`").alias(c.replace("*", "_by_")) for c in made)), digits)


BASIC = {"log": "ln(greatest({x}, 1e-10))", "log1p": "ln(1 + abs({x}))", "exp": "exp(least({x}, 10.0))", "expm1": "exp(least({x}, 10.0)) - 1", "square": "{x} * {x}", "sqrt": "sqrt(abs({x}))", "cube": "{x} * {x} * {x}", "cbrt": "cbrt({x})", "reciprocal": "1 / (abs({x}) + 1e-10)", "sigmoid": "1 / (1 + exp(-{x}))"}


@query(f"select {L}, " + ", ".join(f"round({e.format(x=c)}, 4) as {c}_{n}" for c in ("l_quantity", "l_tax") for n, e in BASIC.items()) + " from lineitem")
def math_basic(t: Tables):
    return _made(t, rowmath.basic(["l_quantity", "l_tax"], BASIC), 4)


TRIG = {"sin": "sin(least(greatest({x}, -10), 10))", "cos": "cos(least(greatest({x}, -10), 10))", "tanh": "tanh(least(greatest({x}, -10), 10))", "tan": "tan(least(greatest({x}, -1.5), 1.5))", "sinh": "sinh(least(greatest({x}, -5), 5))", "cosh": "cosh(least(greatest({x}, -5), 5))", "sin_scaled": "sin(tanh({x}) * pi())", "cos_scaled": "cos(tanh({x}) * pi())", "tanh_scaled": "tanh(tanh({x}) * pi())"}


@query(f"select {L}, " + ", ".join(f"round({e.format(x='l_discount')}, 6) as l_discount_{n}" for n, e in TRIG.items()) + " from lineitem")
def math_trig(t: Tables):
    return _made(t, rowmath.basic(["l_discount"], TRIG))


@query(f"select {L}, " + ", ".join(f"round(pow({c}, {d}), 6) as {c}_pow{d}" for c in ("l_discount", "l_quantity") for d in (2, 3, 4)) + " from lineitem")
def math_powers(t: Tables):
    return _made(t, rowmath.power_columns(["l_discount", "l_quantity"], 4))


@query(f"select {L}, " + ", ".join(f"round({' * '.join(x)}, 4) as {'_by_'.join(x)}" for x in ([a] for a in ("l_quantity", "l_discount", "l_tax"))) + ", " + ", ".join(f"round({a} * {b}, 4) as {a}_by_{b}" for a, b in (("l_quantity", "l_quantity"), ("l_quantity", "l_discount"), ("l_quantity", "l_tax"), ("l_discount", "l_discount"), ("l_discount", "l_tax"), ("l_tax", "l_tax"))) + " from lineitem")
def math_polynomial(t: Tables):
    df = rowmath.add(t.lineitem.select(*LK, "l_quantity", "l_discount", "l_tax").toDF(*LK, "a", "b", "c"), {f"{k}_": v for k, v in rowmath.polynomial(["a", "b", "c"], 2).items()})
    names = {"a": "l_quantity", "b": "l_discount", "c": "l_tax"}
    return rounded(df.select(*LK, *(F.col(f"`{k}_`").alias("_by_".join(names[x] for x in k.split("*"))) for k in rowmath.polynomial(["a", "b", "c"], 2))), 4)


@query(f"select {L}, round(l_quantity + l_tax, 6) as l_quantity_add_l_tax, round(l_quantity * l_tax, 6) as l_quantity_mul_l_tax, round(l_quantity / (abs(l_tax) + 1e-2), 6) as l_quantity_div_l_tax from lineitem")
def pair_features(t: Tables):
    return _made(t, rowmath.near_pairs(["l_quantity", "l_tax"], eps=1e-2))


@query(f"select {L}, " + ", ".join(f"round({a} * {b}, 4) as {a}_by_{b}" for a, b in (("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount"))) + " from lineitem")
def pair_products(t: Tables):
    return _made(t, rowmath.pair_products(["l_quantity", "l_extendedprice", "l_discount"]), 4)


@query("select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, round(l_extendedprice * p_retailprice, 4) as l_extendedprice_x_p_retailprice, round(l_extendedprice / p_retailprice, 6) as l_extendedprice_ratio_p_retailprice from lineitem l join part p on l.l_partkey = p.p_partkey")
def price_ratio(t: Tables):
    df = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    made = rowmath.edge_pairs(["l_extendedprice", "p_retailprice"])
    out = rowmath.add(df, made).select(*LK, *made)
    return rounded(rounded(out, 4, "l_extendedprice_x_p_retailprice"), 6, "l_extendedprice_ratio_p_retailprice")


@query(f"select {L}, round(a * b, 4) as a_b_prod2, round(a * c, 4) as a_c_prod2, round(b * c, 4) as b_c_prod2, round(a * b * c, 4) as a_b_c_prod3 from (select {L}, coalesce(case when l_orderkey % 17 <> 0 then l_quantity end, 1) as a, l_discount as b, l_tax as c from lineitem)")
def k_products(t: Tables):
    df = t.lineitem.select(*LK, F.when(F.col("l_orderkey") % 17 != 0, F.col("l_quantity")).alias("a"), F.col("l_discount").alias("b"), F.col("l_tax").alias("c"))
    made = rowmath.k_products(["a", "b", "c"], 3)
    return rounded(rowmath.add(df, made).select(*LK, *made), 4)


ROWS = "(select *, [l_quantity, l_extendedprice / 1000, l_discount * 100, l_tax * 100] as x from lineitem)"


@query(f"""with m as (select {L}, list_avg(x) as mean, list_stddev_samp(x) as std, list_skewness(x) as skew, list_kurtosis(x) as kurt, {', '.join(f"list_aggregate(x, 'quantile_cont', {q}) as q{round(100 * q)}" for q in (0.1, 0.25, 0.5, 0.75, 0.9))} from {ROWS})
select {L}, round(mean, 8) as l_mean, round(std, 8) as l_std, round(skew, 8) as l_skew, round(kurt, 8) as l_kurt, {', '.join(f'round(q{q}, 8) as l_q{q}' for q in (10, 25, 50, 75, 90))} from m""")
def row_stats(t: Tables):
    df = t.lineitem.select(*LK, "l_quantity", (F.col("l_extendedprice") / 1000).alias("p"), (F.col("l_discount") * 100).alias("d"), (F.col("l_tax") * 100).alias("x"))
    made = rowmath.row_statistics(["l_quantity", "p", "d", "x"], "l")
    return rounded(rowmath.add(df, made).select(*LK, *made), 8)


@query()
def spectral_events(t: Tables):
    return spectral.spectral_features(t.bars(), BARS, "close")


# history

HIST = """with v as (select user_id as entity, event_type as feature, round(value)::bigint::varchar as value, ts as valid_from, event_id from events),
p as (select *, lag(value) over w as prev, row_number() over w as n from v window w as (partition by entity, feature order by valid_from, event_id)),
h as (select entity, feature, value, valid_from, lead(valid_from) over (partition by entity, feature order by valid_from, event_id) as valid_to from p where n = 1 or value is distinct from prev)"""


def _history(t: Tables):
    v = t.events.select(F.col("user_id").alias("entity"), F.col("event_type").alias("feature"), F.round("value").cast("long").cast("string").alias("value"), F.col("ts").alias("valid_from"), "event_id")
    return history.validity_history(v, ("event_id",))


@query(HIST + " select * from h")
def history_rows(t: Tables):
    return _history(t)


AT = "2024-01-20 00:00:00"


@query(HIST + f", l as (select * from h where valid_from <= timestamp '{AT}' and (valid_to is null or valid_to > timestamp '{AT}')) select entity, max(value) filter (feature = 'click') as click, max(value) filter (feature = 'purchase') as purchase, max(value) filter (feature = 'view') as view from l group by entity")
def snapshot_asof(t: Tables):
    return history.as_of(_history(t), AT, ["click", "purchase", "view"])


@query(HIST + ", d as (select unnest(generate_series(date '2024-01-05', date '2024-01-25', interval 5 day))::date as snapshot) select snapshot, entity, feature, value from d join h on valid_from <= snapshot and (valid_to is null or valid_to > snapshot)")
def snapshot_series(t: Tables):
    return history.snapshot_series(_history(t), "2024-01-05", "2024-01-25", 5)


@query(HIST + ", a as (select * from h where valid_from <= timestamp '2024-01-10' and (valid_to is null or valid_to > timestamp '2024-01-10')), b as (select * from h where valid_from <= timestamp '2024-01-20' and (valid_to is null or valid_to > timestamp '2024-01-20')) select coalesce(a.entity, b.entity) as entity, coalesce(a.feature, b.feature) as feature, a.value as old_value, b.value as new_value from a full join b on a.entity = b.entity and a.feature = b.feature where a.value is distinct from b.value or (a.entity is null) <> (b.entity is null)")
def delta_between(t: Tables):
    return history.delta(_history(t), "2024-01-10", "2024-01-20")


@query(HIST + " select * from h where entity = 7 and feature = 'click'")
def value_history(t: Tables):
    return history.value_history(_history(t), 7, "click")


@query("""with v as (select user_id::varchar as entity, event_type as feature, round(value)::bigint::varchar as value, ts as valid_from from events),
p as (select *, lag(value) over w as prev, row_number() over w as n from v window w as (partition by entity, feature order by valid_from, value))
select entity, feature, value, valid_from, lead(valid_from) over (partition by entity, feature order by valid_from, value) as valid_to from p where n = 1 or value is distinct from prev""")
def history_in_snapshots(t: Tables):
    """The history of all events, kept up over four snapshots of which the last repeats the third."""
    store = history.ValidityStore(t.spark, folder(t.spark, "validity"), buckets=16)
    v = t.events.select(F.col("user_id").alias("entity"), F.col("event_type").alias("feature"), F.round("value").cast("long").cast("string").alias("value"), F.col("ts").alias("valid_from"))
    cuts = ["1900-01-01", "2024-01-10", "2024-01-20", "2999-01-01"]
    for a, b in [*zip(cuts, cuts[1:], strict=False), ("2024-01-20", "2999-01-01")]:
        store.apply(f"until {b}", v.filter((F.col("valid_from") >= F.lit(a).cast("timestamp")) & (F.col("valid_from") < F.lit(b).cast("timestamp"))))
    return store.history()


@query("select o_custkey as entity, o_orderdate as valid_from, 'o_totalprice' as feature, o_totalprice::varchar as value from orders where false union all select o_custkey, o_orderdate, 'o_orderkey', o_orderkey::varchar from orders union all select o_custkey, o_orderdate, 'o_orderstatus', o_orderstatus from orders")
def melt_orders(t: Tables):
    return history.melt(t.orders, "o_custkey", "o_orderdate", ["o_orderkey", "o_orderstatus"])


