"""Cleaning, join, aggregate, selection, split, model and run-metric queries."""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement
from operator import mul

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from .. import shared
from ..functions import custom
from ..operators import clean, ensemble, joins, modeling, run_metrics, selection, split, stats
from ..sources import io
from ..sources.column_groups import ColumnGroups
from ..spec import PanelSpec
from .define import NULLS, ORDERS, PANEL, Tables, query, rounded
from .panel_queries import LK, NUM

L4 = ", ".join(LK)


def folder(t: Tables, name: str) -> str:
    """A folder all executors share, for queries that write and read again."""
    return shared.folder(t.spark, name)


# cleaning


_KIND = "(select case when max({c}) < 32768 then 'smallint' when max({c}) < 2147483648 then 'int' else 'bigint' end from orders) as {c}_type"


@query(f"select o_orderkey, o_custkey, round(o_totalprice::float::double, 2) as o_totalprice, {_KIND.format(c='o_orderkey')}, {_KIND.format(c='o_custkey')}, 'float' as o_totalprice_type from orders")
def reduce_precision(t: Tables):
    df = clean.reduce_precision(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"))
    return df.select("*", *(F.lit(kind).alias(f"{c}_type") for c, kind in df.dtypes)).withColumn("o_totalprice", F.round(F.col("o_totalprice").cast("double"), 2))


ID = "concat_ws('_', o_custkey, strftime(o_orderdate, '%Y-%m-%d'))"


@query(f"select o_orderkey, {ID} as id, o_custkey::varchar as asset, o_custkey::varchar as symbol, strftime(o_orderdate, '%Y-%m-%d') as date from orders")
def conform_keys(t: Tables):
    df = t.orders.select("o_orderkey", F.concat_ws("_", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("id"))
    return clean.conform_keys(df)


@query("select event_id, coalesce(try_cast(case when event_id % 5 = 0 then 'soon' else strftime(ts, '%Y-%m-%d') end as timestamp), timestamp '2000-01-01') as t from events")
def lenient_timestamps(t: Tables):
    text = F.when(F.col("event_id") % 5 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return t.events.select("event_id", clean.lenient_timestamp(text).alias("t"))


@query("select o_orderkey, o_custkey from orders where o_custkey in (1, 2, 3, 5, 8, 13, 21)")
def filter_symbols(t: Tables):
    return clean.filter_symbols(t.orders.select("o_orderkey", "o_custkey"), [1, 2, 3, 5, 8, 13, 21], "o_custkey")


@query("select o_custkey, o_orderdate, o_orderkey, o_totalprice from orders")
def extract_features(t: Tables):
    return clean.extract_features(t.orders, ORDERS)


@query("select o_custkey, o_orderdate, o_totalprice from orders")
def keep_required(t: Tables):
    return clean.keep_required(t.orders, ORDERS, ["o_totalprice", "absent"])[0]


@query(f"select o_orderkey, coalesce(price, 0.0) as price, 0.0::double as absent from {NULLS}")
def align_to_model(t: Tables):
    return clean.align_to_model(t.panel(True), ["o_orderkey"], ["price", "absent"])


@query("select o_orderkey, least(greatest(o_totalprice / 100000, 0.05), 0.95) as clipped, coalesce(case when o_orderkey % 17 <> 0 then o_totalprice / 100000 end, 0.5) as filled from orders")
def clip_and_fill(t: Tables):
    p = F.col("o_totalprice") / 100000
    gaps = F.when(F.col("o_orderkey") % 17 != 0, p).otherwise(F.lit(float("nan")))
    return t.orders.select("o_orderkey", clean.clip(p, 0.05, 0.95).alias("clipped"), clean.neutral(gaps).alias("filled"))


@query("select o_orderkey, " + ", ".join(f"(o_orderstatus = '{s}')::int as o_orderstatus_{s}" for s in "FOP") + " from orders")
def one_hot_orders(t: Tables):
    return clean.one_hot(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus").drop("o_orderstatus")


def _md5(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5({key} || ':{seed}'), 1, 13))::bigint"


@query(f"select o_orderkey, o_totalprice from orders where {_md5('o_orderkey')} < {int(0.1 * 2**52)}")
def hash_sample_orders(t: Tables):
    return clean.hash_sample(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 0.1)


@query("select o_orderkey, o_totalprice from orders where o_totalprice is not null")
def drop_noise_columns(t: Tables):
    df = t.orders.select("o_orderkey", "o_totalprice", F.lit(0.0).alias("random_baseline_0"))
    return clean.drop_prefixed(df).dropna(subset=["o_totalprice"])


@query(f"select o_custkey, o_orderdate, o_orderkey, round(coalesce(price, (select avg(price) from {NULLS})), 6) as price from {NULLS}")
def impute_mean_orders(t: Tables):
    return rounded(clean.impute_mean(t.panel(True), ["price"]), 6)


@query(f"select o_custkey, o_orderdate, o_orderkey, coalesce(price, 0) as price from {NULLS}")
def impute_zero_orders(t: Tables):
    return clean.impute_zero(t.panel(True), ["price"])


@query(f"select 'o_orderkey' as \"column\", 0::bigint as n_missing, count(*) as n_rows from orders union all select 'price', count(*) filter (price is null), count(*) from {NULLS}")
def null_report(t: Tables):
    return clean.missing_report(t.panel(True), ["o_orderkey", "price"])


# joins


@query(f"select a.id, a.o_orderkey, b.target from (select {ID} as id, o_orderkey from orders) a join (select {ID} as id, max(o_totalprice) as target from orders where o_orderkey % 3 = 0 group by 1) b using (id)")
def join_targets(t: Tables):
    ids = F.concat_ws("_", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("id")
    return joins.join_targets(t.orders.select(ids, "o_orderkey"), t.orders.filter("o_orderkey % 3 = 0").groupBy(ids).agg(F.max("o_totalprice").alias("target")))


@query("select c_custkey as symbol, '2024' as date, c_acctbal, target from customer left join (select o_custkey, sum(o_totalprice) as target from orders group by 1) on o_custkey = c_custkey")
def join_alternative(t: Tables):
    own = t.customer.select(F.col("c_custkey").alias("symbol"), F.lit("2024").alias("date"), "c_acctbal")
    train = t.orders.groupBy(F.col("o_custkey").alias("symbol")).agg(F.sum("o_totalprice").alias("target")).withColumn("date", F.lit("2024"))
    return joins.join_alternative(own, train, ["symbol", "date"])


@query("select c_custkey as asset, c_mktsegment, n_orders from customer left join (select o_custkey, count(*) as n_orders from orders group by 1) on o_custkey = c_custkey")
def join_live(t: Tables):
    return joins.join_live(t.customer.select(F.col("c_custkey").alias("asset"), "c_mktsegment"), t.orders.groupBy(F.col("o_custkey").alias("symbol")).agg(F.count("*").alias("n_orders")))


@query("select o_orderkey, o_custkey, o_orderdate, o_totalprice from (select *, rank() over (partition by o_custkey order by o_orderdate desc) as r from orders) where r = 1")
def latest_per_customer(t: Tables):
    return joins.latest_rows(t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"), ORDERS)


@query("select o_orderkey, o_custkey, o_totalprice, round(avg(o_totalprice) over (partition by o_custkey), 6) as o_totalprice_o_custkey_mean, round(stddev_samp(o_totalprice) over (partition by o_custkey), 6) as o_totalprice_o_custkey_std from orders")
def group_statistics(t: Tables):
    return rounded(joins.group_statistics(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", ["o_totalprice"]), 6)


@query("select distinct c_custkey as symbol from customer where c_custkey in (select o_custkey from orders)")
def overlap_symbols(t: Tables):
    return joins.symbol_overlap(t.customer.select(F.col("c_custkey").alias("symbol")), t.orders.select(F.col("o_custkey").alias("symbol")))


@query("select distinct c_custkey as symbol from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 300000)")
def missing_symbols(t: Tables):
    live = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("symbol"))
    return joins.missing_symbols(t.customer.select(F.col("c_custkey").alias("symbol")), live)


# statistics


@query("select o_orderstatus, round(avg(o_totalprice), 6) as o_totalprice_mean, round(stddev_samp(o_totalprice), 6) as o_totalprice_std, max(o_totalprice) as o_totalprice_max, min(o_totalprice) as o_totalprice_min from orders group by 1")
def group_summary(t: Tables):
    return rounded(stats.group_summary(t.orders, "o_orderstatus", ["o_totalprice"]), 6, "o_totalprice_mean", "o_totalprice_std")


@query("select count(*) as n_rows, count(distinct o_custkey) as n_distinct from orders")
def distinct_report(t: Tables):
    return stats.distinct_report(t.orders, "o_custkey").drop("first_values")


@query(f"select 'price' as feature, count(*) filter (price is null) as n_null, true as is_numeric from {NULLS}")
def type_issues(t: Tables):
    return stats.type_issues(t.panel(True), ["price"])


@query(" union all ".join(f"select '{c}' as feature, round(var_samp({c}), 4) as variance from lineitem" for c in NUM))
def variance_rank(t: Tables):
    return rounded(stats.variances(t.lineitem, NUM), 4)


@query(" union all ".join(f"select '{c}' as feature, round(abs(corr({c}, l_extendedprice)), 6) as corr from lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def corr_target(t: Tables):
    return rounded(stats.target_correlations(t.lineitem, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice"), 6)


@query(" union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from lineitem" for a in NUM for b in NUM if a != b))
def correlation_matrix(t: Tables):
    m = stats.correlation_matrix(t.lineitem, NUM)
    return t.spark.createDataFrame([(a, b, round(float(m[i, j]), 6)) for i, a in enumerate(NUM) for j, b in enumerate(NUM) if i != j], "a string, b string, r double")


_GAPS = "(select case when l_orderkey % 17 <> 0 then l_quantity end as a, case when l_orderkey % 5 <> 0 then l_extendedprice end as b, l_tax as c from lineitem)"


@query(" union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from {_GAPS}" for a in "abc" for b in "abc" if a != b))
def correlation_with_gaps(t: Tables):
    k = F.col("l_orderkey")
    df = t.lineitem.select(F.when(k % 17 != 0, F.col("l_quantity")).alias("a"), F.when(k % 5 != 0, F.col("l_extendedprice")).otherwise(F.lit(float("nan"))).alias("b"), F.col("l_tax").alias("c"))
    m = stats.correlation_matrix(df, ["a", "b", "c"])
    return t.spark.createDataFrame([(a, b, round(float(m[i, j]), 6)) for i, a in enumerate("abc") for j, b in enumerate("abc") if i != j], "a string, b string, r double")


@query("select round((avg(l_quantity) + avg(l_tax)) / 2, 6) as mean, round((stddev_samp(l_quantity) + stddev_samp(l_tax)) / 2, 6) as std from lineitem")
def overall_scale(t: Tables):
    return rounded(stats.overall_scale(t.lineitem, ["l_quantity", "l_tax"]), 6)


@query("select min(o_orderdate) as first_date, max(o_orderdate) as last_date from orders")
def date_range(t: Tables):
    return stats.date_range(t.orders, "o_orderdate")


@query("""with o as (select o_custkey as k from orders), c as (select c_custkey as k from customer), m as (select k from c where k in (select k from o))
select 'customers' as source, count(*) as n_rows, count(distinct k) as n_symbols, count(distinct k) filter (k in (select k from m)) as n_shared from c union all
select 'orders', count(*), count(distinct k), count(distinct k) filter (k in (select k from m)) from o union all select 'merged', count(*), count(distinct k), count(distinct k) from m""")
def merge_summary(t: Tables):
    o, c = t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k"))
    return stats.merge_summary({"customers": c, "orders": o}, joins.symbol_overlap(c, o, "k"), "k")


# selection


def _wide(t: Tables):
    return t.lineitem.select(*LK, *NUM, (F.col("l_quantity") * 2 + 1).alias("twice"), F.lit(1.0).alias("constant"))


@query("select unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'twice']) as feature from (select 1) where (select var_samp(l_quantity) > 0 and var_samp(l_tax) > 0 from lineitem)")
def variance_drop(t: Tables):
    return t.spark.createDataFrame([(c,) for c in selection.zero_variance(_wide(t), [*NUM, "twice", "constant"])], "feature string")


_DROP = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "twice"]


@query("with r as (" + " union all ".join(f"select '{b}' as feature, abs(corr({a}, {b})) as r from (select *, l_quantity * 2 + 1 as twice from lineitem)" for i, b in enumerate(_DROP) for a in _DROP[:i]) + ") select feature from (select 'l_quantity' as feature union all select feature from r group by feature having max(r) <= 0.95)")
def corr_drop(t: Tables):
    return t.spark.createDataFrame([(c,) for c in selection.uncorrelated(_wide(t), [*NUM, "twice", "constant"])], "feature string")


@query("select feature from (" + " union all ".join(f"select '{c}' as feature, abs(corr({c}, l_extendedprice)) as r from lineitem" for c in ("l_quantity", "l_discount", "l_tax")) + ") order by r desc, feature limit 2")
def top_features(t: Tables):
    return t.spark.createDataFrame([(c,) for c in selection.top_by_target(t.lineitem, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", 2)], "feature string")


@query("with r as (" + " union all ".join(f"select '{b}' as feature, abs(corr({a}, {b})) as r from (select *, l_quantity * 2 + 1 as twice from lineitem)" for i, b in enumerate(_DROP) for a in _DROP[:i]) + ") select feature from (select 'l_quantity' as feature union all select feature from r group by feature having max(r) <= 0.95) order by sha256('42:' || feature) limit 3")
def select_chain(t: Tables):
    return t.spark.createDataFrame([(c,) for c in selection.select_chain(_wide(t), [*NUM, "twice", "constant"], 3)], "feature string")


_BASE = ["l_quantity", "l_discount", "l_tax"]
_MADE = [(f"{a}_{k}_{b}", f"{a} {op} {b}") for i, a in enumerate(_BASE) for b in _BASE[i + 1 :] for k, op in (("add", "+"), ("mul", "*"))] + [(f"{c}_square", f"{c} * {c}") for c in _BASE]


def _scores(items) -> str:
    return " union all ".join(f"select {i} as i, '{n}' as feature, abs(corr({e}, l_extendedprice)) as r from lineitem" for i, (n, e) in enumerate(items))


# three columns make three sums, three products and three squares: 12, of which 30 % go
@query(f"select feature, 12::bigint as generated from ({_scores([(c, c) for c in _BASE] + _MADE)}) order by r desc, feature limit 9")
def evolve_lineitem(t: Tables):
    spec = PanelSpec("l_partkey", "l_shipdate", ("l_orderkey", "l_linenumber", "l_suppkey"), target="l_extendedprice")
    df = t.lineitem.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", *NUM)
    _, kept, done = selection.evolve(df, spec, _BASE, 1, 12, folder(t, "evolve"))
    return t.spark.createDataFrame([(c, done[0]["generated"]) for c in kept], "feature string, generated long")


# batches of four, of which the best three stay; squares are a family of their own, of which the best one stays
@query(f"""with s as (select i // 4 as batch, feature, r from ({_scores(_MADE)})), f as (select * from s where feature not like '%square' union all select * from (select * from s where feature like '%square' qualify row_number() over (partition by batch order by r desc, feature) = 1))
select batch::bigint as batch, feature from (select *, row_number() over (partition by batch order by r desc, feature) as k, count(*) over (partition by batch) as n from f) where k <= ceil(n * 0.7)""")
def evolve_in_batches(t: Tables):
    """Kept names, batch by batch, read back from the column groups that hold them."""
    store = ColumnGroups(t.spark)
    store.begin(t.lineitem.select(*LK, *NUM))
    one = lambda df, names: selection.top_by_target(df, names, "l_extendedprice", 1)
    selection.evolve_in_batches(store, _BASE, "l_extendedprice", 1, batch=4, most=None, families={"square": one})
    kept = [(int(g.rsplit("batch", 1)[1]), c) for g, own in store.groups.items() if g != "base" for c in own]
    return t.spark.createDataFrame(kept, "batch long, feature string")


_POLY = {"l_quantity": "q", "l_discount": "d", "l_tax": "x"}
_MONOMIALS = [c for k in range(1, 8) for c in combinations_with_replacement(_POLY, k)]
_READ = [_MONOMIALS[i] for i in (0, 4, 30, 57, 90, 118)]


@query(f"select {L4}, " + ", ".join(f"round({' * '.join(c)}, 4) as {''.join(_POLY[x] for x in c)}" for c in _READ) + " from lineitem")
def wide_columns(t: Tables):
    """119 monomials to degree 7, made and stored in groups of 25; six of them are read from the groups that hold them."""
    store = ColumnGroups(t.spark)
    store.begin(t.lineitem.select(*LK, *_POLY))
    store.make(((f"{''.join(_POLY[x] for x in c)}_", reduce(mul, map(F.col, c))) for c in _MONOMIALS), list(_POLY), at_a_time=25)
    names = ["".join(_POLY[x] for x in c) for c in _READ]
    return rounded(store.read([*LK, *(f"{n}_" for n in names)]).toDF(*LK, *names), 4, *names)


# splits


@query("select o_orderkey, case when row_number() over (order by o_orderdate, o_custkey, o_orderkey) <= (select (count(*) * 0.8)::bigint from orders) then 'train' else 'test' end as split from orders")
def time_split(t: Tables):
    return split.time_split(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ORDERS).select("o_orderkey", "split")


@query(f"select o_orderkey, case when {_md5('o_orderkey')} < {int(0.2 * 2**52)} then 'test' else 'train' end as split from orders")
def hash_split(t: Tables):
    return split.hash_split(t.orders.select("o_orderkey"), ["o_orderkey"])


@query("select o_orderkey, o_orderdate from orders order by o_orderdate desc, o_orderkey limit 20 offset 40")
def newest_orders(t: Tables):
    return split.newest(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", 20, 40, ("o_orderkey",))


@query("select o_custkey, o_orderkey, o_totalprice, rank from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey)::int as rank from orders) where rank <= 3")
def top_orders(t: Tables):
    return split.top_k(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), "o_totalprice", 3, "o_custkey", ("o_orderkey",))


# models and ensembles

_P = {"flat": "36000.0", "slope": "l_quantity * 1500", "mixed": "l_quantity * 1400 + l_tax * 1000"}
_LONG = " union all ".join(f"select '{m}' as model, l_partkey, avg({e}) as prediction from lineitem group by 2" for m, e in _P.items())


def _predictions(t: Tables):
    out = None
    for m, e in _P.items():
        one = t.lineitem.groupBy("l_partkey").agg(F.avg(F.expr(e).cast("double")).alias("prediction")).withColumn("model", F.lit(m))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"select l_partkey, round(sum(prediction * case model when 'flat' then 1 when 'slope' then 2 else 3 end) / 6, 4) as prediction from ({_LONG}) group by 1")
def ensemble_weighted(t: Tables):
    w = t.spark.createDataFrame([("flat", 1.0), ("slope", 2.0), ("mixed", 3.0)], "model string, weight double")
    return rounded(ensemble.weighted_ensemble(_predictions(t), w, "l_partkey"), 4)


@query(f"select l_partkey, round(avg(prediction), 4) as prediction from ({_LONG}) group by 1")
def ensemble_mean(t: Tables):
    return rounded(ensemble.weighted_ensemble(_predictions(t), None, "l_partkey"), 4)


_METRICS = "select '{m}' as model, sqrt(avg(pow(l_extendedprice - p, 2))) as rmse, avg(abs(l_extendedprice - p)) as mae, 1 - sum(pow(l_extendedprice - p, 2)) / (var_pop(l_extendedprice) * count(*)) as r2, avg((sign(l_extendedprice) = sign(p))::int) as sign_accuracy from (select l_extendedprice, {e} as p from lineitem)"
_ALL = " union all ".join(_METRICS.format(m=m, e=e) for m, e in _P.items())


def _metrics(t: Tables):
    out = None
    for m, e in _P.items():
        one = ensemble.regression_metrics(t.lineitem.withColumn("p", F.expr(e).cast("double")), "l_extendedprice", "p").withColumn("model", F.lit(m))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"select model, round(rmse, 4) as rmse, round(mae, 4) as mae, round(r2, 6) as r2, round(sign_accuracy, 6) as sign_accuracy from ({_ALL})")
def reg_metrics(t: Tables):
    return rounded(rounded(_metrics(t), 4, "rmse", "mae"), 6, "r2", "sign_accuracy")


@query(f"with m as ({_ALL}) select model, round((1 / rmse) / (select sum(1 / rmse) from m), 6) as weight from m")
def inverse_error_weights(t: Tables):
    return rounded(ensemble.inverse_error_weights(_metrics(t).select("model", F.col("rmse").alias("error"))), 6)


@query(f"with m as ({_ALL}) select arg_min(model, rmse) as model, round(min(rmse), 4) as rmse from m")
def best_model(t: Tables):
    return rounded(ensemble.best_model(_metrics(t)), 4)


@query("""with s as (select (l_returnflag = 'R')::int as y, l_quantity / 50 as s from lineitem), r as (select y, s, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2 as r from s),
c as (select count(*) filter (s >= 0.5 and y = 1) as tp, count(*) filter (s >= 0.5 and y = 0) as fp, count(*) filter (s < 0.5 and y = 1) as fn, count(*) filter (s < 0.5 and y = 0) as tn, sum(r) filter (y = 1) as r from r)
select round((tp + tn) / (tp + tn + fp + fn), 6) as accuracy, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1, round((r - (tp + fn) * (tp + fn + 1) / 2) / ((tp + fn) * (fp + tn)), 6) as auc from c""")
def clf_metrics(t: Tables):
    df = t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_quantity") / 50).alias("s"))
    return rounded(ensemble.classification_metrics(df, "y", "s"), 6)


@query("select count(*) as n_rows, 0::bigint as n_null, count(*) filter (p > 1) as n_outside, count(*) - count(distinct o_custkey) as n_repeated, false as ok from (select o_custkey, o_totalprice / 100000 as p from orders)")
def submission_check(t: Tables):
    return ensemble.output_check(t.orders.select(F.col("o_custkey").alias("symbol"), (F.col("o_totalprice") / 100000).alias("prediction"))).select(F.col("n_rows").cast("long"), F.col("n_null").cast("long"), F.col("n_outside").cast("long"), F.col("n_repeated").cast("long"), "ok")


@query(f"select o_orderkey, split_part({ID}, '_', 1) as symbol from orders")
def symbol_of_id(t: Tables):
    return t.orders.select("o_orderkey", F.concat_ws("_", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("id")).select("o_orderkey", ensemble.symbol_of("id").alias("symbol"))


def _training(t: Tables):
    return t.lineitem.select("l_orderkey", "l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("target"), (F.col("l_returnflag") == "R").cast("double").alias("y"), (F.col("l_orderkey") % 5 == 0).alias("valid"))


X = ["l_quantity", "l_discount", "l_tax"]


#: A step that no single column tells (discount and tax, one high and the other low), and a wave of the price on it.
_STEP = "((l_discount > 0.05) <> (l_tax > 0.04))"
_WAVE = "10 * {}::int + 2 * sin(l_extendedprice / 8000)".format(_STEP)
#: Spread over -1 to 1 by the row's key; every fourth class is turned round.
_BLUR = "((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 1000) / 500.0 - 1"
XP = [*X, "l_extendedprice"]


def _planted(t: Tables):
    """The target and the class y with noise, step and wave without."""
    step, blur = ((F.col("l_discount") > 0.05) != (F.col("l_tax") > 0.04)).cast("double"), F.expr(_BLUR)
    wave = 10 * step + 2 * F.sin(F.col("l_extendedprice") / 8000)
    return t.lineitem.select(*LK, *XP, step.alias("step"), wave.alias("wave"), F.when(blur < -0.5, 1 - step).otherwise(step).alias("y"), (wave + 4 * blur).alias("target"), (F.col("l_orderkey") % 5 == 0).alias("valid"))


#: Rounds without gain that end a query's training; the library's own default is 50.
PATIENCE = 5


@query(f"select {_STEP}::int as step, count(*) as n_held, true as near from lineitem where l_orderkey % 5 = 0 group by 1")
def fit_boosted_trees(t: Tables):
    """For each planted step: rows that chose the rounds but grew no tree; whether nine of ten predictions are within 3 of the wave without
    its noise (the mean is further off on every row)."""
    df = _planted(t)
    scored = modeling.fit(df, XP, "gbt", "fast", validation="valid", patience=PATIENCE).transform(df.filter("valid"))
    near = F.avg((F.abs(F.col("prediction") - F.col("wave")) < 3).cast("int")) >= 0.9
    return scored.groupBy(F.col("step").cast("int").alias("step")).agg(F.count("*").alias("n_held"), near.alias("near"))


@query("select count(*) as n_held, true as under_half, true as more_than_one_tree, true as cut_at_the_best from lineitem where l_orderkey % 5 = 0")
def boosting_rounds(t: Tables):
    """Rows held out; whether their error is under half of the target's deviation; whether the kept trees are those up to the least error."""
    rows = VectorAssembler(inputCols=XP, outputCol="_features").transform(_planted(t)).select("_features", "target", "valid")
    model, errors = modeling.boost_with_patience(rows.filter("not valid"), rows.filter("valid"), "gbt", "fast", patience=PATIENCE, store=True, maxDepth=6, stepSize=0.4)
    kept, _ = modeling.best_round(errors, PATIENCE)
    scored = model.transform(rows.filter("valid"))
    of = ensemble.regression_metrics(scored, "target", "prediction").select("rmse")
    seen = scored.agg(F.count("*").alias("n_held"), F.stddev_pop("target").alias("std"))
    best = F.lit(len(model.trees) == kept and errors[kept - 1] == min(errors[: kept + PATIENCE]))
    return seen.join(of).select("n_held", (F.col("rmse") < F.col("std") / 2).alias("under_half"), F.lit(kept > 1).alias("more_than_one_tree"), best.alias("cut_at_the_best"))


@query(f"select {L4}, {_STEP}::int as step from lineitem")
def fit_forest(t: Tables):
    """Each row's planted step, as a forest predicts it, where discount and tax alone have nearly all importance."""
    df = _planted(t).withColumn("target", F.col("step")).drop("step")
    model = modeling.fit(df, X, "forest", "fast", scale=True)
    share = modeling.importance(model, X, t.spark).filter(F.col("feature").isin("l_discount", "l_tax") & (F.col("importance") > 0.2)).agg(F.count("*").alias("n"), F.sum("importance").alias("both"))
    told = model.transform(df).join(F.broadcast(share.filter("n = 2 and both > 0.9")))
    return told.select(*LK, F.round("prediction").cast("int").alias("step"))


def _probability():
    from pyspark.ml.functions import vector_to_array

    return vector_to_array("probability")


@query(f"select {_STEP}::int as step, count(*) as n_held, true as told, 0::bigint as n_outside from lineitem where l_orderkey % 5 = 0 group by 1")
def fit_classifier(t: Tables):
    """For each planted class: rows held out; whether 19 of 20 are told, though every fourth label of the training rows is wrong (a constant
    tells all of one class and none of the other); scores that are no probability."""
    df = _planted(t)
    model = modeling.fit(df, X, "classifier", "fast", label="y", validation="valid", patience=PATIENCE)
    scored = model.transform(df.filter("valid")).select(F.col("step").cast("int").alias("step"), F.element_at(_probability(), 2).alias("s"))
    told = F.avg(((F.col("s") > 0.5).cast("int") == F.col("step")).cast("int")) >= 0.95
    return scored.groupBy("step").agg(F.count("*").alias("n_held"), told.alias("told"), F.count(F.when((F.col("s") < 0) | (F.col("s") > 1), 1)).alias("n_outside"))


def _probability():
    from pyspark.ml.functions import vector_to_array

    return vector_to_array("probability")


@query("select l_orderkey, round((select avg(l_extendedprice) from lineitem), 4) as prediction from lineitem")
def mean_model(t: Tables):
    df = _training(t)
    return rounded(modeling.MeanModel(df, X).transform(df).select("l_orderkey", "prediction"), 4)


@query(f"select {L4}, case when {_STEP} then 0.95::double else 0.05::double end as prediction, 'm1' as model_id, 0.5::double as r2 from lineitem")
def registry_and_score(t: Tables):
    """A model saved, listed by type and feature set, loaded and scored: it tells the planted step, cut to the range of predictions."""
    df = _planted(t)
    reg = modeling.ModelRegistry(t.spark, folder(t, "models"))
    model = modeling.fit(df.withColumn("target", F.col("step")), X, "forest", "fast")
    reg.register("m1", "gbt", model, X, {"rmse": 1.0}, created=1.0, feature_set="small")
    reg.update_metrics("m1", {"r2": 0.5})
    row = reg.list("gbt", "small").first()
    model, features = reg.load(row.model_id)
    scored = modeling.score(model, df.withColumn("key", F.struct(*LK)), features, "key")
    near = F.when(F.col("prediction") > 0.5, F.greatest("prediction", F.lit(0.95))).otherwise(F.least("prediction", F.lit(0.05)))
    return scored.select("key.*", near.alias("prediction"), F.lit(row.model_id).alias("model_id"), F.get_json_object(F.lit(row.metrics), "$.r2").cast("double").alias("r2"))


_BEST = "(select sqrt(sum(n * v) / sum(n)) from (select count(*) as n, var_pop(t) as v from x group by {}))"


@query(f"with x as (select *, {_WAVE} + 4 * ({_BLUR}) as t from lineitem) select model, least_error < deviation / 2 as recovers from (select unnest(['discount', 'both']) as model, unnest([{_BEST.format('l_discount')}, {_BEST.format('l_discount, l_tax')}]) as least_error, (select stddev_pop(t) from x) as deviation)")
def compare_models(t: Tables):
    """Each candidate: whether its error on the folds it did not see is under half of the target's deviation, as the least error that its
    columns allow is."""
    df = _planted(t)
    found = modeling.compare(df, {"discount": (X[1:2], "forest", "fast"), "both": (X[1:], "forest", "fast")}, ["l_orderkey"])
    return found.join(F.broadcast(df.agg(F.stddev_pop("target").alias("std")))).select("model", (F.col("rmse") < F.col("std") / 2).alias("recovers"))


# run metrics over relations derived from orders: a run is a customer, a model an order


_RUNS = "select o_custkey::varchar as run_id, o_custkey % 7 as round, max(o_orderdate) as timestamp from orders group by 1, 2"
_MODELS = "select o_orderkey::varchar as model_id, o_custkey::varchar as run_id, o_orderpriority as model_type, o_orderdate as timestamp, case when o_orderkey % 2 = 0 then '{\"rmse\": ' || o_orderkey || '}' else '{\"metrics\": {\"rmse\": ' || o_orderkey || ', \"r2\": 0.5}}' end as metrics from orders"


def _runs(t: Tables):
    return t.orders.groupBy(F.col("o_custkey").cast("string").alias("run_id"), (F.col("o_custkey") % 7).alias("round")).agg(F.max("o_orderdate").alias("timestamp"))


def _models(t: Tables):
    k = F.col("o_orderkey")
    js = F.when(k % 2 == 0, F.concat(F.lit('{"rmse": '), k, F.lit("}"))).otherwise(F.concat(F.lit('{"metrics": {"rmse": '), k, F.lit(', "r2": 0.5}}')))
    return t.orders.select(k.cast("string").alias("model_id"), F.col("o_custkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("model_type"), F.col("o_orderdate").alias("timestamp"), js.alias("metrics"))


def _importance(t: Tables):
    return t.lineitem.groupBy(F.col("l_orderkey").cast("string").alias("model_id"), F.concat(F.lit("f"), "l_linenumber").alias("feature_name")).agg(F.max("l_quantity").alias("importance"))


_IMP = "select l_orderkey::varchar as model_id, 'f' || l_linenumber as feature_name, max(l_quantity) as importance from lineitem group by 1, 2"


@query(f"select * from ({_RUNS}) where round = 3 order by timestamp desc, run_id limit 50")
def list_runs(t: Tables):
    return run_metrics.list_rows(_runs(t), 50, round=3)


@query(f"select * from ({_MODELS}) where run_id = '5' order by timestamp desc, model_id limit 30 offset 5")
def list_models(t: Tables):
    return run_metrics.list_rows(_models(t), 30, 5, run_id="5", model_type=None)


@query(f"""with m as ({_MODELS}), r as ({_RUNS}), c as (select run_id, count(*) as n_models, min(model_id) as first_model from m group by 1),
f as (select user_id::varchar as run_id, count(distinct event_type) as n_features, max(event_type) as last_feature from events group by 1), s as (select run_id, count(*) as n_submissions from m where model_type = '1-URGENT' group by 1)
select r.run_id, r.round, r.timestamp, coalesce(n_models, 0) as n_models, first_model, coalesce(n_features, 0) as n_features, last_feature, coalesce(n_submissions, 0) as n_submissions from r left join c using (run_id) left join f using (run_id) left join s using (run_id)""")
def run_details(t: Tables):
    features = t.events.select(F.col("user_id").cast("string").alias("run_id"), "event_type").distinct()
    df = run_metrics.run_details(_runs(t), _models(t), features, _models(t).filter("model_type = '1-URGENT'").select("run_id", F.col("model_id").alias("submission_id")))
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    return df.select("run_id", "round", "timestamp", size("models").alias("n_models"), F.get("models", F.lit(0))["model_id"].alias("first_model"), size("features").alias("n_features"), F.try_element_at("features", F.lit(-1))["event_type"].alias("last_feature"), size("submissions").alias("n_submissions"))


@query(f"with i as ({_IMP}) select m.model_id, round(sum(importance), 2) as total, count(importance) as n from ({_MODELS}) m left join i using (model_id) group by 1")
def models_with_importance(t: Tables):
    df = run_metrics.models_with_importance(_models(t), _importance(t))
    values = F.coalesce(F.map_values("importance"), F.array().cast("array<double>"))
    return rounded(df.select("model_id", F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x)).alias("total"), F.size(values).cast("long").alias("n")), 2)


@query("select user_id as run_id, date_trunc('day', ts) as timestamp, count(*) as n_features from events group by 1, 2")
def feature_count_history(t: Tables):
    return run_metrics.feature_count_history(t.events.groupBy(F.col("user_id").alias("run_id"), F.date_trunc("day", "ts").alias("timestamp")).agg(F.count("*").alias("n_features")))


@query("select event_id, ts, json_extract_string(props, '$.k')::double as value from events where json_extract_string(props, '$.k') is not null")
def metric_json_history(t: Tables):
    return run_metrics.metric_history(t.events, "k", "props", "ts").select("event_id", "ts", "value")


@query(f"select i.model_id, i.feature_name, i.importance, m.run_id, m.timestamp from ({_IMP}) i join ({_MODELS}) m using (model_id) where feature_name = 'f2'")
def importance_trend(t: Tables):
    return run_metrics.importance_trend(_importance(t), _models(t), "f2")


@query(f"with m as ({_MODELS}), f as (select o_custkey::varchar as run_id, arg_max(o_orderkey % 100, o_orderdate) as n_features from (select o_custkey, o_orderdate, max(o_orderkey) as o_orderkey from orders group by 1, 2) group by 1) select run_id, model_id, model_type, coalesce(json_extract_string(metrics, '$.rmse'), json_extract_string(metrics, '$.metrics.rmse'))::double as rmse, coalesce(json_extract_string(metrics, '$.r2'), json_extract_string(metrics, '$.metrics.r2'))::double as r2, n_features from m left join f using (run_id)")
def run_report(t: Tables):
    f = t.orders.groupBy(F.col("o_custkey").cast("string").alias("run_id"), F.col("o_orderdate").alias("timestamp")).agg((F.max("o_orderkey") % 100).alias("n_features"))
    return run_metrics.run_report(_models(t), f)


# sources and user code


@query("select o_orderkey, o_totalprice from orders")
def csv_round_trip(t: Tables):
    at = folder(t, "csv") + ".csv"
    io.write_csv(t.orders.select("o_orderkey", "o_totalprice"), at)
    return io.scan(t.spark, at, schema="o_orderkey long, o_totalprice double")


@query("select o_orderkey, (strftime(o_orderdate, '%Y%m01'))::int as snapshot_date from orders where o_orderdate < '1996-01-01'")
def landing_until(t: Tables):
    at, day = folder(t, "landing"), F.date_format(F.trunc("o_orderdate", "month"), "yyyyMMdd")
    t.orders.select("o_orderkey", day.alias("snapshot_date")).write.partitionBy("snapshot_date").parquet(at)
    return io.read_landing(t.spark, at, "19951231")


@query("select o_custkey, o_orderkey from orders where o_custkey in (3, 4)")
def feature_set_get(t: Tables):
    sets = io.FeatureSets(t.spark, folder(t, "sets"))
    sets.save("small", t.orders.select(F.col("o_custkey").alias("symbol"), "o_orderkey"))
    return sets.get(["large", "small"], [3, 4]).withColumnRenamed("symbol", "o_custkey")


@query("select count(*) as n_rows, count(distinct o_custkey) as n_symbols, min(o_orderdate) as first_date, max(o_orderdate) as last_date, 1 as n_features, 0 as n_rolling, 0 as n_lag, 0 as n_ewm from orders")
def feature_info(t: Tables):
    return io.describe(t.orders, ORDERS)


@query(f"select o_orderkey, price * 2 as price_twice from {PANEL}")
def custom_functions(t: Tables):
    r = custom.FeatureRegistry()
    r.register("twice", lambda df: df.select("o_orderkey", (F.col("price") * 2).alias("price_twice")))
    return r.apply(t.panel(), "twice")


@query("select o_custkey, count(*) as n, max(o_totalprice) as top from orders group by 1")
def map_groups(t: Tables):
    import pandas as pd

    def run(pdf):
        return pd.DataFrame({"o_custkey": [pdf.o_custkey.iloc[0]], "n": [len(pdf)], "top": [pdf.o_totalprice.max()]})

    return custom.map_groups(t.orders.select("o_custkey", "o_totalprice"), "o_custkey", run, "o_custkey long, n long, top double")


@query("select l_returnflag, count(*) as n, max(l_extendedprice) as top, round(avg(l_extendedprice), 4) as mean, round(stddev_pop(l_extendedprice), 4) as std from lineitem group by 1")
def map_groups_in_parts(t: Tables):
    """A user's statistics in two phases: counts, sums and moments of parts of 5,000 rows, merged by four."""
    import pandas as pd

    def partial(pdf):
        x = pdf.l_extendedprice
        return pd.DataFrame({"l_returnflag": pdf.l_returnflag[:1].to_numpy(), "n": [len(x)], "top": [x.max()], "mean": [x.mean()], "m2": [((x - x.mean()) ** 2).sum()]})

    def merge(pdf):
        n, mean = pdf.n.sum(), (pdf.n * pdf["mean"]).sum() / pdf.n.sum()
        m2 = (pdf.m2 + pdf.n * (pdf["mean"] - mean) ** 2).sum()
        return pd.DataFrame({"l_returnflag": pdf.l_returnflag[:1].to_numpy(), "n": [n], "top": [pdf.top.max()], "mean": [mean], "m2": [m2]})

    def finish(pdf):
        return pdf.assign(std=(pdf.m2 / pdf.n) ** 0.5).drop(columns="m2")

    df = t.lineitem.select("l_returnflag", "l_extendedprice")
    own = "l_returnflag string, n long, top double, mean double"
    return rounded(custom.map_groups_in_parts(df, "l_returnflag", partial, merge, f"{own}, m2 double", finish, f"{own}, std double", rows=5_000, fan=4), 4, "mean", "std")
