"""Source, feature-tracking, noise, indicator and user-code queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import custom, rowmath
from ..operators import clean, history, modeling, run_metrics, selection, split, stats, windows
from ..sources import io
from ..spec import PanelSpec, first_present
from .define import BAR, BARS, ORDERS, Tables, query, rounded
from .panel_queries import LK, NUM, L
from .table_queries import _md5, folder

# sources


@query("select least(100, count(*)) as n_rows, 2::bigint as n_columns from orders")
def limited_scan(t: Tables):
    df = io.scan(t.spark, f"{t.sf_dir}/orders.parquet", ["o_orderkey", "o_totalprice"], 100)
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


@query(" union all ".join(f"select '{c}' as feature, round(sum({c}), 2) as total, count(l_orderkey) as n_rows from lineitem" for c in NUM))
def column_batches(t: Tables):
    out = None
    for part in io.column_batches(t.lineitem.select("l_orderkey", *NUM), ["l_orderkey"], 3):
        names = [c for c in part.columns if c != "l_orderkey"]
        one = part.agg(F.count("l_orderkey").alias("n_rows"), *(F.sum(c).alias(c) for c in names))
        rows = one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.round(c, 2).alias("total")) for c in names))).alias("x"), "n_rows").select("x.*", "n_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("select count(*) as n_rows, sum(o_orderkey)::bigint as keys from orders")
def latest_snapshot(t: Tables):
    return io.scan(t.spark, io.latest_file(t.spark, t.sf_dir, ["absent_*.parquet", "order?.parquet"])).agg(F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("keys"))


@query("select o_orderkey, greatest(o_custkey, o_orderkey % 9) as round from orders")
def round_from_name(t: Tables):
    name = F.concat(F.lit("train_r"), "o_custkey", F.lit("_v2_r"), F.col("o_orderkey") % 9, F.lit(".parquet"))
    return t.orders.select("o_orderkey", io.round_column(name).alias("round"))


@query(f"select split, count(*) as n_rows, round(sum(o_totalprice), 2) as total from (select *, case when {_md5('o_orderkey')} < {int(0.2 * 2**52)} then 'test' else 'train' end as split from orders) group by 1")
def split_sink(t: Tables):
    at = folder(t, "splits")
    io.write_splits(split.hash_split(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"]), at)
    return t.spark.read.parquet(at).groupBy("split").agg(F.count("*").alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("select o_orderkey, o_totalprice from orders where o_orderkey % 3 = 1")
def checkpointed(t: Tables):
    return io.checkpoint(t.orders.select("o_orderkey", "o_totalprice").filter("o_orderkey % 3 = 1"), folder(t, "checkpoint"), 1)


@query("select count(*) as n_rows, count(distinct o_custkey) as n_symbols from orders")
def sidecar(t: Tables):
    at = folder(t, "sidecar")
    io.write_sidecar(t.orders, ORDERS, at)
    return t.spark.read.schema("n_rows long, n_symbols long").json(at)


@query("select o_orderkey, strftime(o_orderdate, '%Y')::int as snapshot_date from orders where o_orderdate < '1997-01-01'")
def landing_written(t: Tables):
    at = folder(t, "landing")
    for year in (1995, 1996, 1997):
        io.write_landing(t.orders.filter(F.year("o_orderdate") == year).select("o_orderkey"), at, f"{year}1231")
    return io.read_landing(t.spark, at, "19961231").withColumn("snapshot_date", F.floor(F.col("snapshot_date") / 10000).cast("int"))


# keys and roles


@query("select o_orderkey, o_custkey::varchar as symbol, strftime(o_orderdate, '%Y-%m-%d') as date, null::varchar as nothing from orders")
def keys_to_string(t: Tables):
    return clean.keys_to_string(t.orders.select("o_orderkey", F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.lit(None).alias("nothing")))


@query("select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as place from orders")
def explicit_order(t: Tables):
    df = ORDERS.check(t.orders)
    try:
        PanelSpec("o_custkey", "absent").check(t.orders)
    except ValueError:
        return df.select("o_orderkey", F.row_number().over(ORDERS.window()).cast("long").alias("place"))
    raise AssertionError("a panel without its order column passed")


@query("select o_orderkey, o_custkey as symbol from orders")
def first_present_name(t: Tables):
    df = t.orders.select("o_orderkey", F.col("o_custkey").alias("asset"))
    return df.withColumnRenamed(first_present(df), "symbol")


@query("select o_custkey, o_orderkey, row_number() over (order by o_custkey, o_orderdate, o_orderkey) as place from orders")
def sorted_panel(t: Tables):
    """The place that each row has in the sorted panel: rows before its range, and its place in it."""
    df = split.sorted_panel(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ORDERS).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    sizes = df.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = sizes.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))  # a row for each range
    return df.join(F.broadcast(before), "part").select("o_custkey", "o_orderkey", (F.col("before") + F.col("at") - F.col("first") + 1).alias("place"))


# noise and transforms

_U = [f"(({_md5('o_orderkey', 42 + j)} + 1) / {float(2**52 + 1)!r})" for j in range(6)]
_NOISE = ", ".join(f"sqrt(-2 * ln({_U[2 * i]})) * cos(2 * pi() * {_U[2 * i + 1]}) as random_baseline_{i}" for i in range(3))


@query(f"select o_orderkey, {', '.join(f'round(random_baseline_{i}, 6) as random_baseline_{i}' for i in range(3))} from (select o_orderkey, {_NOISE} from orders)")
def noise_baselines(t: Tables):
    return rounded(rowmath.add(t.orders.select("o_orderkey"), rowmath.noise_columns(["o_orderkey"], 0.0, 1.0)))


_ALL = {"log1p": "ln(1 + abs({x}))", "sqrt": "sqrt(abs({x}))", "square": "{x} * {x}", "reciprocal": "1 / (abs({x}) + 1e-10)", "sin_scaled": "sin(tanh({x}) * pi())", "cos_scaled": "cos(tanh({x}) * pi())", "tanh_scaled": "tanh(tanh({x}) * pi())", "pow2": "pow({x}, 2)"}


@query(f"select {L}, " + ", ".join(f"round({e.format(x=c)}, 4) as {c}_{n}" for c in ("l_quantity", "l_discount") for n, e in _ALL.items()) + ", round(l_quantity * l_discount, 4) as l_quantity_by_l_discount from lineitem")
def all_transforms(t: Tables):
    made = rowmath.all_transforms(["l_quantity", "l_discount"])
    df = rowmath.add(t.lineitem.select(*LK, *NUM), made)
    return rounded(df.select(*LK, *(F.col(f"`{c}`").alias(c.replace("*", "_by_")) for c in made)), 4)


# indicators of bars

_W = "(partition by event_type order by day)"
_W14 = "(partition by event_type order by day rows between 13 preceding and current row)"


def _mean(name, source, column, span):
    a = 2 / (span + 1)
    return f"{name} as (select a.event_type, a.day, sum(case when b.n = 1 then b.{column} else {a!r} * b.{column} end * pow({1 - a!r}, a.n - b.n)) as e from {source} a join {source} b on a.event_type = b.event_type and b.n <= a.n group by 1, 2)"


@query(f"""with r as (select *, row_number() over {_W} as n, volume - lag(volume) over {_W} as volume_delta, close - lag(close) over {_W} as d from {BAR}),
g as (select event_type, day, count(d) over {_W14} as c, avg(case when d is not null then greatest(d, 0) end) over {_W14} as g, avg(case when d is not null then greatest(-d, 0) end) over {_W14} as l from r),
{_mean('f', 'r', 'close', 12)}, {_mean('s', 'r', 'close', 26)}, m as (select r.*, f.e as fast, s.e as slow, f.e - s.e as macd from r join f using (event_type, day) join s using (event_type, day)), {_mean('q', 'm', 'macd', 9)}
select event_type, day, round(volume_delta, 4) as volume_delta, case when c >= 14 then case when l = 0 then 100.0 else round(100 - 100 / (1 + g / l), 4) end end as close_rsi_14, round(fast, 4) as close_ema_12, round(slow, 4) as close_ema_26, round(macd, 4) as macd, round(q.e, 4) as macd_signal, round(macd - q.e, 4) as macd_hist
from m join g using (event_type, day) join q using (event_type, day)""")
def technical_events(t: Tables):
    df = windows.technical(t.bars(), BARS, "close", "volume")
    return rounded(df.select("event_type", "day", "volume_delta", "close_rsi_14", "close_ema_12", "close_ema_26", "macd", "macd_signal", "macd_hist"), 4)


# selection


@query("select feature from (" + " union all ".join(f"select '{c}' as feature, var_samp({c}) as v from lineitem" for c in NUM) + ") order by v desc limit 2")
def ranked_features(t: Tables):
    order = [r.feature for r in stats.variances(t.lineitem, NUM).orderBy(F.desc("variance")).collect()]  # one number a column
    return t.spark.createDataFrame([(c,) for c in selection.top_ranked(NUM, order, 2)], "feature string")


_VARY = {**{c: c for c in NUM}, **{f"{c}_rest": f"{c} - floor({c})" for c in NUM}}


@query("select feature from (" + " union all ".join(f"select '{n}' as feature, var_samp({e}) as v from lineitem" for n, e in _VARY.items()) + ") where v > 0 order by sha256('42:' || feature) limit 3")
def hashed_features(t: Tables):
    """Of the columns and their fractions, those that vary (the fraction of whole numbers does not), cut by a hash."""
    df = t.lineitem.select(*NUM, *((F.col(c) - F.floor(c)).alias(f"{c}_rest") for c in NUM))
    return t.spark.createDataFrame([(c,) for c in selection.hash_cut(selection.zero_variance(df, df.columns), 3)], "feature string")


_BY = "(" + " union all ".join(f"select '{c}' as feature, abs(corr({c}, l_extendedprice)) as r from lineitem" for c in ("l_quantity", "l_discount", "l_tax")) + ")"


@query(f"select feature from (select * from {_BY} order by r desc, feature limit 2) union all select 'random_baseline_0'")
def bounded_reduction(t: Tables):
    df = t.lineitem.withColumn("random_baseline_0", F.lit(0.0))
    return t.spark.createDataFrame([(c,) for c in selection.bounded_reduction(df, ["l_quantity", "l_discount", "l_tax", "random_baseline_0"], "l_extendedprice", 0.5, 1)], "feature string")


_LNOISE = "sqrt(-2 * ln((" + _md5("l_orderkey || ':' || l_linenumber", 42) + f" + 1) / {float(2**52 + 1)!r})) * cos(2 * pi() * ((" + _md5("l_orderkey || ':' || l_linenumber", 43) + f" + 1) / {float(2**52 + 1)!r}))"


@query(f"select feature from {_BY} where r > (select abs(corr(n, l_extendedprice)) from (select l_extendedprice, {_LNOISE} as n from lineitem))")
def above_noise(t: Tables):
    df = rowmath.add(t.lineitem, rowmath.noise_columns(["l_orderkey", "l_linenumber"], 0.0, 1.0, count=1))
    return t.spark.createDataFrame([(c,) for c in selection.above_noise(df, ["l_quantity", "l_discount", "l_tax", "random_baseline_0"], "l_extendedprice")], "feature string")


@query(f"select {L}, l_quantity, l_tax, round(l_quantity + l_tax, 6) as l_quantity_add_l_tax, round(l_quantity * l_tax, 6) as l_quantity_mul_l_tax, round(l_quantity * l_quantity, 6) as l_quantity_square, round(l_tax * l_tax, 6) as l_tax_square, round(avg(l_quantity) over (partition by l_partkey), 6) as l_quantity_l_partkey_mean, round(stddev_samp(l_quantity) over (partition by l_partkey), 6) as l_quantity_l_partkey_std from lineitem")
def generation_step(t: Tables):
    spec = PanelSpec("l_partkey", "l_shipdate", ("l_orderkey", "l_linenumber"))
    df, _ = selection.generation_step(t.lineitem.select(*LK, "l_shipdate", "l_quantity", "l_tax"), spec, ["l_quantity", "l_tax"], 8)
    return rounded(df.drop("l_shipdate"), 6)


# feature tracking


#: Feature, its value, and a third column that only dear orders of the later years have.
_TRACKED = {"symbol": "o_custkey", "date": "o_orderdate", "o_totalprice": "o_totalprice", "dear": "case when year(o_orderdate) > 1995 and o_totalprice > 300000 then o_totalprice end"}
_YEARS = (1995, 1996, 1997)


def _book(t: Tables):
    book = history.FeatureBook(t.spark, folder(t, "book"))
    df = t.orders.select(*(F.expr(e).alias(n) for n, e in _TRACKED.items()))
    for year in (*_YEARS, _YEARS[-1]):  # the last one changes nothing
        own = df.filter(F.year("date") == year).drop(*(["dear"] if year == _YEARS[0] else []))
        book.register_features(book.register_file(f"orders-{year}", "alternative", str(year)), own, "alternative", str(year))
    return book


_SEEN = " union all ".join(f"select '{n}' as feature, year(o_orderdate)::varchar as y, count({e}) as n_values from orders where year(o_orderdate) in {_YEARS if n != 'dear' else _YEARS[1:]} group by 2" for n, e in _TRACKED.items())


@query(f"select 'alternative' as source, count(distinct y) as n_files, count(distinct feature) as n_features, sum(n_values)::bigint as n_values from ({_SEEN})")
def feature_book_counts(t: Tables):
    book = _book(t)
    return book.counts().join(book.files().groupBy("source").agg(F.count("*").alias("n_files")), "source").select("source", "n_files", "n_features", "n_values")


@query(f"select feature, min(y) as first_seen, max(y) as last_seen, count(*) as n_files, sum(n_values)::bigint as n_values from ({_SEEN}) where n_values > 0 group by 1")
def features_seen(t: Tables):
    """Snapshots in which each column has values."""
    return _book(t).seen().drop("source")


@query("select o_custkey as symbol, o_orderdate as date, o_orderpriority from orders")
def only_new_features(t: Tables):
    day2 = t.orders.select(F.col("o_custkey").alias("symbol"), F.col("o_orderdate").alias("date"), "o_totalprice", "o_orderpriority")
    return _book(t).only_new(day2, "alternative")


# run relations


@query("select o_custkey::varchar as run_id, max(o_orderkey) % 5 as round, max(o_orderdate) as timestamp, 'done' as status from orders group by 1")
def run_store(t: Tables):
    """Every run is appended twice; the later version counts."""
    store = run_metrics.RunStore(t.spark, folder(t, "runs"))
    runs = t.orders.groupBy(F.col("o_custkey").cast("string").alias("run_id")).agg((F.max("o_orderkey") % 5).alias("round"), F.max("o_orderdate").alias("timestamp")).withColumn("metrics", F.lit("{}"))
    store.append("runs", runs.withColumn("status", F.lit("started")), 0)
    store.append("runs", runs.withColumn("status", F.lit("done")), 1)
    return store.read("runs").select("run_id", "round", "timestamp", "status")


@query("select o_orderkey::varchar as model_id, o_totalprice as importance from orders where o_orderkey % 2 = 0")
def importance_store(t: Tables):
    store = run_metrics.RunStore(t.spark, folder(t, "importance"))
    store.append("feature_importance", t.orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("model_id"), F.lit("x").alias("feature_name"), F.col("o_totalprice").alias("importance")), 0)
    return store.read("feature_importance").select("model_id", "importance")


# user code


class _Doubles:
    """A user's generator: twice each numeric column."""

    def generate_all_features(self, df, group_col, numeric_cols, date_col):
        return df.select("*", *((F.col(c) * 2).alias(f"{c}_twice") for c in numeric_cols))


class _Mean:
    """A user's model: the mean of the label."""

    def fit(self, df):
        return modeling.MeanModel(df, ["l_quantity"])


@query("select o_orderkey, o_totalprice * 2 as o_totalprice_twice from orders")
def custom_generator(t: Tables):
    return custom.generate(_Doubles(), t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), ORDERS).select("o_orderkey", "o_totalprice_twice")


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, round((select avg(l_extendedprice) from lineitem where l_orderkey % 5 <> 0), 4) as prediction from lineitem where l_orderkey % 5 = 0")
def custom_model(t: Tables):
    df = t.lineitem.select(*LK, "l_quantity", F.col("l_extendedprice").alias("target"))
    return rounded(custom.fit_predict(_Mean(), df.filter("l_orderkey % 5 <> 0"), df.filter("l_orderkey % 5 = 0")).select(*LK, "prediction"), 4)
