"""How queries are registered: a function of tables to a DataFrame, beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import PanelSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

ORDERS = PanelSpec("o_custkey", "o_orderdate", ("o_orderkey",), target=None, exclude=("o_shippriority",))
BARS = PanelSpec("event_type", "day", (), target=None)


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def panel(self, nulls: bool = False) -> DataFrame:
        """orders as a panel; with nulls, the price of every seventeenth order is missing."""
        price = F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")) if nulls else F.col("o_totalprice")
        return self.orders.select("o_custkey", "o_orderdate", "o_orderkey", price.alias("price"))

    def bars(self) -> DataFrame:
        """Daily bars of each event type."""
        first, last = F.min_by("value", F.struct("ts", "event_id")), F.max_by("value", F.struct("ts", "event_id"))
        return self.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(first.alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), last.alias("close"), F.sum("value").alias("volume"))


def query(sql: str | None = None, name: str | None = None):
    def wrap(fn):
        key = name or fn.__name__
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql:
            SQL[key] = sql
        return fn

    return wrap


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Doubles rounded, for comparison."""
    names = columns or [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in names})


#: The panel and the bars in SQL.
KEYS = "o_custkey, o_orderdate, o_orderkey"
PANEL = "(select o_custkey, o_orderdate, o_orderkey, o_totalprice as price from orders)"
NULLS = "(select o_custkey, o_orderdate, o_orderkey, case when o_orderkey % 17 <> 0 then o_totalprice end as price from orders)"
W = "(partition by o_custkey order by o_orderdate, o_orderkey)"


def frame(n: int, w: str = W) -> str:
    return f"{w[:-1]} rows between {n - 1} preceding and current row)"


BAR = "(select event_type, ts::date as day, arg_min(value, (ts, event_id)) as open, max(value) as high, min(value) as low, arg_max(value, (ts, event_id)) as close, sum(value) as volume from events group by 1, 2)"
