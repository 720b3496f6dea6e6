"""Typing, cleaning, column selection and imputation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import PanelSpec


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def value(c: str | Column) -> Column:
    """The number, or null where it is NaN."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in float and double columns, so that aggregates skip both."""
    return df.withColumns({f.name: value(f.name) for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def reduce_precision(df: DataFrame) -> DataFrame:
    """double becomes float; a long column becomes short or int if its least and greatest value fit (one pass)."""
    longs = [f.name for f in df.schema if isinstance(f.dataType, T.LongType)]
    row = df.agg(*(x for c in longs for x in (F.min(c).alias(f"a{longs.index(c)}"), F.max(c).alias(f"b{longs.index(c)}")))).first() if longs else None

    def kind(f):
        if isinstance(f.dataType, T.DoubleType):
            return "float"
        if f.name in longs:
            lo, hi = row[f"a{longs.index(f.name)}"], row[f"b{longs.index(f.name)}"]
            if lo is not None:
                return "short" if -(2**15) <= lo and hi < 2**15 else "int" if -(2**31) <= lo and hi < 2**31 else None
        return None

    return df.select(*(F.col(f.name).cast(kind(f)).alias(f.name) if kind(f) else F.col(f.name) for f in df.schema))


def keys_to_string(df: DataFrame, keys: Iterable[str] = ("symbol", "asset", "date", "id")) -> DataFrame:
    """void columns and the keys become strings."""
    return df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, T.NullType) or f.name in keys})


def conform_keys(df: DataFrame, run_date: str | None = None) -> DataFrame:
    """asset, symbol, date (string) and id = asset_date. Where asset and date are absent they come from id, or asset from
    symbol and date from run_date."""
    has = set(df.columns)
    if "asset" not in has and "symbol" not in has:
        df = df.withColumn("asset", F.split_part("id", F.lit("_"), F.lit(1)))
        df = df if "date" in has else df.withColumn("date", F.split_part("id", F.lit("_"), F.lit(2)))
    elif "asset" not in has:
        df = df.withColumn("asset", F.col("symbol"))
    if "date" not in df.columns:
        if run_date is None:
            raise ValueError("rows have no date: give run_date")
        df = df.withColumn("date", F.lit(run_date))
    df = df if "symbol" in df.columns else df.withColumn("symbol", F.col("asset"))
    df = df.withColumn("date", F.date_format("date", "yyyy-MM-dd") if isinstance(df.schema["date"].dataType, (T.DateType, T.TimestampType)) else F.col("date").cast("string"))
    return df if "id" in df.columns else df.withColumn("id", F.concat_ws("_", "asset", "date"))


def lenient_timestamp(c: str | Column, fallback: str = "2000-01-01", fmt: str | None = None) -> Column:
    """The timestamp, or fallback where the text is none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_to_timestamp(c.cast("string"), F.lit(fmt)) if fmt else F.try_to_timestamp(c.cast("string")), F.lit(fallback).cast("timestamp"))


def filter_symbols(df: DataFrame, symbols: list | DataFrame, column: str = "symbol") -> DataFrame:
    """Rows of these symbols: a list for a few, a table (semi-join) for many."""
    return df.join(symbols.select(column).distinct(), column, "left_semi") if isinstance(symbols, DataFrame) else df.filter(F.col(column).isin(list(symbols)))


def extract_features(df: DataFrame, spec: PanelSpec, keep_target: bool = False) -> DataFrame:
    """Keys and features."""
    return df.select(spec.group, spec.order, *spec.tiebreak, *([spec.target] if keep_target and spec.target in df.columns else []), *spec.features(df))


def keep_required(df: DataFrame, spec: PanelSpec, required: Iterable[str]) -> tuple[DataFrame, list[str]]:
    """Keys and the required columns that are there, and the names that are not."""
    required = list(required)
    return df.select(spec.group, spec.order, *(c for c in required if c in df.columns)), [c for c in required if c not in df.columns]


def align_to_model(df: DataFrame, keys: Iterable[str], features: Iterable[str], fill: float = 0.0) -> DataFrame:
    """The model's features by name and in its order: missing ones are filled, extra ones go, null and NaN are filled."""
    have = set(df.columns)
    return df.select(*keys, *((F.coalesce(value(F.col(c).cast("double")), F.lit(fill)) if c in have else F.lit(fill)).alias(c) for c in features))


def drop_prefixed(df: DataFrame, prefix: str = "random_baseline_") -> DataFrame:
    return df.drop(*(c for c in df.columns if c.startswith(prefix)))


def hash_sample(df: DataFrame, keys: Iterable[str], fraction: float, seed: int = 42) -> DataFrame:
    """The rows whose key hash falls under the fraction: the same rows for any partitioning."""
    return df.filter(key_number(keys, seed) < F.lit(int(fraction * (1 << 52))))


def key_number(keys: Iterable[str], seed: int) -> Column:
    """A number below 2**52 from the key's values and a seed: the same in any engine that has md5."""
    text = F.concat_ws(":", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def clip(c: str | Column, low: float, high: float) -> Column:
    """Between low and high; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def neutral(c: str | Column, fill: float = 0.5) -> Column:
    """fill for a null or NaN prediction."""
    return F.coalesce(value(c), F.lit(fill))


def one_hot(df: DataFrame, column: str, most: int = 1000) -> DataFrame:
    """{c}_{v} 0/1 for each distinct value, in order; raises beyond `most` values."""
    values = [r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values")
    return df.select("*", *(F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in values))


def impute_mean(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """null and NaN become the column's mean over the whole table, 0 where there is none (one pass)."""
    columns = list(columns) if columns is not None else _numeric(df)
    row = df.agg(*(F.avg(value(F.col(c).cast("double"))).alias(str(i)) for i, c in enumerate(columns))).first()
    return df.withColumns({c: F.coalesce(value(F.col(c).cast("double")), F.lit(float(row[str(i)] if row[str(i)] is not None else 0.0))) for i, c in enumerate(columns)})


def impute_zero(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return df.withColumns({c: F.coalesce(value(F.col(c).cast("double")), F.lit(0.0)) for c in (columns if columns is not None else _numeric(df))})


def missing_report(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(column, n_missing, n_rows), null and NaN alike, in one pass."""
    columns = list(columns) if columns is not None else df.columns
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    lost = lambda c: (F.col(c).isNull() | F.isnan(c)) if c in floats else F.col(c).isNull()
    one = df.agg(F.count("*").alias("n"), *(F.coalesce(F.sum(lost(c).cast("long")), F.lit(0)).alias(f"m{i}") for i, c in enumerate(columns)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing"), F.col("n").alias("n_rows")) for i, c in enumerate(columns)))).alias("r")).select("r.*")
