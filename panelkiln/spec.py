"""Roles of a panel's columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import types as T


@dataclass(frozen=True)
class PanelSpec:
    """One row per group and order; tiebreak makes the order unique.

    slice_rows: where groups can hold a large share of all rows, window operators cut them into slices of so many rows
    (operators.slices). slice: the column of the slice, set there.
    """

    group: str = "symbol"
    order: str = "date"
    tiebreak: tuple[str, ...] = ()
    target: str | None = "target"
    exclude: tuple[str, ...] = field(default_factory=tuple)
    slice_rows: int | None = None
    slice: str | None = None

    def window(self) -> WindowSpec:
        return Window.partitionBy(self.group, *([self.slice] if self.slice else [])).orderBy(self.order, *self.tiebreak)

    def check(self, df: DataFrame) -> DataFrame:
        """df, if it has the group and an explicit order column; a made-up order would change with the partitioning."""
        missing = [c for c in (self.group, self.order, *self.tiebreak) if c not in df.columns]
        if missing:
            raise ValueError(f"panel columns are missing: {missing}")
        return df

    def features(self, df: DataFrame) -> list[str]:
        """Numeric columns without a role, in schema order."""
        roles = {self.group, self.order, *self.tiebreak, self.target, self.slice, *self.exclude}
        return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in roles]


def first_present(df: DataFrame, names: tuple[str, ...] = ("symbol", "Symbol", "asset")) -> str:
    """The first of the names that df has."""
    for n in names:
        if n in df.columns:
            return n
    raise ValueError(f"none of {names} is a column")
