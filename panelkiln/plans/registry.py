"""All registered queries and their DuckDB SQL."""

from . import more_queries, panel_queries, scale_queries, table_queries
from .define import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "more_queries", "panel_queries", "scale_queries", "table_queries"]
