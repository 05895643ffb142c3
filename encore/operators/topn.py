"""Top-k and top-n-per-group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: list, k: int) -> DataFrame:
    """Global top k by a total order (TakeOrderedAndProject: each task keeps
    its k best, one small merge)."""
    return df.orderBy(*order).limit(k)


def top_n_per_group(df: DataFrame, keys: list[str], order: list, n: int,
                    rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows per group by a total ``order``, with their 1-based
    rank. The row_number <= n filter is planned with a partial window group
    limit before the shuffle, so even a group holding a third of all rows
    ships at most n rows per map partition."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
