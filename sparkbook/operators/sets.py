"""Row selection per group, deduplication and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], desc: bool = True) -> DataFrame:
    """One row per key: the greatest (``desc``) or least row by ``order``.

    ``order`` must be a total order within a key. An aggregation with
    ``max_by``/``min_by`` of the row struct: Spark sorts each task's rows by key
    to combine them (a struct has no hash-aggregate buffer), then a key holding
    a third of all rows shuffles one partial row per task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    pick = F.max_by if desc else F.min_by
    g = df.groupBy(*keys).agg(pick(F.struct(*rest), ordk).alias("__row"))
    return g.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def union_all(*dfs: DataFrame) -> DataFrame:
    """Rows of all frames by column name, repeats kept."""
    return reduce(DataFrame.unionByName, dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """Distinct rows of all frames by column name."""
    return union_all(*dfs).distinct()
