"""Deterministic weighted sampling and top-up, distributed.

Keys come from a stable hash (same on every run and engine), so a sample is
reproducible without a seeded generator. The per-stratum top-k is a window
with a rank limit, which Spark evaluates partially before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkbook.functions.keys import stable_hash64


def uniform(id_col: str | Column) -> Column:
    """Deterministic uniform in (0, 1) from an identifier."""
    return (stable_hash64(id_col).cast("double") + 0.5) / F.lit(18446744073709551616.0)


def stratified_sample(df: DataFrame, stratum: str, id_col: str, weight: str, quota: int) -> DataFrame:
    """Weighted sample without replacement per stratum: the ``quota`` rows
    with the smallest exponential key -ln(u)/w (all rows of a small stratum).
    """
    key = -F.log(uniform(id_col)) / F.col(weight)
    w = Window.partitionBy(stratum).orderBy(key, id_col)
    return df.withColumn("__rk", F.row_number().over(w)).filter(F.col("__rk") <= quota).drop("__rk")


def top_up(sample: DataFrame, pool: DataFrame, group: str, id_col: str, floor: int) -> DataFrame:
    """Add, in id order, the first row of each group the sample lacks until
    the sample holds ``floor`` rows. Nothing runs until the result does: how many
    are needed is a scalar of the same plan, and of the first rows at most ``floor``
    are ranked.
    """
    have = sample.agg(F.count(F.lit(1))).scalar()
    missing = pool.join(sample.select(group).distinct(), group, "left_anti")
    firsts = missing.groupBy(group).agg(F.min_by(F.struct(*pool.columns), F.col(id_col)).alias("__r")).select("__r.*")
    extra = firsts.orderBy(id_col).limit(floor).withColumn("__rk", F.row_number().over(Window.orderBy(id_col)))
    return sample.unionByName(extra.filter(F.col("__rk") <= F.lit(floor) - have).select(*sample.columns))
