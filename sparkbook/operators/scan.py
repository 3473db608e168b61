"""Ordered scans that split a hot key: numbering and running sums.

Rows are range-partitioned by (keys, order), so a key with a third of all rows,
or one of its days, is cut into as many pieces as its share needs. The pieces
are written once; what a piece must add to its rows (the count or total of the
key's earlier pieces) comes from one row per key and piece. A tie in the whole
(keys, order) tuple stays in one piece: close ``order`` with a row identifier
where ties can be many.

Null keys are groups of their own, null order values come first, an empty table
gives no rows, and columns beside those named pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkbook.session import materialise


def in_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pieces", pieces: int | None = None) -> DataFrame:
    """``df`` written in (keys, order) with ``__piece``, the range it fell into, and ``__at``, ascending inside the piece."""
    n = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    # Counted over a sorted partition, so ascending in (keys, order).
    return materialise(dealt.select("*", F.spark_partition_id().alias("__piece"), F.monotonically_increasing_id().alias("__at")), name)


def _carried(dealt: DataFrame, keys: Sequence[str], per_piece: dict[str, Column], carry: Column) -> DataFrame:
    """One row per key and piece: ``per_piece`` and ``__before``, ``carry`` summed over the key's earlier pieces.

    Written, so that the planner knows its size: keys + pieces rows.
    """
    rows = dealt.groupBy(*keys, "__piece").agg(*[c.alias(n) for n, c in per_piece.items()], carry.alias("__own"))
    earlier = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(k).alias(f"__k_{k}") for k in keys]
    return materialise(rows.select(*named, F.col("__piece").alias("__p"), *per_piece, F.coalesce(F.sum("__own").over(earlier), F.lit(0)).alias("__before")), "carried")


def _joined(dealt: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return dealt.join(carried, reduce(and_, same, F.col("__piece") == F.col("__p")))


def _internal(keys: Sequence[str]) -> list[str]:
    return ["__piece", "__at", "__p", "__before", *[f"__k_{k}" for k in keys]]


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "number") -> DataFrame:
    """``df`` with ``out``: the row's place in its key by ``order``, from 0. One shuffle of the rows, no window over them."""
    dealt = in_pieces(df, keys, order, "numbered")
    carried = _carried(dealt, keys, {"__first": F.min("__at")}, F.count(F.lit(1)))
    j = _joined(dealt, carried, keys)
    return j.withColumn(out, F.col("__at") - F.col("__first") + F.col("__before")).drop("__first", *_internal(keys))


def prefix_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "running") -> DataFrame:
    """``df`` with ``out``: the running total of ``value`` in its key by ``order``, the row itself included; nulls add nothing."""
    dealt = in_pieces(df, keys, order, "running")
    carried = _carried(dealt, keys, {}, F.sum(value))
    inside = Window.partitionBy("__piece", *keys).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = _joined(dealt.withColumn("__in", F.sum(value).over(inside)), carried, keys)
    return j.withColumn(out, F.col("__before") + F.coalesce("__in", F.lit(0))).drop("__in", *_internal(keys))
