"""Defect injectors: test-side transforms that plant one named defect so the
matching check is shown able to fail.

The victim is chosen deterministically and in a distributed way: the row
with the smallest stable hash of its id (ties broken by the whole row), a
single-row aggregate rather than a global sort. Taking one row out is a join
with that one row on all columns, which moves no other row; its further
occurrences are counted and put back.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbook.functions.keys import stable_hash64
from sparkbook.session import materialise

# The identifiers planted by the orphan defects.
ORPHAN_ISIN = "XX0000000000"
ORPHAN_ACCOUNT = 99999


def victim(df: DataFrame, id_col: str) -> DataFrame:
    """The single row with the least stable hash of ``id_col``."""
    cols = df.columns
    pick = F.min(F.struct(stable_hash64(F.col(id_col)).alias("__h"), *[F.col(c) for c in cols]))
    picked = df.agg(pick.alias("__v")).filter(F.col("__v").isNotNull())
    return picked.select(*[F.col(f"__v.{c}").alias(c) for c in cols])


def without_one(df: DataFrame, v: DataFrame) -> DataFrame:
    """``df`` less one occurrence of the single row ``v``."""
    one = F.broadcast(v.select(*[F.col(c).alias(f"__v_{c}") for c in df.columns]))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__v_{c}")) for c in df.columns])
    copies = df.join(one, same, "left_semi").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    again = copies.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n")))).filter("__k > 1").drop("__n", "__k")
    return df.join(one, same, "left_anti").unionByName(again)


def duplicate_row(df: DataFrame, id_col: str) -> DataFrame:
    return df.unionByName(victim(df, id_col))


def replace_in_row(df: DataFrame, id_col: str, changes: dict[str, Column]) -> DataFrame:
    """Swap exactly one occurrence of the victim for a modified copy.

    The injected table is written under the shared folder, never to the clean
    location: downstream checks then plan against a plain table instead of
    pushing joins into a branch whose key became a constant (which would turn
    an equi-join into a nested loop).
    """
    v = victim(df, id_col)
    changed = v.withColumns(changes).select(*df.columns)
    return materialise(without_one(df, v).unionByName(changed), "injected")


def remove_row(df: DataFrame, id_col: str, refuse_empty: bool = True) -> DataFrame:
    """Drop one occurrence of the victim; refuse when nothing would be removed."""
    v = victim(df, id_col)
    if refuse_empty and v.limit(1).count() == 0:
        raise ValueError("defect removed nothing: the input is empty")
    return without_one(df, v)


def oversell(movements: DataFrame, book_last: DataFrame, keys: Sequence[str], day: Column) -> DataFrame:
    """Add a sell of twice the victim holding's final quantity on ``day``."""
    held = book_last.filter(F.col("closing_quantity") > 0)
    v = victim(held.withColumn("__id", F.concat_ws("|", *[F.col(k).cast("string") for k in keys])), "__id")
    extra = v.select(*keys, (-2 * F.col("closing_quantity")).alias("quantity_delta")).withColumn("movement_date", day)
    return movements.unionByName(extra, allowMissingColumns=True)
