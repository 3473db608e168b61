"""Reconciliation: compare two independently derived measures cell by cell.

Planned as a tagged union + grouped sum instead of a full outer join: the
aggregation combines map-side (a hot key costs one partial row per task, not
a skewed join partition) and absence on either side is naturally zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_measure: str,
    right_measure: str,
    right_keys: Sequence[str] | None = None,
    names: tuple[str, str] = ("derived_quantity", "published_quantity"),
    tolerance: float = 0,
) -> DataFrame:
    """Cells where the two measures differ (absence counts as zero).

    Each side is expected to hold one row per cell; ``right_keys`` renames
    the right side's key columns onto ``keys``.
    """
    keys = list(keys)
    rk = list(right_keys) if right_keys else keys
    a = left.select(*keys, F.col(left_measure).alias("__a"), F.lit(None).cast(left.schema[left_measure].dataType).alias("__b"))
    b = right.select(
        *[F.col(r).alias(k) for r, k in zip(rk, keys)],
        F.lit(None).cast(right.schema[right_measure].dataType).alias("__a"),
        F.col(right_measure).alias("__b"),
    )
    g = a.unionByName(b).groupBy(*keys).agg(
        F.coalesce(F.sum("__a"), F.lit(0)).alias(names[0]),
        F.coalesce(F.sum("__b"), F.lit(0)).alias(names[1]),
    )
    diff = F.col(names[0]) != F.col(names[1]) if tolerance == 0 else F.abs(F.col(names[0]) - F.col(names[1])) > tolerance
    return g.filter(diff)


def positions_at(
    movements: DataFrame,
    statement_dates: DataFrame,
    dates: DataFrame,
    keys: Sequence[str] = ("account_id", "isin"),
    date_col: str = "movement_date",
    qty_col: str = "quantity_delta",
    open_days_only: bool = True,
    out_date: str = "snapshot_date",
    out_qty: str = "quantity",
    daily: bool = False,
) -> DataFrame:
    """Quantity per holding at each statement date by *range aggregation*:
    sum of every movement dated on or before the statement date. Zero
    positions are omitted (a statement lists holdings only).

    Movements are bucketed into the statement period that first covers them,
    summed per period, accumulated over periods and spread over the following
    statement dates. Like the daily book it is a running sum, over periods
    instead of days; ``positions_by_blocks`` is the one to hold a book against.
    ``open_days_only`` drops movements on closed
    days, as the book does; without it they count, as a custodian books them.
    ``daily`` as in ``position_book``.
    """
    keys = list(keys)
    st = statement_dates.select(F.col(statement_dates.columns[0]).alias("__s")).distinct()
    idx = st.select("__s", F.row_number().over(Window.orderBy("__s")).alias("__i"))
    last_i = F.coalesce(idx.agg(F.max("__i")).scalar(), F.lit(0))
    cal = dates.select("date_key", "is_trading_day")
    cal = cal.join(idx, cal["date_key"] == idx["__s"], "left")
    fwd = Window.orderBy("date_key").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    period = cal.select("date_key", "is_trading_day", F.first("__i", ignorenulls=True).over(fwd).alias("__period"))
    period = period.filter(F.col("__period").isNotNull())
    if open_days_only:
        period = period.filter("is_trading_day")
    period = F.broadcast(period.select("date_key", "__period"))

    d = movements.withColumnRenamed(qty_col, "__q") if daily else movements.groupBy(*keys, date_col).agg(F.sum(qty_col).alias("__q"))
    d = d.join(period, d[date_col] == period["date_key"], "inner")
    per = d.groupBy(*keys, "__period").agg(F.sum("__q").alias("__q"))
    w = Window.partitionBy(*keys).orderBy("__period")
    cum = per.select(
        *keys, "__period",
        F.sum("__q").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__cum"),
        F.lead("__period").over(w).alias("__nextp"),
    )
    spread = cum.select(
        *keys, "__cum",
        F.explode(F.sequence("__period", F.coalesce(F.col("__nextp") - 1, last_i))).alias("__i"),
    )
    out = spread.join(F.broadcast(idx), "__i").filter(F.col("__cum") != 0)
    return out.select(*keys, F.col("__s").alias(out_date), F.col("__cum").cast("bigint").alias(out_qty))


# Day numbers count from here, and a block has at most 2**LEVELS days (to the year 2158).
ORIGIN = "1800-01-01"
LEVELS = 17


def positions_by_blocks(
    movements: DataFrame,
    statement_dates: DataFrame,
    keys: Sequence[str] = ("account_id", "isin"),
    date_col: str = "movement_date",
    qty_col: str = "quantity_delta",
    out_date: str = "snapshot_date",
    out_qty: str = "quantity",
) -> DataFrame:
    """Quantity per holding at each statement date, without any running sum.

    Days are grouped into dyadic blocks: block (k, i) holds the days from
    i * 2**k up to the next block. All days up to a date are a union of blocks,
    one per set bit of the day's number, and a day lies in one block of
    each level. So movements are summed per holding and block (only blocks that
    a statement date needs), and a date's quantity is the sum of its blocks:
    both steps are grouped sums that combine map-side. Nothing is ordered, carried
    or windowed, so a fault in the book's running sum is not repeated here.

    Zero positions are omitted; nulls in keys are a key of their own, null
    quantities add nothing, movements without a date are on no statement; a day
    outside the numbered range fails the job.
    """
    keys = list(keys)
    level = F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("__k")

    def number(day: str) -> Column:
        n = F.datediff(F.col(day), F.lit(ORIGIN).cast("date"))
        inside = F.col(day).isNull() | ((n >= 0) & (n < (1 << LEVELS)))
        return F.when(inside, n).otherwise(F.raise_error(F.concat(F.lit("day out of range: "), F.col(day).cast("string"))))

    st = statement_dates.select(F.col(statement_dates.columns[0]).alias("__s")).dropna().distinct()
    need = st.select("__s", (number("__s") + 1).alias("__m"), level).select("__s", "__k", F.expr("shiftright(__m, __k)").alias("__b")).filter("__b % 2 = 1")
    need = need.select("__s", "__k", (F.col("__b") - 1).alias("__block"))
    moved = movements.select(*keys, F.col(qty_col).alias("__q"), number(date_col).alias("__n"), level)
    moved = moved.select(*keys, "__q", "__k", F.expr("shiftright(__n, __k)").alias("__block")).filter("__block % 2 = 0")
    sums = moved.join(need.select("__k", "__block").distinct(), ["__k", "__block"], "left_semi").groupBy(*keys, "__k", "__block").agg(F.sum("__q").alias("__q"))
    total = sums.join(need, ["__k", "__block"]).groupBy(*keys, "__s").agg(F.sum("__q").cast("bigint").alias(out_qty))
    return total.filter(F.col(out_qty) != 0).select(*keys, F.col("__s").alias(out_date), out_qty)
