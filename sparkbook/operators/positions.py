"""Position operators: movements, holdings, daily deltas, the dense daily
position book, price carry-forward and valuation.

The dense book is the largest output of the system (holdings x trading
days). It is derived from the *sparse* per-holding running sum: one window
over the daily deltas of each holding (bounded by the number of days), then
every delta row is expanded over the days until the next delta and kept on
open days through a broadcast of the calendar (one row per day). No range join, no
nested loop, and no shuffle of the dense rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkbook.operators.joins import asof_join


def position_movements(trades: DataFrame, transfers: DataFrame) -> DataFrame:
    """Signed movements: BUY/IN add, SELL/OUT subtract (union of both feeds)."""
    t = trades.select(
        "account_id",
        "isin",
        "trading_venue_mic",
        F.col("trade_date").alias("movement_date"),
        F.when(F.col("trade_side") == "BUY", F.col("quantity")).otherwise(-F.col("quantity")).alias("quantity_delta"),
        F.lit("TRADE").alias("movement_type"),
        F.col("trade_id").alias("movement_id"),
    )
    x = transfers.select(
        "account_id",
        "isin",
        "trading_venue_mic",
        F.col("transfer_date").alias("movement_date"),
        F.when(F.col("transfer_direction") == "IN", F.col("quantity"))
        .otherwise(-F.col("quantity"))
        .alias("quantity_delta"),
        F.lit("TRANSFER").alias("movement_type"),
        F.col("transfer_id").alias("movement_id"),
    )
    return t.unionByName(x)


def holdings(movements: DataFrame, keys: Sequence[str], date_col: str = "movement_date") -> DataFrame:
    """First movement date per holding (partial aggregation before the shuffle)."""
    return movements.groupBy(*keys).agg(F.min(date_col).alias("first_movement_date"))


def daily_deltas(
    movements: DataFrame,
    keys: Sequence[str],
    date_col: str = "movement_date",
    qty_col: str = "quantity_delta",
) -> DataFrame:
    """Net quantity change per holding and day."""
    return movements.groupBy(*keys, date_col).agg(F.sum(qty_col).alias("quantity_delta"))


def _calendar_end(dates: DataFrame) -> Column:
    return dates.agg(F.max("date_key")).scalar()


def roll_movements(movements: DataFrame, rolls: DataFrame, date_col: str = "movement_date", direction: str = "following") -> DataFrame:
    """Move each movement dated on a closed day to the next (or previous) open
    day; ``rolls`` comes from ``calendar.roll_map`` (one row per day, broadcast)."""
    target = "following_date" if direction == "following" else "preceding_date"
    r = F.broadcast(rolls.select(F.col("calendar_date").alias("__d"), F.col(target).alias("__rolled")))
    out = movements.join(r, movements[date_col] == r["__d"], "left")
    return out.withColumn(date_col, F.coalesce("__rolled", date_col)).drop("__d", "__rolled")


def position_book(
    movements: DataFrame,
    dates: DataFrame,
    keys: Sequence[str] = ("account_id", "isin"),
    date_col: str = "movement_date",
    qty_col: str = "quantity_delta",
    carry: Sequence[str] = (),
    daily: bool = False,
) -> DataFrame:
    """Dense daily closing quantity per holding over open days.

    ``dates`` is the date dimension (date_key, is_trading_day,
    is_last_trading_day_of_month). A holding appears on every open day from
    its first movement to the calendar end; only movements dated on open
    days count (a movement on a closed day is dropped, as in the reference
    book; use ``roll_movements`` first to roll it instead). ``carry`` names
    per-holding attributes kept from the holdings grain (e.g. a venue).
    ``daily`` says that ``movements`` has one row per holding and day already,
    which saves a shuffle.
    """
    keys = list(keys)
    open_days = dates.filter("is_trading_day").select("date_key", "is_last_trading_day_of_month")
    end = _calendar_end(open_days)
    open_flag = F.broadcast(open_days.select(F.col("date_key").alias("__d"), F.lit(True).alias("__open")))

    agg = [F.sum(qty_col).alias("quantity_delta")] + [F.first(c).alias(c) for c in carry]
    deltas = movements.withColumnRenamed(qty_col, "quantity_delta") if daily else movements.groupBy(*keys, date_col).agg(*agg)
    deltas = deltas.join(open_flag, deltas[date_col] == open_flag["__d"], "left")
    effective = F.when(F.col("__open"), F.col("quantity_delta")).otherwise(F.lit(0))

    w = Window.partitionBy(*keys).orderBy(date_col)
    running = deltas.select(
        *keys,
        *carry,
        F.col(date_col).alias("__from"),
        F.sum(effective).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("closing_quantity"),
        F.lead(date_col).over(w).alias("__next"),
    )
    upto = F.coalesce(F.date_sub("__next", 1), end)
    dense = running.select(
        *keys,
        *carry,
        "closing_quantity",
        F.explode(F.when(F.col("__from") <= upto, F.sequence("__from", upto))).alias("business_date"),
    )
    cal = F.broadcast(open_days)
    book = dense.join(cal, dense["business_date"] == cal["date_key"], "inner").drop("date_key")
    return book.select(*keys, *carry, "business_date", "is_last_trading_day_of_month", F.col("closing_quantity").cast("bigint"))


def held_days(movements: DataFrame, dates: DataFrame, key: str = "isin", date_col: str = "movement_date") -> DataFrame:
    """Distinct (key, open day) covered by the book: every open day from the
    key's earliest movement to the calendar end. Computed from one small
    aggregate, not from a distinct over the dense book."""
    open_days = dates.filter("is_trading_day").select("date_key")
    end = _calendar_end(open_days)
    start = movements.groupBy(key).agg(F.min(date_col).alias("__start"))
    days = start.select(
        key, F.explode(F.when(F.col("__start") <= end, F.sequence("__start", end))).alias("business_date")
    )
    cal = F.broadcast(open_days)
    return days.join(cal, days["business_date"] == cal["date_key"], "inner").select(key, "business_date")


def carry_forward_prices(
    days: DataFrame,
    prices: DataFrame,
    key: str = "isin",
    value_cols: Sequence[str] = ("price", "price_currency", "price_convention"),
    source_col: str = "price_source",
    lookback: bool = False,
) -> DataFrame:
    """Price on every held day: the day's print, else the last earlier value.

    Default (reference semantics): carry forward within the held days only,
    so a missing print on the first held day stays null. ``lookback=True``
    instead takes the latest print on or before the day from the full feed
    (as-of join), which fills that first day too.
    """
    p = prices.select(key, "business_date", *value_cols, source_col)
    if lookback:
        exact = days.join(p.select(key, "business_date", source_col), [key, "business_date"], "left")
        pts = prices.select(key, F.col("business_date").alias("__pd"), *value_cols)
        out = asof_join(exact, pts, [key], "business_date", "__pd", list(value_cols)).drop("__pd")
        return out.select(
            key, "business_date", *value_cols, F.coalesce(source_col, F.lit("carried_forward")).alias(source_col)
        )
    joined = days.join(p, [key, "business_date"], "left")
    w = Window.partitionBy(key).orderBy("business_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        key,
        "business_date",
        *[F.last(c, ignorenulls=True).over(w).alias(c) for c in value_cols],
        F.coalesce(source_col, F.lit("carried_forward")).alias(source_col),
    )


def market_value(
    quantity: Column,
    price: Column,
    convention: Column,
    nominal_per_unit: Column,
    multiplier: Column,
    quantity_basis: str = "units",
) -> Column:
    """Local market value by price convention, rounded to cents.

    percent_of_par: quantity x nominal per unit x price / 100 (``units``
    basis, the mart formula) or quantity x price / 100 when the quantity is
    already a nominal amount (``nominal`` basis). Otherwise quantity x price
    x multiplier (default 1).
    """
    if quantity_basis == "nominal":
        par = quantity * price / 100
    else:
        par = quantity * nominal_per_unit * price / 100
    return F.when(convention == "percent_of_par", F.round(par, 2)).otherwise(
        F.round(quantity * price * F.coalesce(multiplier, F.lit(1)), 2)
    )
