"""Book arithmetic over tables: FX resolution and conversion, payment schedules
and income, fees, portfolio value. Running balances are ``scan.prefix_sum``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkbook.operators.joins import asof_join, asof_points


def fx_rate(
    days: DataFrame,
    rates: DataFrame,
    currency_col: str = "currency",
    day_col: str = "trade_date",
    base_currency=0,
    before_start: str = "null",
    pegs: DataFrame | None = None,
) -> DataFrame:
    """Units of each currency per base-currency unit on each (currency, day):
    the latest published rate on or before the day; the base currency is 1.

    ``before_start='first'`` falls back to the earliest rate of the currency
    for days before its series starts (the producer's rule); ``'null'``
    leaves them null (the warehouse check's rule). ``pegs`` (currency,
    units_per_eur) supplies fixed rates for currencies without a series.
    Works on distinct (currency, day) pairs: bounded by currencies x days.
    """
    cd = days.select(F.col(currency_col).alias("currency"), F.col(day_col).alias("__day")).distinct()
    r = rates.select("currency", "rate_date", "units_per_eur")
    out = asof_points(cd, r, ["currency"], "__day", "rate_date", ["units_per_eur"])
    if before_start == "first":
        first = r.groupBy("currency").agg(F.min_by("units_per_eur", "rate_date").alias("__first"))
        out = out.join(first, "currency", "left").withColumn(
            "units_per_eur", F.coalesce("units_per_eur", "__first")).drop("__first")
    if pegs is not None:
        p = pegs.select("currency", F.col("units_per_eur").alias("__peg"))
        out = out.join(p, "currency", "left").withColumn("units_per_eur", F.coalesce("units_per_eur", "__peg")).drop("__peg")
    rate = F.when(F.col("currency") == F.lit(base_currency), F.lit(1.0)).otherwise(F.col("units_per_eur"))
    return out.select(F.col("currency").alias(currency_col), F.col("__day").alias(day_col), rate.alias("units_per_eur"))


def attach_rates(tickets: DataFrame, rates_by_day: DataFrame, day_col: str = "trade_date",
                 legs: Sequence[tuple[str, str]] = (("buy_currency", "buy_rate"), ("sell_currency", "sell_rate"))) -> DataFrame:
    """Join the resolved (currency, day) rates to each leg of each ticket."""
    out = tickets
    for ccy_col, name in legs:
        r = rates_by_day.select(F.col("currency").alias(ccy_col), F.col(day_col), F.col("units_per_eur").alias(name))
        out = out.join(r, [ccy_col, day_col], "left")
    return out


def cross_rate(buy_rate: Column, sell_rate: Column) -> Column:
    """Units of the buy currency per unit of the sell currency (8 decimals)."""
    return F.round(F.coalesce(buy_rate, F.lit(1.0)) / F.coalesce(sell_rate, F.lit(1.0)), 8)


def sell_cost(buy_amount: Column, buy_rate: Column, sell_rate: Column, margin_bp: Column) -> Column:
    """What the client pays: buy amount at mid, plus the house margin."""
    mid = F.coalesce(buy_rate, F.lit(1.0)) / F.coalesce(sell_rate, F.lit(1.0))
    return F.round(buy_amount / mid * (1 + margin_bp / 10000), 2)


def payment_schedule(instruments: DataFrame, key: str, per_year: str, anchor_month: str, anchor_day: str,
                     first_year: int | Column, last_year: int | Column) -> DataFrame:
    """Payment dates (key, pay_date): ``per_year`` evenly spaced months counted
    from the anchor month, wrapping inside the calendar year, on the anchor day
    (the month's last day where it is shorter), for every year in range.
    """
    years = F.sequence(*[y if isinstance(y, Column) else F.lit(y) for y in (first_year, last_year)])
    payments = F.sequence(F.lit(0), F.col(per_year) - 1)
    x = instruments.select(key, per_year, anchor_month, anchor_day, F.explode(years).alias("__y"))
    x = x.withColumn("__k", F.explode(payments))
    month = (F.col(anchor_month) - 1 + F.col("__k") * F.floor(F.lit(12) / F.col(per_year))) % 12 + 1
    first_of_month = F.make_date("__y", month.cast("int"), F.lit(1))
    day = F.least(F.col(anchor_day), F.dayofmonth(F.last_day(first_of_month)))
    return x.select(key, F.date_add(first_of_month, (day - 1).cast("int")).alias("pay_date"))


def ex_date_adjust(series: DataFrame, dividends: DataFrame, key: str, day: str, price: str, least: float = 0.01) -> DataFrame:
    """``series`` with ``adjusted_price``: from each ex date on, the price less
    the dividend (``dividends``: key, ex_date, amount, one row per ex date).

    The total drop after the k-th dividend is max(D, min(D + amount, m - least)),
    D the drop before it and m the lowest price from the ex date on, so a
    dividend above what the series can bear is cut and never turns it negative.
    Drops are folded over one instrument's dividends; the series itself is only
    joined to the drop in force.
    """
    low = Window.partitionBy(key).orderBy(F.col(day).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    floors = series.select(F.col(key).alias("__k"), F.col(day).alias("__d"), F.min(price).over(low).alias("__m"))
    first = F.row_number().over(Window.partitionBy(key, "ex_date").orderBy("__d"))
    # The lowest price from the first priced day on or after the ex date: the next point of the series.
    points = floors.select("__k", F.col("__d"), "__m", F.lag("__d").over(Window.partitionBy("__k").orderBy("__d")).alias("__before"))
    due = dividends.join(points, (F.col(key) == F.col("__k")) & (F.col("ex_date") <= F.col("__d")) & (F.col("__before").isNull() | (F.col("ex_date") > F.col("__before"))))
    due = due.withColumn("__n", first).filter("__n = 1")
    ordered = F.array_sort(F.collect_list(F.struct("ex_date", F.col("amount").cast("double").alias("amount"), F.col("__m").cast("double").alias("m"))))
    start = F.array(F.struct(F.lit(None).cast("date").alias("ex_date"), F.lit(0.0).alias("drop")))
    fold = F.aggregate(ordered, start, lambda acc, x: F.concat(acc, F.array(F.struct(
        x["ex_date"].alias("ex_date"), F.greatest(F.element_at(acc, -1)["drop"], F.least(F.element_at(acc, -1)["drop"] + x["amount"], x["m"] - least)).alias("drop")))))
    drops = due.groupBy(key).agg(fold.alias("__x")).select(key, F.explode("__x").alias("__x")).filter("__x.ex_date is not null")
    drops = drops.select(key, F.col("__x.ex_date").alias("ex_date"), F.col("__x.drop").alias("__drop"))
    out = asof_join(series, drops, [key], day, "ex_date", ["__drop"])
    return out.withColumn("adjusted_price", F.col(price) - F.coalesce("__drop", F.lit(0.0))).drop("__drop")


def profile_tilt(instruments: DataFrame, targets: DataFrame, class_col: str, step_value: str, reference_slice: float) -> DataFrame:
    """Multiplier per profile and class that draws a class toward its target share of value.

    ``targets``: (profile, class, target), a row for each class a profile draws
    from. A class's natural share is its part of the instruments, its value
    factor the larger of 1 and its median dealing step over ``reference_slice``;
    the multiplier is target / (share * factor). Steps are counted per value
    first, so no class is held row by row.
    """
    counts = instruments.groupBy(class_col, step_value).agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy(class_col)
    ranked = counts.withColumn("upto", F.sum("n").over(own.orderBy(step_value))).withColumn("size", F.sum("n").over(own))
    middle = (F.min(F.when(F.col("upto") * 2 >= F.col("size"), F.col(step_value))) + F.min(F.when(F.col("upto") * 2 > F.col("size"), F.col(step_value)))) / 2
    classes = ranked.groupBy(class_col).agg(F.first("size").alias("size"), middle.cast("double").alias("step"))
    share = F.col("size") / F.sum("size").over(Window.partitionBy())  # over one row per class
    classes = classes.withColumn("natural", share * F.greatest(F.lit(1.0), F.col("step") / reference_slice))
    t = targets.join(classes, F.col("class") == F.col(class_col))
    return t.select("profile", "class", (F.col("target") / F.col("natural")).alias("multiplier"))
