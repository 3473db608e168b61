"""Calendar operators: trading-day spine, date dimension, session offsets and
date rolling.

A calendar is bounded by its date range (about 36.5k rows per century per
calendar code), so a window over one calendar and a broadcast of it are safe by
construction. Where a frame has ``calendar_code``, every window is partitioned
by it and the code is kept in the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CODE = "calendar_code"


def _code(calendar: DataFrame) -> list[str]:
    return [CODE] if CODE in calendar.columns else []


def date_range(bounds: DataFrame, start_col: str, end_col: str, out: str = "calendar_date") -> DataFrame:
    """One row per day in [start, end] for every row of ``bounds``."""
    return bounds.select(
        *[c for c in bounds.columns if c not in (start_col, end_col)],
        F.explode(F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"))).alias(out),
    )


def trading_calendar(
    bounds: DataFrame,
    closing_days: DataFrame | None = None,
    start_col: str = "start_date",
    end_col: str = "end_date",
    closing_month_days: list[tuple[int, int]] = (),
) -> DataFrame:
    """(calendar_date, is_trading_day): open = weekday, not a listed closing day
    and not one of ``closing_month_days``. ``closing_days`` has a
    ``calendar_date`` column (and optionally a ``calendar_code`` shared with
    ``bounds``).
    """
    days = date_range(bounds, start_col, end_col)
    weekday = F.dayofweek("calendar_date").between(2, 6)
    for m, d in closing_month_days:
        weekday = weekday & ~((F.month("calendar_date") == m) & (F.dayofmonth("calendar_date") == d))
    if closing_days is None:
        return days.withColumn("is_trading_day", weekday)
    keys = [c for c in closing_days.columns if c in days.columns]
    closed = closing_days.select(*keys).distinct().withColumn("__closed", F.lit(True))
    days = days.join(closed, keys, "left")
    return days.withColumn("is_trading_day", weekday & F.col("__closed").isNull()).drop("__closed")


def fixed_holidays(bounds: DataFrame, month_days: list[tuple[int, int]], start_col="start_date", end_col="end_date") -> DataFrame:
    """Closing days that fall on the same month/day every year."""
    days = date_range(bounds, start_col, end_col)
    cond = F.lit(False)
    for m, d in month_days:
        cond = cond | ((F.month("calendar_date") == m) & (F.dayofmonth("calendar_date") == d))
    return days.filter(cond).select("calendar_date")


def dim_dates(calendar: DataFrame, date_col: str = "calendar_date") -> DataFrame:
    """Date dimension: calendar attributes plus month-end flags.

    ``day_of_week`` is 1 = Sunday .. 7 = Saturday. The last trading day of a
    month is the max open date over the month window (31 rows at most).
    """
    by = _code(calendar)
    month = Window.partitionBy(*by, F.trunc(date_col, "month"))
    d = F.col(date_col)
    return calendar.select(
        *by,
        d.alias("date_key"),
        F.year(d).cast("bigint").alias("calendar_year"),
        F.quarter(d).cast("bigint").alias("calendar_quarter"),
        F.month(d).cast("bigint").alias("calendar_month"),
        F.dayofweek(d).cast("bigint").alias("day_of_week"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.col("is_trading_day"),
        (d == F.last_day(d)).alias("is_month_end"),
        F.coalesce(d == F.max(F.when(F.col("is_trading_day"), d)).over(month), F.lit(False)).alias(
            "is_last_trading_day_of_month"
        ),
    )


def session_offset(calendar: DataFrame, n: int, date_col: str = "calendar_date", out: str = "offset_date") -> DataFrame:
    """For each open day, the open day ``n`` sessions later (null past the end).

    A window over the open days of one calendar: bounded by its length.
    """
    by = _code(calendar)
    w = Window.partitionBy(*by).orderBy(date_col)
    return (
        calendar.filter(F.col("is_trading_day"))
        .select(*by, date_col, F.lead(date_col, n).over(w).alias(out))
    )


def roll_map(calendar: DataFrame, date_col: str = "calendar_date") -> DataFrame:
    """Every calendar day with the first open day on/after it (following) and
    the last open day on/before it (preceding)."""
    by = _code(calendar)
    fwd = Window.partitionBy(*by).orderBy(date_col).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    bwd = Window.partitionBy(*by).orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_day = F.when(F.col("is_trading_day"), F.col(date_col))
    return calendar.select(
        *by,
        date_col,
        F.first(open_day, ignorenulls=True).over(fwd).alias("following_date"),
        F.last(open_day, ignorenulls=True).over(bwd).alias("preceding_date"),
    )


def session_flags(calendar: DataFrame, last_n_of_quarter: int = 5, date_col: str = "calendar_date") -> DataFrame:
    """Open days flagged as last session of month / quarter and among the last
    N sessions of the quarter (row_number descending within the period)."""
    by = _code(calendar)
    open_days = calendar.filter(F.col("is_trading_day")).select(*by, date_col)
    by_month = Window.partitionBy(*by, F.trunc(date_col, "month")).orderBy(F.col(date_col).desc())
    by_quarter = Window.partitionBy(*by, F.trunc(date_col, "quarter")).orderBy(F.col(date_col).desc())
    rq = F.row_number().over(by_quarter)
    return open_days.select(
        *by,
        date_col,
        (F.row_number().over(by_month) == 1).alias("is_month_last_session"),
        (rq == 1).alias("is_quarter_last_session"),
        (rq <= last_n_of_quarter).alias("is_quarter_tail_session"),
    )


def reconcile_quotes(calendar: DataFrame, quotes: DataFrame, quote_date: str = "rate_date", code: str | None = None,
                     since: str | Column | None = None, until: str | Column | None = None) -> DataFrame:
    """Days on which observed quotes and the calendar's rules disagree.

    (calendar_date, finding): 'quoted_but_closed' is an error, reality outvotes
    the rules; 'open_but_unquoted' a warning, looked for in [since, until].
    """
    days = calendar if code is None else calendar.filter(F.col(CODE) == code)
    open_days = days.filter("is_trading_day").select(F.col("calendar_date").cast("date").alias("calendar_date"))
    seen = quotes.select(F.col(quote_date).cast("date").alias("calendar_date")).distinct()
    closed = seen.join(open_days, "calendar_date", "left_anti").withColumn("finding", F.lit("quoted_but_closed"))
    silent = open_days.join(seen, "calendar_date", "left_anti").withColumn("finding", F.lit("open_but_unquoted"))
    for bound, keep in ((since, lambda c, b: c >= b), (until, lambda c, b: c <= b)):
        if bound is not None:
            silent = silent.filter(keep(F.col("calendar_date"), bound if isinstance(bound, Column) else F.to_date(F.lit(bound))))
    return closed.unionByName(silent)
