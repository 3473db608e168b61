"""Queries over the position book: movements, holdings, deltas, the dense
daily book, carry-forward prices and valuation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkbook.operators import positions as pos
from sparkbook.operators.joins import resolve_version
from sparkbook.operators.temporal import replay_versions
from sparkbook.plans import standins as S
from sparkbook.plans.oracle_sql import with_ctes
from sparkbook.plans.registry import register

BOOK_KEYS = ["account_id", "isin"]


@register("q_movements", with_ctes(
    "select account_id, isin, trading_venue_mic, movement_date, quantity_delta, movement_type, movement_id "
    "from movements", "movements"))
def q_movements(spark, d):
    """M2: trades and transfers as one signed movement stream."""
    return S.movements(spark, d)


@register("q_holdings", with_ctes(
    "select account_id, isin, min(movement_date) as first_movement_date from movements group by account_id, isin",
    "movements"))
def q_holdings(spark, d):
    """A1: first movement date per holding."""
    return pos.holdings(S.movements(spark, d), BOOK_KEYS)


@register("q_daily_deltas", with_ctes(
    "select account_id, isin, movement_date, sum(quantity_delta) as quantity_delta "
    "from movements group by account_id, isin, movement_date", "movements"))
def q_daily_deltas(spark, d):
    """A2: net quantity change per holding and day."""
    return pos.daily_deltas(S.movements(spark, d), BOOK_KEYS)


# Quantity on a day: the sum of what moved on open days so far, found by an as-of lookup.
_BOOK_SQL_CTES = {
    "moved": "select account_id, isin, movement_date, sum(sum(case when is_trading_day then quantity_delta else 0 end)) over "
             "(partition by account_id, isin order by movement_date) as so_far from movements join calendar on movement_date = calendar_date "
             "group by account_id, isin, movement_date",
    "open_since": "select account_id, isin, date_key, is_last_trading_day_of_month from (select account_id, isin, min(movement_date) as since "
                  "from movements group by account_id, isin) join dates on is_trading_day and date_key >= since",
    "book": "select o.account_id, o.isin, o.date_key as business_date, o.is_last_trading_day_of_month, cast(m.so_far as bigint) as closing_quantity "
            "from open_since o asof join moved m on o.account_id = m.account_id and o.isin = m.isin and o.date_key >= m.movement_date",
}


def book_sql(body: str, *more: str, extra: dict[str, str] | None = None) -> str:
    return with_ctes(body, "movements", "calendar", "dates", *more, extra={**_BOOK_SQL_CTES, **(extra or {})})


@register("q_spine", book_sql("select account_id, isin, date_key as business_date, is_last_trading_day_of_month from open_since"))
def q_spine(spark, d):
    """Dense (holding x open day) spine from each first movement onward."""
    bk = S.book(spark, d)
    book = pos.position_book(bk.movements, bk.dates, BOOK_KEYS, daily=True)
    return book.select(*BOOK_KEYS, "business_date", "is_last_trading_day_of_month")


@register("q_position_daily", book_sql("select * from book"))
def q_position_daily(spark, d):
    """M13 core (J8, J9, W5): dense daily closing quantity per holding."""
    bk = S.book(spark, d)
    return pos.position_book(bk.movements, bk.dates, BOOK_KEYS, daily=True)


# A held day's price: its own print, or the latest print of an earlier held day.
_PRICES_FILLED = {
    "days": "select distinct isin, business_date as day from book",
    "prints": "select p.* from prices p join days on p.isin = days.isin and business_date = day",
    "prices_filled": "select days.isin, day as business_date, price, price_currency, price_convention, "
                     "case when business_date = day then price_source else 'carried_forward' end as price_source "
                     "from days asof left join prints on days.isin = prints.isin and day >= business_date",
}


def prices_filled(bk, lookback=False):
    return pos.carry_forward_prices(pos.held_days(bk.movements, bk.dates), bk.prices, lookback=lookback)


@register("q_carry_forward", book_sql("select * from prices_filled", "prices", extra=_PRICES_FILLED))
def q_carry_forward(spark, d):
    """Last known price carried over held days, with its source marker."""
    return prices_filled(S.book(spark, d))


@register("q_price_texture", book_sql(
    "select count_if(price_source = 'carried_forward') as carried_rows, "
    "count(distinct case when price_source = 'carried_forward' then isin end) as instruments_missing_prints, "
    "count_if(price is null) as unpriced_rows from prices_filled", "prices", extra=_PRICES_FILLED))
def q_price_texture(spark, d):
    """Carried-forward rows and instruments that miss a print."""
    pf = prices_filled(S.book(spark, d))
    cf = F.col("price_source") == "carried_forward"
    return pf.agg(
        F.count_if(cf).alias("carried_rows"),
        F.count_distinct(F.when(cf, F.col("isin"))).alias("instruments_missing_prints"),
        F.count_if(F.col("price").isNull()).alias("unpriced_rows"),
    )


# The value of one unit at its price, by convention, times the quantity, in cents.
_VALUED = {
    **_PRICES_FILLED,
    "worth": "select b.*, f.price, f.price_currency, f.price_source, v.instrument_version_sk, round(b.closing_quantity * (f.price * "
             "case f.price_convention when 'percent_of_par' then v.nominal_value_per_unit * 0.01 else coalesce(v.price_multiplier, 1) end), 2) "
             "as value from book b left join prices_filled f using (isin, business_date) "
             "left join brand_versions v on v.isin = b.isin and b.business_date between v.valid_from and v.valid_to",
}


def valued(spark, d, bk, holdings, quantity_basis="units", exact=False):
    """Holdings (account, isin, business_date, closing_quantity) with carried
    prices, the version of the day and the market value (``exact`` keeps the
    value decimal for exact downstream sums)."""
    versions = replay_versions(S.brand_register_events(spark, d), order=("effective_date", "record_sequence"))
    x = holdings.join(prices_filled(bk), ["isin", "business_date"], "left")
    x = resolve_version(x, versions, ["isin"], "business_date",
                        take=("instrument_version_sk", "nominal_value_per_unit", "price_multiplier"))
    value = pos.market_value(F.col("closing_quantity"), F.col("price"), F.col("price_convention"),
                             F.col("nominal_value_per_unit"), F.col("price_multiplier"), quantity_basis)
    return x.withColumn("market_value_local", value.cast("decimal(38,2)" if exact else "double"))


def valued_book(spark, d):
    """The dense book with prices, versions and market values."""
    bk = S.book(spark, d)
    x = valued(spark, d, bk, pos.position_book(bk.movements, bk.dates, BOOK_KEYS, daily=True))
    return x.select("account_id", "isin", "instrument_version_sk", "closing_quantity", "price", "market_value_local",
                    "price_currency", "price_source", "is_last_trading_day_of_month", "business_date")


@register("q_valuation", book_sql("select * exclude (value), cast(value as double) as market_value_local from worth", "prices", "brand_versions", extra=_VALUED))
def q_valuation(spark, d):
    """M13 + B4: the valued daily position book."""
    return valued_book(spark, d)
