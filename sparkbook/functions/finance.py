"""Book arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Brokerage tiers as (upper bound of the base-currency gross,
# basis points) and the minimum ticket fee.
FEE_TIERS = [(100_000.0, 25.0), (1_000_000.0, 15.0), (float("inf"), 8.0)]
MIN_FEE = 25.0
# Custody and management fees in basis points per year.
CUSTODY_BP = 25.0
MANAGEMENT_BP = 90.0


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gross(quantity: str | Column, price: str | Column, convention: str | Column) -> Column:
    """Consideration in cents: percent-of-par prices apply to the nominal quantity."""
    q, p = _c(quantity), _c(price)
    return F.when(_c(convention) == "percent_of_par", F.round(q * p / 100, 2)).otherwise(F.round(q * p, 2))


def lot_floor(budget: str | Column, price: str | Column, step: str | Column, convention: str | Column) -> Column:
    """Largest multiple of the dealing step that the budget buys: of nominal
    at a percent-of-par price, of units otherwise."""
    unit_price = F.when(_c(convention) == "percent_of_par", _c(price) / 100).otherwise(_c(price))
    steps = F.floor(_c(budget) / unit_price / _c(step))
    return F.greatest(steps, F.lit(0)) * _c(step)


def pull_to_par(price: str | Column, elapsed_days: str | Column, days_to_maturity: str | Column) -> Column:
    """100 + (p - 100) * clip(1 - elapsed / dtm, 0, 1): a bond converges to par."""
    frac = F.least(F.greatest(1 - _c(elapsed_days) / _c(days_to_maturity), F.lit(0.0)), F.lit(1.0))
    return F.lit(100.0) + (_c(price) - 100) * frac


def tiered_fee(
    gross_amount: str | Column,
    base_amount: str | Column | None = None,
    tiers: Sequence[tuple[float, float]] = tuple(FEE_TIERS),
    minimum: float = MIN_FEE,
) -> Column:
    """Brokerage: the first tier whose bound holds the base-currency gross
    picks the rate (bp), applied to the local gross; at least ``minimum``.

    With a decimal gross the arithmetic stays exact decimal (the rate is a
    decimal fraction), so half-cent ties round the same on every engine.
    """
    g = _c(gross_amount)
    b = g if base_amount is None else _c(base_amount)

    def frac(bp: float) -> Column:
        return F.lit(Decimal(str(bp)) / Decimal(10_000))

    rate = frac(tiers[-1][1])
    for cap, r in reversed(list(tiers[:-1])):
        rate = F.when(b <= F.lit(Decimal(str(cap))), frac(r)).otherwise(rate)
    return F.round(F.greatest(F.lit(Decimal(str(minimum))), g * rate), 2)


def accrued_interest(nominal: str | Column, coupon_rate: str | Column, last_coupon: str | Column, day: str | Column) -> Column:
    """ACT/365 accrual since the latest coupon date on or before the day."""
    days = F.datediff(_c(day), _c(last_coupon))
    return F.round(_c(nominal) * _c(coupon_rate) / 100 * days / 365, 2)


def periodic_fee(value: str | Column, bp_per_year: float, periods_per_year: int = 4) -> Column:
    return F.round(_c(value) * bp_per_year / 10_000 / periods_per_year, 2)
