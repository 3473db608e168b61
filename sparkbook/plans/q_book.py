"""Queries for FX resolution, cash ledger and book arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkbook.functions import finance as FN
from sparkbook.operators import book as B
from sparkbook.operators.joins import asof_points
from sparkbook.operators.scan import prefix_sum
from sparkbook.plans import standins as S
from sparkbook.plans.oracle_sql import with_ctes
from sparkbook.plans.registry import register
from sparkbook.session import materialise

BRAND_NO = "cast(substr(isin, 7, 10) as int)"


def brand_no(c="isin"):
    return F.substring(c, 7, 10).cast("int")


_RBD = {
    "cd": "select sell_currency as currency, trade_date from fx_tickets union select buy_currency, trade_date from fx_tickets",
    "rbd": "select cd.currency, cd.trade_date, case when cd.currency = 0 then 1.0 else r.units_per_eur end as units_per_eur "
           "from cd asof left join rates r on cd.currency = r.currency and cd.trade_date >= r.rate_date",
}


def ticket_days(tickets):
    """Distinct (currency, day) of both legs."""
    legs = F.explode(F.array("sell_currency", "buy_currency")).alias("currency")
    return tickets.select(legs, "trade_date").distinct()


def rates_by_day(spark, d):
    return B.fx_rate(ticket_days(S.fx_tickets(spark, d)), S.rates(spark, d))


@register("q_asof_rate", with_ctes("select * from rbd", "fx_tickets", "rates", extra=_RBD))
def q_asof_rate(spark, d):
    """Latest rate on or before each (currency, day); base = 1."""
    return rates_by_day(spark, d)


_CONVERT = ("select t.fx_trade_id, t.trade_date, t.buy_currency, t.sell_currency, b.units_per_eur as buy_rate, "
            "s.units_per_eur as sell_rate, round(coalesce(b.units_per_eur, 1) / coalesce(s.units_per_eur, 1), 8) as reference_rate, "
            "round(cast(t.buy_amount as double) / (coalesce(b.units_per_eur, 1) / coalesce(s.units_per_eur, 1)) "
            "* (1 + cast(t.margin_bp as double) / 10000), 2) as sell_amount from fx_tickets t "
            "left join rbd b on b.currency = t.buy_currency and b.trade_date = t.trade_date "
            "left join rbd s on s.currency = t.sell_currency and s.trade_date = t.trade_date")


TICKET = ["fx_trade_id", "account_id", "trade_date", "buy_currency", "sell_currency", "buy_amount"]


def priced(tickets, buy, sell):
    """Reference rate and client cost from two rate columns."""
    return tickets.withColumns({
        "reference_rate": B.cross_rate(buy, sell),
        "sell_amount": B.sell_cost(F.col("buy_amount").cast("double"), buy, sell, F.col("margin_bp").cast("double")),
    })


def converted(spark, d):
    x = B.attach_rates(S.fx_tickets(spark, d), rates_by_day(spark, d))
    return priced(x, F.col("buy_rate"), F.col("sell_rate"))


@register("q_fx_convert", with_ctes(_CONVERT, "fx_tickets", "rates", extra=_RBD))
def q_fx_convert(spark, d):
    """B2: cross rate (8 dp) and client cost with margin per ticket."""
    return converted(spark, d).select("fx_trade_id", "trade_date", "buy_currency", "sell_currency", "buy_rate", "sell_rate",
                                      "reference_rate", "sell_amount")


# How far a stored rate and amount may lie from the re-derived ones.
RATE_TOLERANCE, AMOUNT_TOLERANCE = 1.5e-8, 0.02

_FXCHECK = {
    **_RBD,
    "prior": "select cd.currency, cd.trade_date, case when cd.currency = 0 then 1.0 else (select arg_max(units_per_eur, rate_date) "
             "from rates r where r.currency = cd.currency and r.rate_date < cd.trade_date) end as units_per_eur from cd",
    "mids": "select t.*, b.units_per_eur as b0, s.units_per_eur as s0, pb.units_per_eur as b1, ps.units_per_eur as s1 from fx_tickets t "
            "left join rbd b on b.currency = t.buy_currency and b.trade_date = t.trade_date "
            "left join rbd s on s.currency = t.sell_currency and s.trade_date = t.trade_date "
            "left join prior pb on pb.currency = t.buy_currency and pb.trade_date = t.trade_date "
            "left join prior ps on ps.currency = t.sell_currency and ps.trade_date = t.trade_date",
    "both_ways": "select fx_trade_id, trade_date, (buy_currency <> 0 and b0 is null) or (sell_currency <> 0 and s0 is null) as unpriced, "
                 + ", ".join(f"round(coalesce(b{k}, 1) / coalesce(s{k}, 1), 8) as {r}, round(cast(buy_amount as double) / (coalesce(b{k}, 1) / "
                             f"coalesce(s{k}, 1)) * (1 + cast(margin_bp as double) / 10000), 2) as {a}"
                             for k, r, a in ((1, "reference_rate", "sell_amount"), (0, "expected_reference_rate", "expected_sell_amount")))
                 + " from mids",
}


@register("q_fx_check", with_ctes(
    "select * exclude (unpriced) from both_ways where unpriced or abs(reference_rate - expected_reference_rate) > 1.5e-8 "
    "or abs(sell_amount - expected_sell_amount) > 0.02", "fx_tickets", "rates", extra=_FXCHECK))
def q_fx_check(spark, d):
    """Tickets re-derived from the rate file within tolerance
    (stored values were booked with the previous day's rates).

    The rate of a day and of the day before come from one as-of pass over the
    distinct (currency, day); tickets are joined to it once per leg.
    """
    t = S.fx_tickets(spark, d)
    days = ticket_days(t)
    either = days.withColumn("trade_date", F.explode(F.array("trade_date", F.date_sub("trade_date", 1)))).distinct()
    rate = B.fx_rate(either, S.rates(spark, d))
    before = rate.select("currency", F.date_add("trade_date", 1).alias("trade_date"), F.col("units_per_eur").alias("prior"))
    both = days.join(rate, ["currency", "trade_date"], "left").join(before, ["currency", "trade_date"], "left")
    for leg in ("buy", "sell"):
        t = t.join(both.select(F.col("currency").alias(f"{leg}_currency"), "trade_date", F.col("units_per_eur").alias(f"{leg}_rate"),
                               F.col("prior").alias(f"{leg}_prior")), [f"{leg}_currency", "trade_date"], "left")
    stored = priced(t, F.col("buy_prior"), F.col("sell_prior"))
    x = priced(stored.withColumnsRenamed({"reference_rate": "s_rate", "sell_amount": "s_amount"}), F.col("buy_rate"), F.col("sell_rate"))
    bad = (((F.col("buy_currency") != 0) & F.col("buy_rate").isNull())
           | ((F.col("sell_currency") != 0) & F.col("sell_rate").isNull())
           | (F.abs(F.col("s_rate") - F.col("reference_rate")) > RATE_TOLERANCE)
           | (F.abs(F.col("s_amount") - F.col("sell_amount")) > AMOUNT_TOLERANCE))
    return x.filter(bad).select(
        "fx_trade_id", "trade_date", F.col("s_rate").alias("reference_rate"),
        F.col("reference_rate").alias("expected_reference_rate"), F.col("s_amount").alias("sell_amount"),
        F.col("sell_amount").alias("expected_sell_amount"))


_FEE_SQL = ("round(greatest(25.0, gross_consideration * (case when gross_consideration <= 100000.0 then 0.0025 "
            "when gross_consideration <= 1000000.0 then 0.0015 else 0.0008 end)), 2)")

_SCHED = {
    "sched_bounds": "select year(min(l_shipdate)) - 1 as y0, year(max(l_shipdate)) as y1 from lineitem",
    "sched_in": "select distinct p_brand as isin, [1, 2, 4, 12][cast(substr(p_brand, 7, 10) as int) % 4 + 1] as per_year, "
                "cast(substr(p_brand, 7, 10) as int) as no from part",
    "sched_m": "select isin, 28 + no % 4 as anchor_day, make_date(y, cast((no % 12 + k * (12 // per_year)) % 12 + 1 as bigint), 1) as first_of "
               "from sched_in, (select unnest(range(0, 12)) as k), (select unnest(range(y0, y1 + 1)) as y from sched_bounds) where k < per_year",
    "schedule": "select isin, cast(first_of + to_days(cast(least(anchor_day, day(last_day(first_of))) - 1 as integer)) as date) as pay_date from sched_m",
}


def payments_per_year(c="isin"):
    return F.element_at(F.array(*[F.lit(x) for x in (1, 2, 4, 12)]), (brand_no(c) % 4 + 1).cast("int"))


def is_bond(c="isin"):
    """Stand-in: brands quoted in percent of par are bonds, the others shares."""
    return brand_no(c) % 2 == 0


def coupon_rate(c="isin"):
    """Annual rate in percent of par."""
    return (F.lit(2.5) + brand_no(c) % 5).cast("decimal(9,4)")


def schedule(spark, d):
    """Payment dates for every year of the facts and the one before, so that each fact has a last payment."""
    brands = S.table(spark, d, "part").select(F.col("p_brand").alias("isin")).distinct()
    b = brands.select("isin", payments_per_year().alias("per_year"), (brand_no() % 12 + 1).alias("anchor_month"),
                      (F.lit(28) + brand_no() % 4).alias("anchor_day"))
    years = S.table(spark, d, "lineitem").select(F.year("l_shipdate").alias("y"))
    first, last = years.agg(F.min("y") - 1).scalar(), years.agg(F.max("y")).scalar()
    return B.payment_schedule(b, "isin", "per_year", "anchor_month", "anchor_day", first, last)


def trade_days(spark, d):
    """(isin, trade_date) of all trades, from the line items and their part alone."""
    p = S.table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("isin"))
    li = S.table(spark, d, "lineitem").filter(F.col("l_linestatus") == "F").select("l_partkey", F.col("l_shipdate").cast("date").alias("trade_date"))
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).select("isin", "trade_date").distinct()


def accrued(spark, d, t, days=None):
    """``t`` (isin, trade_date, quantity, ...) with last_coupon_date and accrued since then, looked up per (isin, day).

    ``days``: those of ``t``, or more, where they can be had without making ``t`` twice.
    """
    days = t.select("isin", "trade_date").distinct() if days is None else days
    s = schedule(spark, d).withColumn("__pd", F.col("pay_date"))
    last = asof_points(days, s, ["isin"], "trade_date", "__pd", ["pay_date"]).withColumnRenamed("pay_date", "last_coupon_date")
    acc = FN.accrued_interest(F.col("quantity").cast("double") * 100, F.lit(2.5) + brand_no() % 5, F.col("last_coupon_date"), F.col("trade_date"))
    return t.join(last.select("isin", "trade_date", "last_coupon_date"), ["isin", "trade_date"], "left").withColumn("accrued", acc)


_ACCRUED = "round(cast({q} as double) * 100 * (2.5 + cast(substr({i}, 7, 10) as int) % 5) / 100 * datediff('day', {p}, {t}) / 365, 2)"
_STEPS = {
    "settled": "select c.*, case when returnflag = 'R' then 1 else -1 end as sign, cast(" + _FEE_SQL + " as decimal(18,2)) as fee, "
               "case when cast(substr(c.isin, 7, 10) as int) % 2 = 0 then cast(coalesce(" + _ACCRUED.format(q="quantity", i="c.isin", p="s.pay_date", t="ship_date")
               + ", 0) as decimal(18,2)) else 0 end as acc from ctrades c asof left join schedule s on c.isin = s.isin and c.ship_date >= s.pay_date",
    "homes": "select e.*, coalesce(cast(c_nationkey as bigint), 0) as nation from cash_events e left join customer on account_id = c_custkey",
    "steps": "select account_id, nation as base, nation as currency, event_date as step_date, 0 as kind, event_id as step_id, 0 as leg, amount from homes "
             "union all select account_id, sell_currency, sell_currency, trade_date, 1, fx_trade_id, 0, -sell_amount from bought "
             "union all select account_id, sell_currency, buy_currency, trade_date, 1, fx_trade_id, 1, buy_amount from bought "
             "union all select client_id, nation, (nation + 7) % 25, ship_date, 2, line_id, 0, "
             "cast(sign * (gross_consideration + acc) - fee as decimal(18,2)) from settled",
}


# One account space: an account of the ledger is a client, its base currency the client's nation.
# Trades settle in the currency that the client's tickets buy.
_LEDGER = {
    **_RBD,
    "bought": "select t.fx_trade_id, t.account_id, t.trade_date, t.buy_currency, t.sell_currency, t.buy_amount, cast(round(cast(buy_amount as double) "
              "/ (coalesce(b.units_per_eur, 1) / coalesce(s.units_per_eur, 1)) * (1 + cast(margin_bp as double) / 10000), 2) "
              "as decimal(18,2)) as sell_amount from fx_tickets t left join rbd b on b.currency = t.buy_currency "
              "and b.trade_date = t.trade_date left join rbd s on s.currency = t.sell_currency and s.trade_date = t.trade_date",
    "ctrades": "select line_id, client_id, account_id as nation, ship_date, isin, returnflag, quantity, gross_consideration from lines "
               "where linestatus = 'F'",
}


def _client_trades(spark, d):
    b = S.book_lines(spark, d).filter(F.col("linestatus") == "F")
    return b.select("line_id", "client_id", F.col("account_id").alias("nation"), F.col("ship_date").alias("trade_date"), "isin",
                    "returnflag", "quantity", "gross_consideration")


def cash_steps(spark, d):
    """Signed cash legs (account, base, currency, step_date, kind, step_id, leg, amount).

    Events come first within a day; a ticket's two legs and a trade's settlement
    follow. Bonds settle dirty on both sides, fees are paid either way.
    """
    c = S.table(spark, d, "customer").select(F.col("c_custkey").alias("client"), F.col("c_nationkey").cast("bigint").alias("nation"))
    ev = S.cash_events(spark, d).join(c, F.col("account_id") == F.col("client"), "left")
    home = F.coalesce("nation", F.lit(0))
    events = ev.select("account_id", home.alias("base"), home.alias("currency"), F.col("event_date").alias("step_date"),
                       F.lit(0).alias("kind"), F.col("event_id").alias("step_id"), F.lit(0).alias("leg"), "amount")
    sold = F.col("sell_amount").cast("decimal(18,2)")
    legs = F.explode(F.array(F.struct(F.col("sell_currency").alias("currency"), (-sold).cast("decimal(18,2)").alias("amount"), F.lit(0).alias("leg")),
                             F.struct(F.col("buy_currency").alias("currency"), F.col("buy_amount").alias("amount"), F.lit(1).alias("leg"))))
    fx = converted(spark, d).withColumn("x", legs).select(
        "account_id", F.col("sell_currency").alias("base"), "x.currency", F.col("trade_date").alias("step_date"), F.lit(1).alias("kind"),
        F.col("fx_trade_id").alias("step_id"), "x.leg", "x.amount")
    t = accrued(spark, d, _client_trades(spark, d), trade_days(spark, d))
    fee = FN.tiered_fee(F.col("gross_consideration")).cast("decimal(18,2)")
    dirty = F.col("gross_consideration") + F.when(is_bond(), F.coalesce("accrued", F.lit(0.0))).otherwise(0.0).cast("decimal(18,2)")
    amount = F.when(F.col("returnflag") == "R", dirty - fee).otherwise(-(dirty + fee))
    trades = t.select(F.col("client_id").alias("account_id"), F.col("nation").alias("base"), ((F.col("nation") + 7) % 25).alias("currency"),
                      F.col("trade_date").alias("step_date"), F.lit(2).alias("kind"), F.col("line_id").alias("step_id"), F.lit(0).alias("leg"),
                      amount.cast("decimal(18,2)").alias("amount"))
    return events.unionByName(fx).unionByName(trades)


def ledger_sql(body, *more, extra=None):
    return with_ctes(body, "lines", "cash_events", "fx_tickets", "rates", *more, extra={**_LEDGER, **_SCHED, **_STEPS, **(extra or {})})


LEDGER_KEYS = ["account_id", "currency"]
STEP_ORDER = ["kind", "step_id", "leg", "amount"]


def balances(spark, d):
    """Every step with its balance. The steps are written first: they are dealt into ranges, which reads them twice."""
    steps = materialise(cash_steps(spark, d), "cash-steps")
    return prefix_sum(steps, LEDGER_KEYS, ["step_date", *STEP_ORDER], "amount", "balance")


@register("q_cash_steps", ledger_sql(
    "select account_id, base, currency, step_date, kind, step_id, leg, cast(amount as double) as amount from steps"))
def q_cash_steps(spark, d):
    """Signed cash legs of events, tickets and trades (fees by tier, accrued interest on both sides)."""
    return cash_steps(spark, d).withColumn("amount", F.col("amount").cast("double"))


_BALANCES = {"balances": "select *, sum(amount) over (partition by account_id, currency order by step_date, kind, step_id, leg, amount "
                         "rows between unbounded preceding and current row) as balance from steps"}


@register("q_running_cash", ledger_sql(
    "select account_id, currency, step_date, kind, step_id, leg, cast(balance as double) as balance from balances where balance < -0.005",
    extra=_BALANCES))
def q_running_cash(spark, d):
    """Running cash per account and currency in causal order; negative breaches."""
    r = balances(spark, d).filter(F.col("balance") < -0.005)
    return r.select(*LEDGER_KEYS, "step_date", "kind", "step_id", "leg", F.col("balance").cast("double").alias("balance"))


@register("q_tightest_cash", ledger_sql(
    "select account_id, currency, cast(min(balance) as double) as tightest, cast(count_if(balance < -0.005) as bigint) as breaches "
    "from balances group by account_id, currency", extra=_BALANCES))
def q_tightest_cash(spark, d):
    """Lowest balance and number of overdraft steps of each account and currency."""
    return balances(spark, d).groupBy(*LEDGER_KEYS).agg(
        F.min("balance").cast("double").alias("tightest"), F.count_if(F.col("balance") < -0.005).alias("breaches"))


@register("q_orphan_fx", with_ctes(
    "select fx_trade_id from fx_tickets where fx_trade_id not in (select line_id // 10 from lines where linestatus = 'F')", "fx_tickets", "lines"))
def q_orphan_fx(spark, d):
    """Conversions whose order has no trade."""
    traded = S.table(spark, d, "lineitem").filter(F.col("l_linestatus") == "F").select(F.col("l_orderkey").alias("fx_trade_id")).distinct()
    return S.fx_tickets(spark, d).select("fx_trade_id").join(traded, "fx_trade_id", "left_anti")


@register("q_net_new_money", with_ctes(
    "select account_id, cast(sum(amount) as double) as net_new_money from cash_events "
    "where event_type in ('signup', 'purchase') group by account_id", "cash_events"))
def q_net_new_money(spark, d):
    """Deposits plus withdrawals per account."""
    e = S.cash_events(spark, d).filter(F.col("event_type").isin("signup", "purchase"))
    return e.groupBy("account_id").agg(F.sum("amount").cast("double").alias("net_new_money"))


@register("q_gross", with_ctes(
    "select trade_id, cast(case when " + BRAND_NO + " % 2 = 0 then round(quantity * price * 0.01, 2) else round(quantity * price, 2) end "
    "as double) as gross from trades", "trades"))
def q_gross(spark, d):
    """Gross consideration by price convention."""
    t = S.trades(spark, d)
    return t.select("trade_id", FN.gross(F.col("quantity"), F.col("price"), S.convention()).cast("double").alias("gross"))


@register("q_tiered_fee", with_ctes(f"select trade_id, cast({_FEE_SQL} as double) as fee from trades", "trades"))
def q_tiered_fee(spark, d):
    """Brokerage by ticket-size tier with a minimum fee."""
    t = S.trades(spark, d)
    return t.select("trade_id", FN.tiered_fee(F.col("gross_consideration")).cast("double").alias("fee"))


@register("q_lot_floor", with_ctes(
    "select trade_id, case when " + BRAND_NO + " % 2 = 0 then greatest(floor(cast(gross_consideration as double) / (cast(price as double) / 100) "
    "/ 1000.0), 0) * 1000.0 else greatest(floor(cast(gross_consideration as double) / cast(price as double)), 0) end as lot from trades", "trades"))
def q_lot_floor(spark, d):
    """Largest affordable multiple of the dealing step."""
    t = S.trades(spark, d)
    step = F.when(brand_no() % 2 == 0, F.lit(1000.0)).otherwise(F.lit(1.0))
    lot = FN.lot_floor(F.col("gross_consideration").cast("double"), F.col("price").cast("double"), step, S.convention())
    return t.select("trade_id", lot.cast("double").alias("lot"))


# Fixed values of the stand-in: first day and days to maturity of its one bond.
PULL_START, PULL_DAYS = "1995-01-01", 3650


@register("q_pull_to_par", with_ctes(
    "select trade_id, 100.0 + (cast(price as double) / 10 - 100) * least(greatest(1 - datediff('day', date '1995-01-01', "
    "trade_date) / 3650, 0.0), 1.0) as pulled_price from trades", "trades"))
def q_pull_to_par(spark, d):
    """Price converging to par as maturity approaches."""
    t = S.trades(spark, d)
    elapsed = F.datediff("trade_date", F.to_date(F.lit(PULL_START)))
    return t.select("trade_id", FN.pull_to_par(F.col("price").cast("double") / 10, elapsed, F.lit(PULL_DAYS)).alias("pulled_price"))


@register("q_payment_schedule", with_ctes("select * from schedule", extra=_SCHED))
def q_payment_schedule(spark, d):
    """Evenly spaced coupon dates per instrument."""
    return schedule(spark, d)


@register("q_accrued", with_ctes(
    "select t.trade_id, t.trade_date, s.pay_date as last_coupon_date, round(cast(t.quantity as double) * 100 * "
    "(2.5 + cast(substr(t.isin, 7, 10) as int) % 5) / 100 * datediff('day', s.pay_date, t.trade_date) / 365, 2) as accrued "
    "from trades t asof left join schedule s on t.isin = s.isin and t.trade_date >= s.pay_date", "trades", extra=_SCHED))
def q_accrued(spark, d):
    """ACT/365 accrual since the latest coupon on or before the trade."""
    t = S.trades(spark, d).select("trade_id", "trade_date", "isin", "quantity")
    return accrued(spark, d, t).select("trade_id", "trade_date", "last_coupon_date", "accrued")
