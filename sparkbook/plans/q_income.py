"""Income, redemption and sampling top-up queries over the position book."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkbook.functions import finance as FN
from sparkbook.operators import book as B
from sparkbook.operators import calendar as cal
from sparkbook.operators import sampling as SM
from sparkbook.operators.positions import position_book
from sparkbook.plans import standins as S
from sparkbook.plans.q_book import _ACCRUED, _SCHED, accrued, brand_no, is_bond, payments_per_year, schedule
from sparkbook.plans.q_positions import _PRICES_FILLED, BOOK_KEYS, book_sql, prices_filled
from sparkbook.plans.registry import register


_NO = "cast(substr({c}, 7, 10) as int)"
_REDEEM = {
    **_PRICES_FILLED,
    **_SCHED,
    "matures": "select distinct p_brand as isin, cast(date '2000-06-15' + to_days(cast(" + _NO.format(c="p_brand") + " * 30 as integer)) as date) "
               "as maturity_date from part",
    "leaves": "select matures.isin, date_key as redemption_date from matures asof join (select date_key from dates where is_trading_day) "
              "on maturity_date >= date_key where maturity_date <= (select max(date_key) from dates)",
    "paid_out": "select b.account_id, b.isin, redemption_date, closing_quantity as quantity, case when " + _NO.format(c="b.isin") + " % 2 = 0 then 100.0 "
                "else cast(price as double) end as price from book b join leaves on b.isin = leaves.isin and business_date = redemption_date "
                "left join prices_filled f on f.isin = b.isin and f.business_date = redemption_date where closing_quantity > 0",
    "dirty": "select p.*, pay_date from paid_out p asof left join schedule s on p.isin = s.isin and redemption_date >= pay_date",
}


@register("q_redemptions", book_sql(
    "select account_id, isin, redemption_date, quantity, price, round(quantity * price / (case when " + _NO.format(c="isin") + " % 2 = 0 then 100 else 1 end), 2) "
    "as gross, case when " + _NO.format(c="isin") + " % 2 = 0 then coalesce(" + _ACCRUED.format(q="quantity", i="isin", p="pay_date", t="redemption_date")
    + ", 0) else 0.0 end as accrued, 'REDEMPTION' as trade_type from dirty", "prices", extra=_REDEEM))
def q_redemptions(spark, d):
    """Holdings sold on the last session on or before maturity: bonds at
    par with accrued interest, others at the final fixing."""
    bk = S.book(spark, d)
    brands = S.table(spark, d, "part").select(F.col("p_brand").alias("isin")).distinct()
    due = brands.select("isin", F.date_add(F.to_date(F.lit("2000-06-15")), brand_no() * 30).alias("calendar_date"))
    due = due.join(F.broadcast(cal.roll_map(bk.calendar)), "calendar_date").select("isin", F.col("preceding_date").alias("business_date"))
    held = position_book(bk.movements, bk.dates, BOOK_KEYS, daily=True).filter("closing_quantity > 0")
    x = held.join(due, ["isin", "business_date"]).join(prices_filled(bk).select("isin", "business_date", "price"), ["isin", "business_date"], "left")
    x = x.withColumn("price", F.when(is_bond(), F.lit(100.0)).otherwise(F.col("price").cast("double")))
    x = accrued(spark, d, x.withColumnsRenamed({"business_date": "trade_date", "closing_quantity": "quantity"}))
    return x.select("account_id", "isin", F.col("trade_date").alias("redemption_date"), "quantity", "price",
                    FN.gross(F.col("quantity"), F.col("price"), S.convention()).alias("gross"),
                    F.when(is_bond(), F.coalesce("accrued", F.lit(0.0))).otherwise(0.0).alias("accrued"), F.lit("REDEMPTION").alias("trade_type"))


# Fixed value: sessions between the ex date and the payment of a dividend.
PAY_LAG = 10
_INCOME = {
    **_SCHED,
    "sessions": "select date_key, row_number() over (order by date_key) as nth from dates where is_trading_day",
    "due": "select s.isin, s.pay_date, n.date_key as due_date, n.nth from schedule s asof join sessions n on s.pay_date <= n.date_key where s.pay_date >= (select min(date_key) from sessions)",
    "entitled": "select b.account_id, b.isin, due_date, nth, closing_quantity as q, " + _NO.format(c="b.isin") + " as no, [1, 2, 4, 12][" + _NO.format(c="b.isin")
                + " % 4 + 1] as n from book b join due on b.isin = due.isin and business_date = due_date where closing_quantity > 0",
}


def dividend_per_share(c="isin"):
    """Stand-in: an amount per share and payment, declared by brand."""
    return (F.lit(5) + brand_no(c) % 7) / F.lit(20.0)


@register("q_income_events", book_sql(
    "select account_id, isin, 'COUPON' as event_type, due_date as ex_date, due_date as pay_date, cast(round(q * cast((2.5 + no % 5) / n as decimal(12,6)) "
    "* 0.01, 2) as double) as amount from entitled where no % 2 = 0 union all select account_id, isin, 'DIVIDEND', due_date, date_key, "
    "round(q * ((5 + no % 7) / 20.0), 2) from entitled e join sessions s on s.nth = e.nth + 10 where no % 2 = 1", extra=_INCOME))
def q_income_events(spark, d):
    """Coupons of bonds and dividends of shares on positions held at the
    due session (payment date rolled forward). A coupon pays the annual rate
    divided by the payments a year; a dividend pays its amount per share ten
    sessions later, and one whose payment lies beyond the calendar is dropped.
    """
    bk = S.book(spark, d)
    due = schedule(spark, d).join(F.broadcast(cal.roll_map(bk.calendar)), F.col("pay_date") == F.col("calendar_date"))
    due = due.filter("following_date is not null and preceding_date is not null").select("isin", F.col("following_date").alias("business_date"))
    held = position_book(bk.movements, bk.dates, BOOK_KEYS, daily=True).filter("closing_quantity > 0").join(due, ["isin", "business_date"])
    portion = ((F.lit(2.5) + brand_no() % 5) / payments_per_year()).cast("decimal(12,6)")
    coupons = held.filter(is_bond()).select("account_id", "isin", F.lit("COUPON").alias("event_type"), F.col("business_date").alias("ex_date"),
                                            F.col("business_date").alias("pay_date"), F.round(F.col("closing_quantity") * portion / 100, 2).cast("double").alias("amount"))
    pays = cal.session_offset(bk.calendar, PAY_LAG).filter("offset_date is not null")
    shares = held.filter(~is_bond()).join(F.broadcast(pays), F.col("business_date") == F.col("calendar_date"))
    dividends = shares.select("account_id", "isin", F.lit("DIVIDEND").alias("event_type"), F.col("business_date").alias("ex_date"),
                              F.col("offset_date").alias("pay_date"), F.round(F.col("closing_quantity") * dividend_per_share(), 2).alias("amount"))
    return coupons.unionByName(dividends)


_EX = {
    **_PRICES_FILLED,
    **_INCOME,
    "exes": "select distinct isin, due_date, (5 + " + _NO.format(c="isin") + " % 7) / 20.0 as a from due where " + _NO.format(c="isin") + " % 2 = 1 and due_date is not null",
    "series": "select isin, business_date, cast(price as double) as price from prices_filled where price is not null",
    "floors": "select e.isin, e.due_date, any_value(e.a) as a, min(s.price) as m, row_number() over (partition by e.isin order by e.due_date) as k "
              "from exes e join series s on s.isin = e.isin and s.business_date >= e.due_date group by e.isin, e.due_date",
    "steps_of": "select isin, list(struct_pack(k := k, due := due_date, a := a, m := m) order by k) as xs from floors group by isin",
    "shifts": "select isin, x.due as due, d from (select isin, unnest(xs) as x, unnest(list_reduce(list_prepend([0.0::double], list_transform(xs, lambda x: [x.a, x.m])), "
              "lambda acc, x: list_append(acc, greatest(acc[-1], least(acc[-1] + x[1], x[2] - 0.01))))[2:]) as d from steps_of)",
}


@register("q_ex_date_adjust", book_sql(
    "select s.isin, s.business_date, s.price, round(s.price - coalesce(h.d, 0), 6) as adjusted_price from series s asof left join shifts h "
    "on h.isin = s.isin and s.business_date >= h.due where " + _NO.format(c="s.isin") + " % 2 = 1", "prices", extra=_EX))
def q_ex_date_adjust(spark, d):
    """A share's price series drops by each dividend on its ex date and
    stays down; no drop takes a later price below one cent."""
    bk = S.book(spark, d)
    due = schedule(spark, d).filter(~is_bond()).join(F.broadcast(cal.roll_map(bk.calendar)), F.col("pay_date") == F.col("calendar_date"))
    due = due.filter("following_date is not null and preceding_date is not null")
    due = due.select("isin", F.col("following_date").alias("ex_date"), dividend_per_share().alias("amount")).distinct()
    series = prices_filled(bk).filter(~is_bond()).select("isin", "business_date", F.col("price").cast("double").alias("price")).filter("price is not null")
    return B.ex_date_adjust(series, due, "isin", "business_date", "price").withColumn("adjusted_price", F.round("adjusted_price", 6))


_STRAT = ("select p_partkey, p_brand, p_type from (select *, row_number() over (partition by p_type order by "
          "-ln((cast(('0x' || substr(sha256(cast(p_partkey as varchar)), 1, 16))::UBIGINT as double) + 0.5) / "
          "18446744073709551616.0) / p_retailprice, p_partkey) as rk from part) x where rk <= 5")


@register("q_topup", "with sample as (" + _STRAT + "), firsts as (select p_brand, min(p_partkey) as p_partkey from part "
          "where p_brand not in (select p_brand from sample) group by p_brand), extra as (select f.p_partkey, f.p_brand, "
          "p.p_type, row_number() over (order by f.p_partkey) as rn from firsts f join part p on p.p_partkey = f.p_partkey) "
          "select * from sample union all select p_partkey, p_brand, p_type from extra "
          "where rn <= 40 - (select count(*) from sample)")
def q_topup(spark, d):
    """Stratified sample topped up with unseen brands, in id order, to 40."""
    p = S.table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    sample = SM.stratified_sample(p, "p_type", "p_partkey", "p_retailprice", 5).select("p_partkey", "p_brand", "p_type")
    return SM.top_up(sample, p.select("p_partkey", "p_brand", "p_type"), "p_brand", "p_partkey", 40)


# Fixed values of the stand-in: target shares of value by risk profile and class.
TILT_TARGETS = [("defensive", "STANDARD", 0.5), ("defensive", "PROMO", 0.2), ("defensive", "ECONOMY", 0.01),
                ("balanced", "STANDARD", 0.3), ("balanced", "PROMO", 0.3), ("balanced", "ECONOMY", 0.2), ("growth", "ECONOMY", 0.6)]
TILT_SLICE = 20.0


@register("q_profile_tilt", "with p as (select split_part(p_type, ' ', 1) as class, p_size from part), c as (select class, count(*) / (select count(*) from p) as share, "
          "median(p_size) as step from p group by class), t(profile, class, target) as (values " + ", ".join(f"('{a}', '{b}', {c}::double)" for a, b, c in TILT_TARGETS)
          + ") select profile, class, round(target / (share * greatest(1.0, step / 20.0)), 9) as multiplier from t join c using (class)")
def q_profile_tilt(spark, d):
    """How strongly a profile's draw favours each class of instruments."""
    p = S.table(spark, d, "part").select(F.split("p_type", " ")[0].alias("class_of"), "p_size")
    targets = spark.createDataFrame(TILT_TARGETS, "profile string, class string, target double")
    return B.profile_tilt(p, targets, "class_of", "p_size", TILT_SLICE).withColumn("multiplier", F.round("multiplier", 9))
