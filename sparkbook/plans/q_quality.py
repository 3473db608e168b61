"""Data-quality queries: one per check factory on the clean stand-ins, and
one per defect injector (the matching check must return rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkbook.operators import defects as DF
from sparkbook.operators import quality as Q
from sparkbook.operators.positions import held_days, position_book
from sparkbook.operators.recon import reconcile
from sparkbook.plans import standins as S
from sparkbook.plans.oracle_sql import with_ctes
from sparkbook.plans.q_positions import BOOK_KEYS, book_sql
from sparkbook.plans.q_scalars import instr, isql
from sparkbook.plans.q_temporal import REG_KEYS, reg_facts, register_versions, statement
from sparkbook.plans.registry import QUERIES, register
from sparkbook.sources.instruments import delta_rules


def sql_victim(table: str, id_col: str, cols: list[str]) -> str:
    order = ", ".join(f"{c} nulls first" for c in cols)
    return (f"select {', '.join(cols)} from {table} order by "
            f"('0x' || substr(sha256(cast({id_col} as varchar)), 1, 16))::UBIGINT, {order} limit 1")


TRADE_COLS = ["trade_id", "trade_date", "account_id", "isin", "trading_venue_mic", "trade_side", "quantity", "price",
              "gross_consideration"]
EVENT_COLS = ["account_id", "event_id", "event_date", "event_type", "amount"]


# ---- checks on the clean stand-ins -------------------------------------------------

@register("q_dq_not_null", with_ctes("select id from dirty_dates where raw is null", "dirty_dates"))
def q_dq_not_null(spark, d):
    """Required values that are null."""
    return Q.not_null(S.dirty_dates(spark, d), "raw").select("id")


@register("q_dup_keys", "select l_orderkey, l_linenumber, count(*) as n_records from lineitem "
          "group by l_orderkey, l_linenumber having count(*) > 1")
def q_dup_keys(spark, d):
    """Composite keys occurring more than once."""
    return Q.unique(S.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("q_dq_accepted", "select o_orderkey, o_orderpriority from orders "
          "where o_orderpriority is not null and o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM')")
def q_dq_accepted(spark, d):
    """Values outside an accepted set (nulls pass)."""
    o = S.table(spark, d, "orders")
    return Q.accepted_values(o, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select("o_orderkey", "o_orderpriority")


@register("q_fk", with_ctes(
    "select fx_trade_id, buy_currency from fx_tickets f where buy_currency is not null and not exists "
    "(select 1 from rates r where r.currency = f.buy_currency)", "fx_tickets", "rates"))
def q_fk(spark, d):
    """Tickets whose buy currency has no rate series."""
    v = Q.relationships(S.fx_tickets(spark, d), S.rates(spark, d), {"buy_currency": "currency"})
    return v.select("fx_trade_id", "buy_currency")


@register("q_fk_composite", with_ctes(
    "select distinct f.isin, f.trading_venue_mic from reg_facts f where not exists (select 1 from register_versions v "
    "where v.isin = f.isin and v.trading_venue_mic = f.trading_venue_mic)", "register_versions",
    extra={"reg_facts": "select l_partkey as isin, l_suppkey % 4 as trading_venue_mic from lineitem"}))
def q_fk_composite(spark, d):
    """Composite (instrument, venue) keys of facts missing from the register."""
    v = Q.relationships(reg_facts(spark, d), register_versions(spark, d), REG_KEYS)
    return v.select(*REG_KEYS).distinct()


@register("q_dq_expression", with_ctes(
    "select trade_id, quantity, gross_consideration from trades "
    "where not coalesce(gross_consideration <= price * quantity, false)", "trades"))
def q_dq_expression(spark, d):
    """Rows where a whole-row expression is not true."""
    t = S.trades(spark, d)
    return Q.expression_is_true(t, "gross_consideration <= price * quantity").select("trade_id", "quantity",
                                                                                    "gross_consideration")


@register("q_dq_range", "select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity > 45")
def q_dq_range(spark, d):
    """Values above an accepted maximum (warn severity)."""
    li = S.table(spark, d, "lineitem")
    return Q.accepted_range(li, "l_quantity", max_value=45).select("l_orderkey", "l_linenumber", "l_quantity")


@register("q_orphans", with_ctes(
    "select distinct x.isin, x.trading_venue_mic from register_deltas x where not exists (select 1 from register_base b "
    "where b.isin = x.isin and b.trading_venue_mic = x.trading_venue_mic)", "register_deltas", "register_base"))
def q_orphans(spark, d):
    """Delta keys (children) without a base record (parent pair)."""
    o = Q.relationships(S.register_deltas(spark, d), S.register_base(spark, d), REG_KEYS)
    return o.select(*REG_KEYS).distinct()


_STRING_COLS = ["name", "brand", "cfi_code", "nominal_raw", "raw_name", "raw_flag", "isin_raw", "lei_raw", "mic_raw"]


@register("q_empty_strings", isql(" union all ".join(
    f"select '{c}' as column_name, cast(count_if({c} = '') as bigint) as empty_values from instr" for c in _STRING_COLS)))
def q_empty_strings(spark, d):
    """D21: '' count in every string column, one pass over the table."""
    i = instr(spark, d)
    cols = [c for c, t in i.dtypes if t == "string"]
    wide = i.agg(*[F.count_if(F.col(c) == "").cast("bigint").alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "empty_values")


_FEED = {
    "feed": "select version_source as record_type, isin, trading_venue_mic, record_sequence, source_file, effective_date as publication_date, "
            "case when record_sequence % 17 = 0 then null when record_sequence % 13 = 0 then cast(effective_date + interval 1 day as date) else effective_date end as reporting_date, "
            "case when version_source = 'CANC' and record_sequence % 2 = 0 then null else instrument_full_name end as full_name, "
            "case when record_sequence % 7 = 0 then '' when version_source <> 'CANC' then 'ESVUFR' end as cfi_code, "
            "case when record_sequence % 11 <> 0 and version_source <> 'CANC' then 'EUR' end as notional_ccy, "
            "case when record_sequence % 5 <> 0 and version_source = 'TERMNTD' then '2001-01-01' end as termination_dt from register_deltas",
    "kids": "select isin, trading_venue_mic, case when record_sequence % 19 = 0 then record_sequence + 1 else record_sequence end as record_sequence, source_file, "
            "'ISIN' as t, case when record_sequence % 23 = 0 then null when record_sequence % 29 = 0 then 'X' else 'DE0001102333' end as id from feed where record_sequence % 2 = 0",
}


def delta_feed(spark, d):
    """Stand-in feed and children with a fault of each kind in some records."""
    x = S.register_deltas(spark, d)
    n, kind = F.col("record_sequence"), F.col("version_source")
    feed = x.select(
        kind.alias("record_type"), "isin", "trading_venue_mic", n, "source_file", F.col("effective_date").alias("publication_date"),
        F.when(n % 17 == 0, F.lit(None)).when(n % 13 == 0, F.date_add("effective_date", 1)).otherwise(F.col("effective_date")).alias("reporting_date"),
        F.when((kind == "CANC") & (n % 2 == 0), F.lit(None)).otherwise(F.col("instrument_full_name")).alias("full_name"),
        F.when(n % 7 == 0, "").when(kind != "CANC", "ESVUFR").alias("cfi_code"), F.when((n % 11 != 0) & (kind != "CANC"), "EUR").alias("notional_ccy"),
        F.when((n % 5 != 0) & (kind == "TERMNTD"), "2001-01-01").alias("termination_dt"))
    kids = feed.filter(n % 2 == 0).select(
        F.col("isin").alias("parent_isin"), F.col("trading_venue_mic").alias("parent_mic"), F.when(n % 19 == 0, n + 1).otherwise(n).alias("record_sequence"),
        "source_file", F.lit("ISIN").alias("underlying_type"),
        F.when(n % 23 == 0, F.lit(None)).when(n % 29 == 0, "X").otherwise("DE0001102333").alias("underlying_id"), F.lit(None).cast("string").alias("underlying_name"))
    return feed, kids


def _rule(name, severity, where, table="feed"):
    return f"select '{name}' as rule, '{severity}' as severity, isin, trading_venue_mic, source_file from {table} where {where}"


@register("q_delta_rules", with_ctes(" union all ".join([
    _rule("unknown_record_type", "fatal", "record_type not in ('NEW', 'MODFD', 'TERMNTD', 'CANC')"),
    _rule("missing_key", "fatal", "isin is null or trading_venue_mic is null"),
    _rule("no_header_date", "fatal", "reporting_date is null"),
    _rule("header_date_differs", "fatal", "reporting_date <> publication_date"),
    _rule("canc_with_payload", "fatal", "record_type = 'CANC' and coalesce(full_name, cfi_code, notional_ccy, termination_dt) is not null"),
    _rule("no_cfi_code", "warn", "record_type <> 'CANC' and coalesce(cfi_code, '') = ''"),
    _rule("no_notional_ccy", "warn", "record_type <> 'CANC' and notional_ccy is null"),
    _rule("undated_termination", "warn", "record_type = 'TERMNTD' and termination_dt is null"),
    _rule("orphan_underlying", "fatal", "not exists (select 1 from feed f where f.isin = k.isin and f.trading_venue_mic = k.trading_venue_mic and "
          "f.record_sequence = k.record_sequence and f.source_file = k.source_file)", "kids k"),
    _rule("bad_underlying_id", "fatal", "id = 'X'", "kids"),
    _rule("unidentified_underlying", "warn", "id is null", "kids"),
]), "register_deltas", extra=_FEED))
def q_delta_rules(spark, d):
    """Structural rules on the delta feed and its underlyings."""
    return delta_rules(*delta_feed(spark, d))


# ---- defect injectors: the matching check must fire -----------------------------------

# A defect is shown by a check that finds nothing in the clean input and something in the injected one.
# name -> (check on the clean input); tests hold both sides.
CLEAN = {}


def clean(name):
    def deco(fn):
        CLEAN[name] = fn
        return fn

    return deco


_ONE_TRADE = {"one_trade": f"select {', '.join(TRADE_COLS)} from (select *, row_number() over (partition by trade_id order by "
                           + ", ".join(f"{c} nulls first" for c in TRADE_COLS) + ") as rn from trades) where rn = 1"}


def one_trade(spark, d):
    """Trades with a total id: of rows that share an id the least stays."""
    t = S.trades(spark, d)
    return t.groupBy("trade_id").agg(F.min(F.struct(*TRADE_COLS)).alias("t")).select("t.*")


@clean("q_inject_duplicate_trade_id")
def _(spark, d):
    return Q.unique(one_trade(spark, d), "trade_id")


@register("q_inject_duplicate_trade_id", with_ctes(
    "select trade_id, count(*) as n_records from (select * from one_trade union all (" + sql_victim("one_trade", "trade_id", TRADE_COLS)
    + ")) x group by trade_id having count(*) > 1", "trades", extra=_ONE_TRADE))
def q_inject_duplicate_trade_id(spark, d):
    """2.10 duplicate_trade_id -> unique(trade_id)."""
    return Q.unique(DF.duplicate_row(one_trade(spark, d), "trade_id"), "trade_id")


def _replace_sql(table, id_col, cols, changes: dict[str, str]):
    v = sql_victim(table, id_col, cols)
    sel = ", ".join(changes.get(c, c) + f" as {c}" for c in cols)
    return (f"select * from (select {', '.join(cols)} from {table} except all ({v})) a "
            f"union all select {sel} from ({v}) b")


@register("q_inject_orphan_instrument", with_ctes(
    "select trade_id, isin from injected i where isin is not null and not exists "
    "(select 1 from part p where p.p_brand = i.isin)", "trades",
    extra={"injected": _replace_sql("trades", "trade_id", TRADE_COLS, {"isin": "'XX0000000000'"})}))
def q_inject_orphan_instrument(spark, d):
    """2.10 orphan_instrument -> relationships(isin -> instruments)."""
    t = DF.replace_in_row(S.trades(spark, d), "trade_id", {"isin": F.lit(DF.ORPHAN_ISIN)})
    brands = S.table(spark, d, "part").select(F.col("p_brand").alias("isin"))
    return Q.relationships(t, brands, "isin").select("trade_id", "isin")


@register("q_inject_bad_enum", with_ctes(
    "select trade_id, trade_side from injected where trade_side not in ('BUY', 'SELL')", "trades",
    extra={"injected": _replace_sql("trades", "trade_id", TRADE_COLS, {"trade_side": "'B'"})}))
def q_inject_bad_enum(spark, d):
    """2.10 bad_enum -> accepted_values(trade_side)."""
    t = DF.replace_in_row(S.trades(spark, d), "trade_id", {"trade_side": F.lit("B")})
    return Q.accepted_values(t, "trade_side", ["BUY", "SELL"]).select("trade_id", "trade_side")


@register("q_inject_null_required", with_ctes(
    "select trade_id from injected where trading_venue_mic is null", "trades",
    extra={"injected": _replace_sql("trades", "trade_id", TRADE_COLS, {"trading_venue_mic": "cast(null as varchar)"})}))
def q_inject_null_required(spark, d):
    """2.10 null_required -> not_null(trading_venue_mic)."""
    t = DF.replace_in_row(S.trades(spark, d), "trade_id", {"trading_venue_mic": F.lit(None).cast("string")})
    return Q.not_null(t, "trading_venue_mic").select("trade_id")


@register("q_inject_duplicate_event_id", with_ctes(
    "select event_id, count(*) as n_records from (select * from cash_events union all ("
    + sql_victim("cash_events", "event_id", EVENT_COLS) + ")) x group by event_id having count(*) > 1", "cash_events"))
def q_inject_duplicate_event_id(spark, d):
    """2.10 duplicate_event_id -> unique(event_id)."""
    return Q.unique(DF.duplicate_row(S.cash_events(spark, d), "event_id"), "event_id")


@register("q_inject_orphan_cash_event", with_ctes(
    "select event_id, account_id from injected i where account_id is not null and not exists "
    "(select 1 from customer c where c.c_custkey = i.account_id)", "cash_events",
    extra={"injected": _replace_sql("cash_events", "event_id", EVENT_COLS, {"account_id": "cast(99999 as bigint)"})}))
def q_inject_orphan_cash_event(spark, d):
    """2.10 orphan_cash_event -> relationships(account_id -> accounts)."""
    e = DF.replace_in_row(S.cash_events(spark, d), "event_id", {"account_id": F.lit(DF.ORPHAN_ACCOUNT).cast("bigint")})
    accounts = S.table(spark, d, "customer").select("c_custkey")
    return Q.relationships(e, accounts, {"account_id": "c_custkey"}).select("event_id", "account_id")


_ASSIGN_COLS = ["client_id", "rm_id", "assigned_date", "tie"]
_SINCE = {"since": "select o_custkey as client_id, cast(min(o_orderdate) as date) as client_since from orders group by o_custkey"}


@register("q_inject_assignment_before_onboarding", with_ctes(
    "select a.client_id, a.assigned_date, s.client_since from injected a join since s using (client_id) "
    "where not coalesce(a.assigned_date >= s.client_since, false)", "assignments",
    extra={**_SINCE, "injected": _replace_sql(
        "assignments", "tie", _ASSIGN_COLS,
        {"assigned_date": "cast((select min(calendar_date) from (select cast(min(l_shipdate) as date) as calendar_date "
                          "from lineitem)) - interval 3650 day as date)"})}))
def q_inject_assignment_before_onboarding(spark, d):
    """2.10 assignment_before_onboarding -> expression assigned_date >= client_since."""
    first_session = S.calendar(spark, d).agg(F.min("calendar_date")).scalar()
    a = DF.replace_in_row(S.assignments(spark, d), "tie", {"assigned_date": F.date_sub(first_session, 3650)})
    o = S.table(spark, d, "orders")
    since = o.groupBy(F.col("o_custkey").alias("client_id")).agg(F.min("o_orderdate").cast("date").alias("client_since"))
    j = a.join(since, "client_id")
    return Q.expression_is_true(j, "assigned_date >= client_since").select("client_id", "assigned_date", "client_since")


_PRICE_COLS = ["isin", "business_date", "price", "price_currency", "price_source", "price_convention"]


@register("q_inject_missing_price", book_sql(
    "select h.isin, h.business_date from (select distinct isin, business_date from book) h "
    "where exists (select 1 from prices p where p.isin = h.isin and p.business_date = h.business_date) "
    "and not exists (select 1 from injected p where p.isin = h.isin and p.business_date = h.business_date)",
    "prices", extra={
        "keyedp": "select isin || cast(business_date as varchar) as pid, * from prices p where exists "
                  "(select 1 from book b where b.isin = p.isin and b.business_date = p.business_date)",
        "vp": sql_victim("keyedp", "pid", ["pid", *_PRICE_COLS]),
        "injected": f"select {', '.join(_PRICE_COLS)} from prices except all select {', '.join(_PRICE_COLS)} from vp",
    }))
def q_inject_missing_price(spark, d):
    """2.10 missing_price -> a held day whose print was removed."""
    bk = S.book(spark, d)
    p = bk.prices
    held = held_days(bk.movements, bk.dates)
    had = held.join(p, ["isin", "business_date"], "left_semi")
    pool = p.join(held, ["isin", "business_date"], "left_semi")
    keyed = pool.withColumn("pid", F.concat("isin", F.col("business_date").cast("string")))
    v = DF.victim(keyed.select("pid", *_PRICE_COLS), "pid").drop("pid")
    injected = DF.without_one(p, v.select(*p.columns))
    return had.join(injected, ["isin", "business_date"], "left_anti").select("isin", "business_date")


@register("q_inject_snapshot_break", book_sql(
    "select coalesce(b.account_id, s.account_id) as account_id, coalesce(b.isin, s.isin) as isin, "
    "coalesce(b.business_date, s.snapshot_date) as as_of_date, coalesce(b.closing_quantity, 0) as derived_quantity, "
    "coalesce(s.quantity, 0) as published_quantity from (select * from book where is_last_trading_day_of_month) b "
    "full outer join injected s on b.account_id = s.account_id and b.isin = s.isin and b.business_date = s.snapshot_date "
    "where coalesce(b.closing_quantity, 0) <> coalesce(s.quantity, 0)",
    extra={
        "open_statement": """select mv.account_id, mv.isin, m.date_key as snapshot_date, cast(sum(mv.quantity_delta) as bigint) as quantity
          from movements mv join dates c on c.date_key = mv.movement_date and c.is_trading_day
          join dates m on m.is_last_trading_day_of_month and mv.movement_date <= m.date_key
          group by mv.account_id, mv.isin, m.date_key having sum(mv.quantity_delta) <> 0""",
        "keyed": "select *, cast(account_id as varchar) || isin || cast(snapshot_date as varchar) as sid from open_statement",
        "v": sql_victim("keyed", "sid", ["sid", "account_id", "isin", "snapshot_date", "quantity"]),
        "injected": "select account_id, isin, snapshot_date, quantity from keyed where sid <> (select sid from v) "
                    "union all select account_id, isin, snapshot_date, quantity * 2 + 1 from v",
    }))
def q_inject_snapshot_break(spark, d):
    """2.10 snapshot_break -> the book/statement reconciliation breaks."""
    bk = S.book(spark, d)
    st = statement(bk, open_days_only=True)
    keyed = st.withColumn("sid", F.concat(F.col("account_id").cast("string"), "isin", F.col("snapshot_date").cast("string")))
    broken = DF.replace_in_row(keyed, "sid", {"quantity": F.col("quantity") * 2 + 1}).drop("sid")
    book = position_book(bk.movements, bk.dates, BOOK_KEYS).filter("is_last_trading_day_of_month")
    return reconcile(book.withColumnRenamed("business_date", "as_of_date"), broken, [*BOOK_KEYS, "as_of_date"],
                     "closing_quantity", "quantity", right_keys=[*BOOK_KEYS, "snapshot_date"])


def long_only(bk):
    """A book that never falls below zero: what comes in stays."""
    return bk.movements.filter("quantity_delta > 0")


@clean("q_inject_broken_invariant")
def _(spark, d):
    bk = S.book(spark, d)
    return position_book(long_only(bk), bk.dates, BOOK_KEYS).filter("closing_quantity < 0")


@register("q_inject_broken_invariant", with_ctes(
    "select account_id, isin, d as business_date, -final as closing_quantity from v",
    "movements", "calendar", "dates", extra={
        "nets": "select account_id, isin, movement_date, sum(quantity_delta) as q from movements group by account_id, isin, movement_date having sum(quantity_delta) > 0",
        "final": "select account_id, isin, cast(sum(case when is_trading_day then q else 0 end) as bigint) as final, (select max(date_key) from dates where is_trading_day) as d "
                 "from nets join calendar on movement_date = calendar_date where movement_date <= (select max(date_key) from dates where is_trading_day) "
                 "group by account_id, isin",
        "v": "select * from final where final > 0 order by ('0x' || substr(sha256(cast(account_id as varchar) || '|' || isin), 1, 16))::UBIGINT, "
             "account_id, isin limit 1",
    }))
def q_inject_broken_invariant(spark, d):
    """2.10 broken_invariant -> an oversell drives a derived position negative."""
    bk = S.book(spark, d)
    last_day = bk.dates.filter("is_trading_day").agg(F.max("date_key")).scalar()
    final = position_book(long_only(bk), bk.dates, BOOK_KEYS).filter(F.col("business_date") == last_day)
    bad = DF.oversell(long_only(bk), final, BOOK_KEYS, last_day)
    return position_book(bad, bk.dates, BOOK_KEYS).filter("closing_quantity < 0").select(*BOOK_KEYS, "business_date", "closing_quantity")


def _trades_check(name, check):
    clean(name)(lambda spark, d: check(S.trades(spark, d), spark, d))


_trades_check("q_inject_orphan_instrument", lambda t, s, d: Q.relationships(t, S.table(s, d, "part").select(F.col("p_brand").alias("isin")), "isin"))
_trades_check("q_inject_bad_enum", lambda t, s, d: Q.accepted_values(t, "trade_side", ["BUY", "SELL"]))
_trades_check("q_inject_null_required", lambda t, s, d: Q.not_null(t, "trading_venue_mic"))


@clean("q_inject_duplicate_event_id")
def _(spark, d):
    return Q.unique(S.cash_events(spark, d), "event_id")


@clean("q_inject_orphan_cash_event")
def _(spark, d):
    return Q.relationships(S.cash_events(spark, d), S.table(spark, d, "customer").select("c_custkey"), {"account_id": "c_custkey"})


@clean("q_inject_assignment_before_onboarding")
def _(spark, d):
    a = S.assignments(spark, d)
    since = S.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("client_id")).agg(F.min("o_orderdate").cast("date").alias("client_since"))
    return Q.expression_is_true(a.join(since, "client_id"), "assigned_date >= client_since")


@clean("q_inject_missing_price")
def _(spark, d):
    bk = S.book(spark, d)
    held = held_days(bk.movements, bk.dates)
    had = held.join(bk.prices, ["isin", "business_date"], "left_semi")
    return had.join(bk.prices, ["isin", "business_date"], "left_anti")


@clean("q_inject_snapshot_break")
def _(spark, d):
    return QUERIES["q_reconcile_range"].build(spark, d)
