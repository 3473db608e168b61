"""The whole book as a pipeline: raw lines, 17 further staging tables, 2 intermediate
tables, 4 dimensions and 7 facts, each with its rules, and checks between tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from sparkbook.operators import book as B
from sparkbook.operators import calendar as cal
from sparkbook.operators import positions as pos
from sparkbook.operators import quality as Q
from sparkbook.operators import rules as R
from sparkbook.operators import temporal as T
from sparkbook.operators.joins import resolve_version
from sparkbook.operators.layers import Layer, run_pipeline
from sparkbook.operators.recon import positions_by_blocks, reconcile
from sparkbook.operators.sets import latest_per_key
from sparkbook.plans import standins as S
from sparkbook.plans.oracle_sql import with_ctes
from sparkbook.plans.q_book import _CONVERT, _RBD, priced, ticket_days
from sparkbook.plans.q_marts import _CASH_FACTS, _LATEST, _STATEMENT
from sparkbook.plans.q_positions import _BOOK_SQL_CTES, _VALUED, BOOK_KEYS
from sparkbook.plans.registry import register

KEYS = ["isin", "trading_venue_mic"]
CURRENCY_CODE = list(range(25))


def build_raw(spark, d):
    return lambda t: {"stg_lines": S.book_lines(spark, d)}


def build_staging(spark, d):
    def renamed(table, **cols):
        return S.table(spark, d, table).select(*[F.col(c).alias(n) for n, c in cols.items()])

    return lambda t: {
        "stg_trades": S.trades_of(t["stg_lines"]),
        "stg_transfers": S.transfers_of(t["stg_lines"]),
        "stg_prices": S.prices_of(t["stg_lines"]),
        "stg_calendar": S.bounded_calendar(t["stg_lines"].select("ship_date"), "ship_date"),
        "stg_cash_events": S.cash_events(spark, d),
        "stg_fx_trades": S.fx_tickets(spark, d),
        "stg_rates": S.rates(spark, d),
        "stg_assignments": S.assignments(spark, d),
        "stg_register": S.register_base(spark, d),
        "stg_register_deltas": S.register_deltas(spark, d),
        "stg_instrument_events": S.brand_register_events(spark, d),
        "stg_clients": renamed("customer", client_id="c_custkey", client_name="c_name", country_id="c_nationkey", client_type="c_mktsegment"),
        "stg_entities": renamed("supplier", entity_id="s_suppkey", entity_name="s_name", country_id="s_nationkey"),
        "stg_countries": renamed("nation", country_id="n_nationkey", country_name="n_name", desk_id="n_regionkey"),
        "stg_desks": renamed("region", desk_id="r_regionkey", desk_name="r_name"),
        "stg_instruments": renamed("part", part_id="p_partkey", isin="p_brand", kind="p_type", size="p_size", price="p_retailprice"),
        "stg_orders": renamed("orders", order_id="o_orderkey", client_id="o_custkey", status="o_orderstatus", total="o_totalprice"),
    }


def build_intermediate(t):
    return {
        "int_register_versions": T.replay_versions(t["stg_register"], t["stg_register_deltas"], KEYS, base_date=S.REGISTER_BASE_DATE),
        "int_movements": pos.position_movements(t["stg_trades"], t["stg_transfers"]),
    }


def build_dimensions(t):
    manager = latest_per_key(t["stg_assignments"], ["client_id"], ["assigned_date", "tie"]).select("client_id", "rm_id")
    home = t["stg_countries"].join(t["stg_desks"], "desk_id").select("country_id", F.col("country_name").alias("desk_country"), "desk_name")
    clients = t["stg_clients"].join(manager, "client_id", "left")
    entity = t["stg_entities"].select(F.col("entity_id").alias("client_id"), "entity_name")
    versions = T.replay_versions(t["stg_instrument_events"], order=("effective_date", "record_sequence"))
    traded = t["int_movements"].select("isin").distinct()
    return {
        "dim_dates": cal.dim_dates(t["stg_calendar"]),
        "dim_accounts": clients.join(home, "country_id").select(F.col("client_id").alias("account_id"), "client_id", "desk_name", "desk_country", "rm_id"),
        "dim_clients": clients.join(entity, "client_id", "left").select("client_id", "client_name", "client_type", "entity_name", "rm_id"),
        "dim_instruments": versions.join(traded, "isin", "left_semi"),
    }


def build_facts(t):
    v = t["dim_instruments"]
    brand = F.concat(F.lit("Brand#"), (F.col("account_id") % 5 + 1).cast("string"), (F.col("event_id") % 5 + 1).cast("string"))
    rate = B.fx_rate(ticket_days(t["stg_fx_trades"]), t["stg_rates"])
    prices = pos.carry_forward_prices(pos.held_days(t["int_movements"], t["dim_dates"]), t["stg_prices"])
    book = pos.position_book(t["int_movements"], t["dim_dates"], BOOK_KEYS).join(prices, ["isin", "business_date"], "left")
    book = resolve_version(book, v, ["isin"], "business_date", take=("instrument_version_sk", "nominal_value_per_unit", "price_multiplier"))
    value = pos.market_value(F.col("closing_quantity"), F.col("price"), F.col("price_convention"), F.col("nominal_value_per_unit"), F.col("price_multiplier"))
    ends = t["dim_dates"].filter("is_last_trading_day_of_month").select("date_key")
    return {
        "fct_trades": resolve_version(t["stg_trades"], v, ["isin"], "trade_date"),
        "fct_transfers": resolve_version(t["stg_transfers"], v, ["isin"], "transfer_date"),
        "fct_cash_events": resolve_version(t["stg_cash_events"].withColumn("isin", brand), v, ["isin"], "event_date"),
        "fct_fx_trades": priced(B.attach_rates(t["stg_fx_trades"], rate), F.col("buy_rate"), F.col("sell_rate")),
        "fct_prices": prices,
        "fct_position_daily": book.withColumn("market_value_local", value.cast("double")),
        "fct_position_snapshots": resolve_version(positions_by_blocks(t["int_movements"], ends, BOOK_KEYS), v, ["isin"], "snapshot_date"),
    }


# ---- rules, each with the SQL that counts its violations --------------------------------

def _rows(where):
    return f"(select count(*) from {{table}} where {where})"


def req(*cols, **kw):
    return [(R.required(c, **kw), _rows(f"{c} is null")) for c in cols]


def uniq(*cols, **kw):
    cols_sql, some = ", ".join(cols), " and ".join(f"{c} is not null" for c in cols)
    return [(R.unique(cols, **kw), f"(select count(*) from (select {cols_sql} from {{table}} where {some} group by {cols_sql} having count(*) > 1))")]


def ref(col, parent, parent_col, **kw):
    return [(R.known({col: parent_col}, parent, **kw), f"(select count(*) from {{table}} where {col} is not null and {col} not in (select {parent_col} from {parent} where {parent_col} is not null))")]


def acc(col, values, **kw):
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return [(R.accepted(col, values, **kw), _rows(f"{col} not in ({listed})"))]


def true(condition, name, **kw):
    return [(R.holds(condition, name=name, **kw), _rows(f"not coalesce({condition}, false)"))]


def some(rows=1):
    return [(R.at_least(rows), f"(select case when count(*) < {rows} then 1 else 0 end from {{table}})")]


WARN = {"severity": "warn"}
RULES = {
    "stg_lines": req("line_id", "account_id", "client_id", "isin", "ship_date", "quantity") + uniq("line_id", **WARN) + acc("linestatus", ["F", "O"]) + true("quantity > 0", "quantity positive") + some(),
    "stg_trades": req("trade_id", "trade_date", "account_id", "isin", "price") + uniq("trade_id", **WARN) + acc("trade_side", ["BUY", "SELL"]) + true("gross_consideration > 0", "gross positive")
    + true("gross_consideration <= price * quantity", "gross covered by price", **WARN) + some(),
    "stg_transfers": req("transfer_id", "transfer_date", "account_id", "isin") + uniq("transfer_id", **WARN) + acc("transfer_direction", ["IN", "OUT"]) + some(),
    "stg_cash_events": req("event_id", "event_date", "account_id", "amount") + uniq("event_id") + true("amount >= 0", "amount positive", **WARN),
    "stg_fx_trades": req("fx_trade_id", "trade_date", "buy_amount") + uniq("fx_trade_id") + acc("sell_currency", CURRENCY_CODE) + acc("buy_currency", CURRENCY_CODE)
    + true("buy_currency <> sell_currency", "two currencies") + true("margin_bp >= 0", "margin not negative"),
    "stg_rates": req("currency", "rate_date", "units_per_eur") + uniq("currency", "rate_date") + true("units_per_eur > 0", "rate positive") + acc("currency", CURRENCY_CODE[1:]),
    "stg_assignments": req("client_id", "rm_id", "assigned_date") + uniq("client_id", "assigned_date", "tie") + ref("client_id", "stg_clients", "client_id"),
    "stg_prices": req("isin", "business_date", "price") + uniq("isin", "business_date") + true("price > 0", "price positive") + acc("price_source", ["simulated"]) + acc("price_convention", ["percent_of_par", "per_unit"]),
    "stg_calendar": req("calendar_date", "is_trading_day") + uniq("calendar_date") + true("not is_trading_day or dayname(calendar_date) not like 'S%'", "no weekend session") + some(365),
    "stg_register": req("isin", "trading_venue_mic", "effective_date") + uniq("isin", "trading_venue_mic") + acc("version_source", ["BASE"]),
    "stg_register_deltas": req("isin", "trading_venue_mic", "effective_date") + uniq("isin", "trading_venue_mic", "effective_date") + acc("version_source", ["NEW", "MODFD", "TERMNTD", "CANC"])
    + ref("isin", "stg_register", "isin") + true("source_file like 'delta_%'", "file name"),
    "stg_instrument_events": req("isin", "effective_date", "nominal_value_per_unit") + uniq("isin", "effective_date", "record_sequence") + true("price_multiplier > 0", "multiplier positive"),
    "stg_clients": req("client_id", "client_name", "country_id") + uniq("client_id") + ref("country_id", "stg_countries", "country_id"),
    "stg_entities": req("entity_id", "entity_name") + uniq("entity_id") + ref("country_id", "stg_countries", "country_id"),
    "stg_countries": req("country_id", "country_name") + uniq("country_id") + uniq("country_name") + ref("desk_id", "stg_desks", "desk_id") + some(25),
    "stg_desks": req("desk_id", "desk_name") + uniq("desk_id") + some(5),
    "stg_instruments": req("part_id", "isin", "price") + uniq("part_id") + true("size > 0", "size positive"),
    "stg_orders": req("order_id", "client_id") + uniq("order_id") + ref("client_id", "stg_clients", "client_id"),
    "int_register_versions": req("instrument_version_sk", "isin", "valid_from", "valid_to") + uniq("isin", "trading_venue_mic", "valid_from") + acc("version_source", ["BASE", "NEW", "MODFD", "TERMNTD"])
    + ref("isin", "stg_register", "isin"),
    "int_movements": req("account_id", "isin", "movement_date", "quantity_delta") + acc("movement_type", ["TRADE", "TRANSFER"]) + uniq("movement_type", "movement_id", **WARN) + true("quantity_delta <> 0", "moves something"),
    "dim_dates": req("date_key", "is_trading_day") + uniq("date_key") + true("not is_last_trading_day_of_month or is_trading_day", "month ends on a session") + some(365),
    "dim_accounts": req("account_id", "client_id", "desk_name", "desk_country") + req("rm_id", **WARN) + uniq("account_id") + ref("client_id", "stg_clients", "client_id"),
    "dim_clients": req("client_id", "client_name") + req("entity_name", **WARN) + uniq("client_id") + acc("client_type", ["BUILDING", "AUTOMOBILE"], **WARN),
    "dim_instruments": req("instrument_version_sk", "isin", "valid_from", "valid_to", "nominal_value_per_unit") + uniq("instrument_version_sk") + uniq("isin", "valid_from"),
    "fct_trades": req("trade_id", "instrument_version_sk") + uniq("trade_id", **WARN) + ref("instrument_version_sk", "dim_instruments", "instrument_version_sk") + ref("trade_date", "dim_dates", "date_key"),
    "fct_transfers": req("transfer_id", "instrument_version_sk") + uniq("transfer_id", **WARN) + ref("instrument_version_sk", "dim_instruments", "instrument_version_sk") + ref("transfer_date", "dim_dates", "date_key"),
    "fct_cash_events": req("event_id") + req("instrument_version_sk", **WARN) + uniq("event_id") + ref("account_id", "dim_accounts", "account_id", **WARN) + ref("event_date", "dim_dates", "date_key", **WARN),
    "fct_fx_trades": req("fx_trade_id", "reference_rate", "sell_amount") + uniq("fx_trade_id") + true("reference_rate > 0", "rate positive") + ref("account_id", "dim_accounts", "account_id") + ref("trade_date", "dim_dates", "date_key", **WARN),
    "fct_prices": req("isin", "business_date") + req("price", **WARN) + uniq("isin", "business_date") + acc("price_source", ["simulated", "carried_forward"]) + ref("business_date", "dim_dates", "date_key"),
    "fct_position_daily": req("account_id", "isin", "business_date", "closing_quantity", "instrument_version_sk") + req("price", **WARN) + uniq("account_id", "isin", "business_date")
    + true("closing_quantity >= 0", "no short position", **WARN) + ref("instrument_version_sk", "dim_instruments", "instrument_version_sk"),
    "fct_position_snapshots": req("account_id", "isin", "snapshot_date", "quantity", "instrument_version_sk") + uniq("account_id", "isin", "snapshot_date") + true("quantity <> 0", "holds something"),
}


# ---- checks between rows and tables -------------------------------------------------------

def temporal_checks(table, keys):
    def checks(t):
        v = t[table]
        return [Q.Check(f"{table}: one current version", T.current_count_violations(v, keys)), Q.Check(f"{table}: no gaps", T.timeline_gaps(v, keys)),
                Q.Check(f"{table}: no overlaps", T.timeline_overlaps(v, keys)), Q.Check(f"{table}: intervals in order", T.interval_order_violations(v))]

    return checks


def book_checks(t):
    book = t["fct_position_daily"].filter("is_last_trading_day_of_month").withColumnRenamed("business_date", "as_of_date")
    breaks = reconcile(book, t["fct_position_snapshots"], [*BOOK_KEYS, "as_of_date"], "closing_quantity", "quantity", right_keys=[*BOOK_KEYS, "snapshot_date"])
    return [Q.Check("statement agrees with book", breaks, severity="warn"), Q.Check("trades on sessions", Q.is_trading_date(t["fct_trades"], "trade_date", t["dim_dates"]), severity="warn")]


def _temporal_sql(table, keys):
    same = " and ".join(f"{k} = v.{k}" for k in keys)
    by = ", ".join(keys)
    before = f"(select {by}, valid_from, valid_to, lag(valid_to) over (partition by {by} order by valid_from, valid_to) as prev from {table})"
    assert same
    return [
        (f"{table}: one current version", "error", f"(select count(*) from (select {by} from {table} group by {by} having count_if(is_current) <> 1))"),
        (f"{table}: no gaps", "error", f"(select count(*) from {before} where valid_from - prev <> 1)"),
        (f"{table}: no overlaps", "error", f"(select count(*) from {before} where prev >= valid_from)"),
        (f"{table}: intervals in order", "error", f"(select count(*) from {table} where valid_from > valid_to)"),
    ]


_BREAKS = ("(select count(*) from (select account_id, isin, day, sum(a) - sum(b) as x from (select account_id, isin, business_date as day, closing_quantity as a, 0 as b from fct_position_daily "
           "where is_last_trading_day_of_month union all select account_id, isin, snapshot_date, 0, quantity from fct_position_snapshots) group by all having x <> 0))")
CHECKS = {
    "intermediate": _temporal_sql("int_register_versions", KEYS),
    "dimensions": _temporal_sql("dim_instruments", ["isin"]),
    "facts": [("statement agrees with book", "warn", _BREAKS),
              ("trades on sessions", "warn", "(select count(*) from fct_trades where trade_date not in (select date_key from dim_dates where is_trading_day))")],
}

LAYERS = {
    "raw": ["stg_lines"],
    "staging": [t for t in RULES if t.startswith("stg_") and t != "stg_lines"],
    "intermediate": ["int_register_versions", "int_movements"],
    "dimensions": [t for t in RULES if t.startswith("dim_")],
    "facts": [t for t in RULES if t.startswith("fct_")],
}


def book_layers(spark, d):
    """Five layers; a table is deleted once no later layer, nor its checks, reads it."""
    rules = {layer: {t: [r for r, _ in RULES[t]] for t in tables} for layer, tables in LAYERS.items()}
    stage_reads = {
        "intermediate": ["stg_register", "stg_register_deltas", "stg_trades", "stg_transfers"],
        "dimensions": ["stg_assignments", "stg_countries", "stg_desks", "stg_clients", "stg_entities", "stg_instrument_events", "stg_calendar", "int_movements"],
        "facts": ["stg_trades", "stg_transfers", "stg_cash_events", "stg_fx_trades", "stg_rates", "stg_prices", "int_movements", "dim_instruments", "dim_dates", "dim_accounts"],
    }
    return [
        Layer("raw", build_raw(spark, d), rules=rules["raw"]),
        Layer("staging", build_staging(spark, d), rules=rules["staging"], reads=["stg_lines"]),
        Layer("intermediate", build_intermediate, temporal_checks("int_register_versions", KEYS), rules["intermediate"], stage_reads["intermediate"]),
        Layer("dimensions", build_dimensions, temporal_checks("dim_instruments", ["isin"]), rules["dimensions"], stage_reads["dimensions"]),
        Layer("facts", build_facts, book_checks, rules["facts"], stage_reads["facts"]),
    ]


_VERSIONED = "left join brand_versions v on x.isin = v.isin and x.{day} between v.valid_from and v.valid_to"
_TABLES_SQL = {
    **_BOOK_SQL_CTES, **_VALUED, **_RBD, **_LATEST, **_CASH_FACTS, **_STATEMENT,
    **{f"stg_{n}": f"select * from {c}" for n, c in (
        ("lines", "lines"), ("trades", "trades"), ("transfers", "transfers"), ("prices", "prices"), ("calendar", "calendar"), ("cash_events", "cash_events"), ("fx_trades", "fx_tickets"),
        ("rates", "rates"), ("assignments", "assignments"), ("register", "register_base"), ("register_deltas", "register_deltas"), ("instrument_events", "brand_events"))},
    "stg_clients": "select c_custkey as client_id, c_name as client_name, c_nationkey as country_id, c_mktsegment as client_type from customer",
    "stg_entities": "select s_suppkey as entity_id, s_name as entity_name, s_nationkey as country_id from supplier",
    "stg_countries": "select n_nationkey as country_id, n_name as country_name, n_regionkey as desk_id from nation",
    "stg_desks": "select r_regionkey as desk_id, r_name as desk_name from region",
    "stg_instruments": "select p_partkey as part_id, p_brand as isin, p_size as size, p_retailprice as price from part",
    "stg_orders": "select o_orderkey as order_id, o_custkey as client_id from orders",
    "int_register_versions": "select * from register_versions",
    "int_movements": "select * from movements",
    "dim_dates": "select * from dates",
    "dim_accounts": "select c_custkey as account_id, c_custkey as client_id, r_name as desk_name, n_name as desk_country, rm_id from customer "
                    "join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey left join latest_rm l on l.client_id = c_custkey",
    "dim_clients": "select c_custkey as client_id, c_name as client_name, c_mktsegment as client_type, s_name as entity_name from customer left join supplier on s_suppkey = c_custkey",
    "dim_instruments": "select *, valid_to = date '9999-12-31' as is_current from brand_versions where isin in (select isin from movements)",
    "fct_trades": "select x.*, v.instrument_version_sk from trades x " + _VERSIONED.format(day="trade_date"),
    "fct_transfers": "select x.*, v.instrument_version_sk from transfers x " + _VERSIONED.format(day="transfer_date"),
    "fct_cash_events": "select x.*, v.instrument_version_sk from events_on x " + _VERSIONED.format(day="event_date"),
    "fct_fx_trades": _CONVERT.replace("select t.fx_trade_id,", "select t.account_id, t.fx_trade_id,", 1),
    "fct_prices": "select * from prices_filled",
    "fct_position_daily": "select * from worth",
    "fct_position_snapshots": "select x.*, v.instrument_version_sk from statement x " + _VERSIONED.format(day="snapshot_date"),
}


def _report_sql():
    rows = []
    for layer, tables in LAYERS.items():
        rows += [(layer, t, r.name, r.severity, sql.format(table=t)) for t in tables for r, sql in RULES[t]]
        rows += [(layer, "", *c) for c in CHECKS.get(layer, [])]
    body = " union all ".join(f"select '{layer}' as layer, '{t}' as \"table\", '{name}' as \"check\", '{sev}' as severity, {sql} as violations" for layer, t, name, sev, sql in rows)
    status = "case when violations = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end"
    names = ["lines", "trades", "transfers", "movements", "calendar", "dates", "prices", "cash_events", "fx_tickets", "rates", "assignments", "register_versions", "brand_versions"]
    text = with_ctes(f"select layer, \"table\", \"check\", severity, violations::bigint as violations, {status} as status from ({body})", *names, extra=_TABLES_SQL)
    return re.sub(r"(?m)^(with )?(\w+) as \(", r"\1\2 as materialized (", text)


@register("q_layer_report", _report_sql())
def q_layer_report(spark, d):
    """The whole layered run, 31 tables, one row per rule and check."""
    _, report = run_pipeline(book_layers(spark, d), {}, keep=[])
    return report.select("layer", "table", "check", "severity", "violations", "status")
