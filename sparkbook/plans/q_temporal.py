"""Queries over the versioned register: replay, erasure, interval checks,
point-in-time and as-of resolution, reconciliation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkbook.operators import temporal as T
from sparkbook.operators.joins import asof_join, count_versions, resolve_version
from sparkbook.operators.positions import position_book
from sparkbook.operators.recon import positions_at, positions_by_blocks, reconcile
from sparkbook.operators.sets import latest_per_key
from sparkbook.plans import standins as S
from sparkbook.plans.oracle_sql import with_ctes
from sparkbook.plans.q_positions import BOOK_KEYS, book_sql
from sparkbook.plans.registry import register
from sparkbook.session import checkpoint_root, discard, materialise
from sparkbook.sources.register_store import RegisterStore

REG_KEYS = ["isin", "trading_venue_mic"]


def register_versions(spark, d, same_day="keep"):
    return T.replay_versions(S.register_base(spark, d), S.register_deltas(spark, d), REG_KEYS,
                             base_date=S.REGISTER_BASE_DATE, same_day=same_day)


def brand_versions(spark, d):
    return T.replay_versions(S.brand_register_events(spark, d), order=("effective_date", "record_sequence"))


@register("q_scd2", with_ctes("select * from register_versions", "register_versions"))
def q_scd2(spark, d):
    """M1 (P14 P15 P22 J5 W2 W3 U1): type-2 register replayed from deltas."""
    return register_versions(spark, d)


@register("q_scd2_upkeep", with_ctes("select * from register_versions", "register_versions"))
def q_scd2_upkeep(spark, d):
    """M1: the register kept in buckets, its deltas delivered year by year; equal to the full replay."""
    store = RegisterStore(f"{checkpoint_root(spark)}/tables/register-{uuid.uuid4().hex}", REG_KEYS, buckets=16, base_date=S.REGISTER_BASE_DATE)
    store.create(S.register_base(spark, d))
    deltas = materialise(S.register_deltas(spark, d), "deltas")
    years = [r[0] for r in deltas.select(F.year("effective_date").alias("y")).distinct().orderBy("y").collect()]
    for y in years:
        store.apply(deltas.filter(F.year("effective_date") == y))
    discard(deltas)
    return store.read(spark).select(*register_versions(spark, d).columns)


@register("q_cancel_erasure", with_ctes(
    "select isin, trading_venue_mic, version_source, effective_date, record_sequence from register_events e "
    "where not exists (select 1 from register_events c where c.version_source = 'CANC' "
    "and c.isin = e.isin and c.trading_venue_mic = e.trading_venue_mic)", "register_events"))
def q_cancel_erasure(spark, d):
    """Every event of a key ever cancelled is erased."""
    base, deltas = S.register_base(spark, d), S.register_deltas(spark, d)
    ev = base.unionByName(deltas.filter(T.in_base_scope("effective_date", "version_source", S.REGISTER_BASE_DATE)))
    live = T.erase_cancelled(ev, REG_KEYS)
    return live.select(*REG_KEYS, "version_source", "effective_date", "record_sequence")


@register("q_gaps", with_ctes(
    "select * from (select isin, trading_venue_mic, valid_from, lag(valid_to) over (partition by isin, "
    "trading_venue_mic order by valid_from) as prev_valid_to from register_versions) x "
    "where prev_valid_to is not null and cast(prev_valid_to + interval 1 day as date) <> valid_from",
    "register_versions"))
def q_gaps(spark, d):
    """Versions not starting the day after the previous one ends."""
    return T.timeline_gaps(register_versions(spark, d), REG_KEYS)


@register("q_overlaps", with_ctes(
    "select * from (select isin, trading_venue_mic, valid_from, valid_to, lag(valid_to) over (partition by isin, "
    "trading_venue_mic order by valid_from, valid_to) as prev_valid_to from register_versions) x "
    "where prev_valid_to >= valid_from", "register_versions"))
def q_overlaps(spark, d):
    """Versions overlapping their predecessor."""
    return T.timeline_overlaps(register_versions(spark, d), REG_KEYS)


@register("q_one_current", with_ctes(
    "select isin, trading_venue_mic, cast(count_if(is_current) as bigint) as current_versions "
    "from register_versions group by isin, trading_venue_mic having count_if(is_current) <> 1", "register_versions"))
def q_one_current(spark, d):
    """Keys without exactly one current version."""
    return T.current_count_violations(register_versions(spark, d), REG_KEYS)


@register("q_interval_order", with_ctes(
    "select isin, trading_venue_mic, valid_from, valid_to from register_versions where valid_from > valid_to",
    "register_versions"))
def q_interval_order(spark, d):
    """Intervals ending before they start."""
    return T.interval_order_violations(register_versions(spark, d)).select(*REG_KEYS, "valid_from", "valid_to")


# Fixed values of the stand-in: which keys' versions are broken, and by how many days.
_BROKEN = {"broken": "select * replace (case when version_no = 2 and isin % 10 = 3 then date '1960-01-02' when version_no = 1 and not is_current and isin % 10 = 1 "
                     "then cast(valid_to - interval 3 day as date) when version_no = 1 and not is_current and isin % 10 = 2 then cast(valid_to + interval 3 day as date) "
                     "else valid_to end as valid_to, is_current and isin % 10 <> 4 as is_current) from register_versions"}


def broken_versions(spark, d):
    """The register with first versions that end early or late, second ones that end before they start, and keys without a current version."""
    v = register_versions(spark, d)
    first = (F.col("version_no") == 1) & ~F.col("is_current")
    kind = F.col("isin") % 10
    end = F.when((F.col("version_no") == 2) & (kind == 3), F.to_date(F.lit("1960-01-02")))
    end = end.when(first & (kind == 1), F.date_sub("valid_to", 3)).when(first & (kind == 2), F.date_add("valid_to", 3))
    return v.withColumns({
        "valid_to": end.otherwise(F.col("valid_to")),
        "is_current": F.col("is_current") & (kind != 4),
    })


@register("q_gaps_broken", with_ctes(
    "select b.isin, b.trading_venue_mic, b.valid_from, p.valid_to as prev_valid_to from broken b join broken p on p.isin = b.isin and "
    "p.trading_venue_mic = b.trading_venue_mic and p.valid_from = (select max(q.valid_from) from broken q where q.isin = b.isin and "
    "q.trading_venue_mic = b.trading_venue_mic and q.valid_from < b.valid_from) where b.valid_from - p.valid_to <> 1",
    "register_versions", extra=_BROKEN))
def q_gaps_broken(spark, d):
    """The gap check on a register with planted faults."""
    return T.timeline_gaps(broken_versions(spark, d), REG_KEYS)


@register("q_overlaps_broken", with_ctes(
    "select b.isin, b.trading_venue_mic, b.valid_from, b.valid_to, p.valid_to as prev_valid_to from broken b join broken p on p.isin = b.isin and "
    "p.trading_venue_mic = b.trading_venue_mic and p.valid_from = (select max(q.valid_from) from broken q where q.isin = b.isin and "
    "q.trading_venue_mic = b.trading_venue_mic and q.valid_from < b.valid_from) where p.valid_to >= b.valid_from",
    "register_versions", extra=_BROKEN))
def q_overlaps_broken(spark, d):
    """The overlap check on a register with planted faults."""
    return T.timeline_overlaps(broken_versions(spark, d), REG_KEYS)


@register("q_one_current_broken", with_ctes(
    "select distinct isin, trading_venue_mic, cast(0 as bigint) as current_versions from broken b where not exists (select 1 from broken c "
    "where c.is_current and c.isin = b.isin and c.trading_venue_mic = b.trading_venue_mic)", "register_versions", extra=_BROKEN))
def q_one_current_broken(spark, d):
    """The current-version check on a register with planted faults."""
    return T.current_count_violations(broken_versions(spark, d), REG_KEYS)


@register("q_interval_order_broken", with_ctes(
    "select isin, trading_venue_mic, valid_from, valid_to from broken where valid_to < valid_from", "register_versions", extra=_BROKEN))
def q_interval_order_broken(spark, d):
    """The interval check on a register with planted faults."""
    return T.interval_order_violations(broken_versions(spark, d)).select(*REG_KEYS, "valid_from", "valid_to")


@register("q_key_collision", with_ctes(
    "select distinct n.isin, n.trading_venue_mic from register_deltas n join register_base b "
    "using (isin, trading_venue_mic) where n.version_source = 'NEW' and n.effective_date > date '1998-01-01'",
    "register_deltas", "register_base"))
def q_key_collision(spark, d):
    """NEW records after the base date re-opening a base key."""
    new = S.register_deltas(spark, d).filter(
        (F.col("version_source") == "NEW") & (F.col("effective_date") > F.to_date(F.lit(S.REGISTER_BASE_DATE)))
    ).select(*REG_KEYS).distinct()
    return new.join(S.register_base(spark, d).select(*REG_KEYS), REG_KEYS, "left_semi")


@register("q_cancelled_present", with_ctes(
    "select isin, trading_venue_mic, version_source, valid_from from register_versions v where exists (select 1 from register_deltas x "
    "where x.version_source = 'CANC' and (x.isin, x.trading_venue_mic) = (v.isin, v.trading_venue_mic))", "register_versions", "register_deltas"))
def q_cancelled_present(spark, d):
    """Cancelled keys (recomputed from the raw deltas) still in the register."""
    canc = S.register_deltas(spark, d).filter(F.col("version_source") == "CANC").select(*REG_KEYS).distinct()
    v = register_versions(spark, d)
    return v.join(canc, REG_KEYS, "left_semi").select(*REG_KEYS, "version_source", "valid_from")


_REG_FACTS = {"reg_facts": "select l_orderkey * 10 + l_linenumber as trade_id, l_partkey as isin, "
              "l_suppkey % 4 as trading_venue_mic, cast(l_shipdate as date) as trade_date from lineitem"}


def reg_facts(spark, d):
    li = S.table(spark, d, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trade_id"),
        F.col("l_partkey").alias("isin"), (F.col("l_suppkey") % 4).alias("trading_venue_mic"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
    )


@register("q_resolve_version", with_ctes(
    "select f.trade_id, f.isin, f.trading_venue_mic, f.trade_date, v.instrument_version_sk from reg_facts f "
    "left join register_versions v on f.isin = v.isin and f.trading_venue_mic = v.trading_venue_mic "
    "and f.trade_date >= v.valid_from and f.trade_date <= v.valid_to", "register_versions", extra=_REG_FACTS))
def q_resolve_version(spark, d):
    """Each trade resolves the register version valid on its date."""
    return resolve_version(reg_facts(spark, d), register_versions(spark, d), REG_KEYS, "trade_date")


@register("q_one_version", with_ctes(
    "select f.isin, f.trading_venue_mic, f.trade_date, count(v.instrument_version_sk) as version_rows "
    "from (select distinct isin, trading_venue_mic, trade_date from reg_facts) f left join register_versions v "
    "on f.isin = v.isin and f.trading_venue_mic = v.trading_venue_mic and f.trade_date between v.valid_from and v.valid_to "
    "group by f.isin, f.trading_venue_mic, f.trade_date having count(v.instrument_version_sk) <> 1",
    "register_versions", extra=_REG_FACTS))
def q_one_version(spark, d):
    """Fact keys resolving zero or several versions."""
    c = count_versions(reg_facts(spark, d), register_versions(spark, d), REG_KEYS, "trade_date")
    return c.filter(F.col("version_rows") != 1)


@register("q_resolve_single_key", with_ctes(
    "select t.trade_id, t.isin, t.trade_date, v.instrument_version_sk, v.nominal_value_per_unit from trades t "
    "left join brand_versions v on t.isin = v.isin and t.trade_date >= v.valid_from and t.trade_date <= v.valid_to",
    "trades", "brand_versions"))
def q_resolve_single_key(spark, d):
    """Resolution on the instrument alone (no venue)."""
    r = resolve_version(S.trades(spark, d), brand_versions(spark, d), ["isin"], "trade_date",
                        take=("instrument_version_sk", "nominal_value_per_unit"))
    return r.select("trade_id", "isin", "trade_date", "instrument_version_sk", "nominal_value_per_unit")


@register("q_fct_transfers", with_ctes(
    "select t.transfer_id, t.transfer_date, t.account_id, t.isin, t.transfer_direction, t.quantity, "
    "v.instrument_version_sk from transfers t left join brand_versions v on t.isin = v.isin "
    "and t.transfer_date >= v.valid_from and t.transfer_date <= v.valid_to", "transfers", "brand_versions"))
def q_fct_transfers(spark, d):
    """M8: transfers fact with the resolved instrument version."""
    r = resolve_version(S.transfers(spark, d), brand_versions(spark, d), ["isin"], "transfer_date")
    return r.select("transfer_id", "transfer_date", "account_id", "isin", "transfer_direction", "quantity",
                    "instrument_version_sk")


@register("q_latest_per_key", with_ctes(
    "select client_id, rm_id, assigned_date from (select *, row_number() over (partition by client_id "
    "order by assigned_date desc, tie desc) as rn from assignments) x where rn = 1", "assignments"))
def q_latest_per_key(spark, d):
    """Current manager per client (latest assignment, total order)."""
    a = latest_per_key(S.assignments(spark, d), ["client_id"], ["assigned_date", "tie"])
    return a.select("client_id", "rm_id", "assigned_date")


_OWNER = {
    "opened": "select o_custkey as client_id, cast(min(l_shipdate) as date) as opened_date from orders "
              "join lineitem on l_orderkey = o_orderkey group by o_custkey",
    "daily_assign": "select client_id, assigned_date, max_by(rm_id, tie) as rm_id from assignments "
                    "group by client_id, assigned_date",
}


@register("q_asof_owner", with_ctes(
    "select o.client_id, o.opened_date, a.rm_id from opened o asof left join daily_assign a "
    "on o.client_id = a.client_id and o.opened_date >= a.assigned_date", "assignments", extra=_OWNER))
def q_asof_owner(spark, d):
    """Manager of record at account opening (last assignment on/before)."""
    o = S.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    opened = o.join(li, o.o_orderkey == li.l_orderkey).groupBy(F.col("o_custkey").alias("client_id")).agg(
        F.min("l_shipdate").cast("date").alias("opened_date"))
    daily = latest_per_key(S.assignments(spark, d), ["client_id", "assigned_date"], ["tie"]).select(
        "client_id", "assigned_date", "rm_id")
    r = asof_join(opened, daily, ["client_id"], "opened_date", "assigned_date", ["rm_id"])
    return r.select("client_id", "opened_date", "rm_id")


_SNAP_SQL = {
    "statement": """select mv.account_id, mv.isin, m.date_key as snapshot_date, cast(sum(mv.quantity_delta) as bigint) as quantity
      from movements mv join dates m on m.is_last_trading_day_of_month and mv.movement_date <= m.date_key
      group by mv.account_id, mv.isin, m.date_key having sum(mv.quantity_delta) <> 0""",
    "open_statement": """select mv.account_id, mv.isin, m.date_key as snapshot_date, cast(sum(mv.quantity_delta) as bigint) as quantity
      from movements mv join dates c on c.date_key = mv.movement_date and c.is_trading_day
      join dates m on m.is_last_trading_day_of_month and mv.movement_date <= m.date_key
      group by mv.account_id, mv.isin, m.date_key having sum(mv.quantity_delta) <> 0""",
}


def statement(bk, open_days_only=False):
    ends = bk.dates.filter("is_last_trading_day_of_month").select("date_key")
    return positions_at(bk.movements, ends, bk.dates, BOOK_KEYS, open_days_only=open_days_only, daily=True)


@register("q_snapshot", book_sql("select * from statement", extra=_SNAP_SQL))
def q_snapshot(spark, d):
    """Published month-end statement rebuilt by range aggregation
    (custodian view: movements on closed days count)."""
    return statement(S.book(spark, d))


_RECON = ("select account_id, isin, as_of_date, cast(sum(d) as bigint) as derived_quantity, cast(sum(p) as bigint) as published_quantity from "
          "(select account_id, isin, business_date as as_of_date, closing_quantity as d, 0 as p from book where is_last_trading_day_of_month "
          "union all select account_id, isin, snapshot_date, 0, quantity from {side}) group by account_id, isin, as_of_date having sum(d) <> sum(p)")


def block_statement(bk, open_days_only=False):
    """The statement by dyadic day blocks: independent of the book's running sum."""
    ends, moved = bk.dates.filter("is_last_trading_day_of_month").select("date_key"), bk.movements
    if open_days_only:
        moved = moved.join(bk.calendar.filter("is_trading_day").select(F.col("calendar_date").alias("movement_date")), "movement_date", "left_semi")
    return positions_by_blocks(moved, ends, BOOK_KEYS)


@register("q_block_statement", book_sql("select * from statement", extra=_SNAP_SQL))
def q_block_statement(spark, d):
    """The month-end statement as sums of day blocks."""
    return block_statement(S.book(spark, d))


def _recon(spark, d, st):
    """Month ends of the running-sum book against a statement of the same movements."""
    bk = S.book(spark, d)
    book = position_book(bk.movements, bk.dates, BOOK_KEYS, daily=True).filter("is_last_trading_day_of_month")
    return reconcile(book.withColumnRenamed("business_date", "as_of_date"), st(bk), [*BOOK_KEYS, "as_of_date"],
                     "closing_quantity", "quantity", right_keys=[*BOOK_KEYS, "snapshot_date"])


@register("q_reconcile", book_sql(_RECON.format(side="statement"), extra=_SNAP_SQL))
def q_reconcile(spark, d):
    """Derived book vs published statement at month ends; breaks
    are exactly the movements booked on closed days (trap T3)."""
    return _recon(spark, d, statement)


@register("q_reconcile_range", book_sql(_RECON.format(side="open_statement"), extra=_SNAP_SQL))
def q_reconcile_range(spark, d):
    """Running-sum book vs sums of day blocks over open days; must be empty."""
    return _recon(spark, d, lambda bk: block_statement(bk, open_days_only=True))
