"""DuckDB text of the stand-ins (see ``standins``) and a WITH-clause builder.

Used only to check the Spark builders against an independent engine: the
oracle sees the driver's raw tables and nothing else, so each query inlines
the CTEs it needs.
"""

from __future__ import annotations

# name -> (dependencies, SQL body)
CTES: dict[str, tuple[list[str], str]] = {
    "lines": ([], """
    select l_orderkey * 10 + l_linenumber as line_id, cast(c_nationkey as bigint) as account_id,
      o_custkey as client_id, p_brand as isin, 'XV' || cast(l_suppkey % 4 as varchar) as trading_venue_mic,
      cast(l_shipdate as date) as ship_date, cast(l_quantity as bigint) as quantity,
      cast(l_extendedprice as decimal(18,2)) as gross_consideration, cast(p_retailprice as decimal(18,4)) as price,
      l_returnflag as returnflag, l_linestatus as linestatus
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
      join part on l_partkey = p_partkey"""),
    "trades": (["lines"], """
    select line_id as trade_id, ship_date as trade_date, account_id, isin, trading_venue_mic,
      case when returnflag = 'R' then 'SELL' else 'BUY' end as trade_side, quantity, price, gross_consideration
    from lines where linestatus = 'F'"""),
    "transfers": (["lines"], """
    select line_id as transfer_id, ship_date as transfer_date, account_id, isin, trading_venue_mic,
      case when returnflag = 'R' then 'OUT' else 'IN' end as transfer_direction, quantity
    from lines where linestatus = 'O'"""),
    "movements": (["trades", "transfers"], """
    select account_id, isin, trading_venue_mic, trade_date as movement_date,
      case when trade_side = 'BUY' then quantity else -quantity end as quantity_delta,
      'TRADE' as movement_type, trade_id as movement_id from trades
    union all
    select account_id, isin, trading_venue_mic, transfer_date as movement_date,
      case when transfer_direction = 'IN' then quantity else -quantity end as quantity_delta,
      'TRANSFER' as movement_type, transfer_id as movement_id from transfers"""),
    "calendar": ([], """
    select cast(d as date) as calendar_date,
      isodow(d) <= 5 and not ((month(d) = 1 and day(d) = 1) or (month(d) = 12 and day(d) = 25)) as is_trading_day
    from (select unnest(generate_series((select min(l_shipdate) from lineitem),
                                        (select max(l_shipdate) from lineitem), interval 1 day)) as d)"""),
    "dates": (["calendar"], """
    select calendar_date as date_key, cast(year(calendar_date) as bigint) as calendar_year,
      cast(quarter(calendar_date) as bigint) as calendar_quarter, cast(month(calendar_date) as bigint) as calendar_month,
      cast(dayofweek(calendar_date) + 1 as bigint) as day_of_week, monthname(calendar_date) as month_name,
      dayname(calendar_date) as day_name, is_trading_day, calendar_date = last_day(calendar_date) as is_month_end,
      coalesce(calendar_date = max(case when is_trading_day then calendar_date end)
        over (partition by date_trunc('month', calendar_date)), false) as is_last_trading_day_of_month
    from calendar"""),
    "prices": (["lines"], """
    select isin, ship_date as business_date, cast(max(gross_consideration) as decimal(18,4)) as price,
      'EUR' as price_currency, 'simulated' as price_source,
      case when cast(substr(isin, 7, 10) as int) % 2 = 0 then 'percent_of_par' else 'per_unit' end as price_convention
    from lines group by isin, ship_date"""),
    "brand_events": ([], """
    select p_brand as isin, 'XOFF' as trading_venue_mic, 'BASE' as version_source, date '1960-01-01' as effective_date,
      cast(0 as bigint) as record_sequence, cast(100 as decimal(18,5)) as nominal_value_per_unit,
      cast(1 as decimal(18,5)) as price_multiplier
    from part group by p_brand
    union all
    select p_brand, 'XOFF', 'MODFD', cast(min(l_shipdate) as date), cast(1 as bigint),
      cast(min(p_size) as decimal(18,5)), cast(year(l_shipdate) % 3 + 1 as decimal(18,5))
    from lineitem join part on l_partkey = p_partkey group by p_brand, year(l_shipdate)"""),
    "brand_versions": (["brand_events"], """
    select md5(concat_ws('-', coalesce(cast(isin as varchar), '_dbt_utils_surrogate_key_null_'),
                             coalesce(cast(trading_venue_mic as varchar), '_dbt_utils_surrogate_key_null_'),
                             coalesce(cast(effective_date as varchar), '_dbt_utils_surrogate_key_null_'))) as instrument_version_sk,
      isin, trading_venue_mic, effective_date as valid_from,
      coalesce(cast(lead(effective_date) over w - interval 1 day as date), date '9999-12-31') as valid_to,
      nominal_value_per_unit, price_multiplier
    from brand_events window w as (partition by isin, trading_venue_mic order by effective_date, record_sequence)"""),
    "register_base": ([], """
    select p_partkey as isin, p_partkey % 4 as trading_venue_mic, 'BASE' as version_source,
      date '1960-01-01' as effective_date, cast(0 as bigint) as record_sequence, 'base' as source_file,
      p_name as instrument_full_name
    from part"""),
    "register_deltas": ([], """
    select isin, trading_venue_mic,
      ['NEW', 'MODFD', 'TERMNTD', 'CANC'][cast(e % 10 + 1 as int)] as version_source, effective_date,
      cast(floor(e / 10) as bigint) as record_sequence, 'delta_' || strftime(effective_date, '%Y%m%d') as source_file,
      'part ' || cast(isin as varchar) || ' v' || cast(cast(floor(e / 10) as bigint) as varchar) as instrument_full_name
    from (select l_partkey as isin, l_suppkey % 4 as trading_venue_mic, cast(l_shipdate as date) as effective_date,
            max((l_orderkey * 10 + l_linenumber) * 10 + case when l_orderkey % 97 = 0 then 3
              when l_returnflag = 'N' then 0 when l_returnflag = 'A' then 1 else 2 end) as e
          from lineitem group by l_partkey, l_suppkey % 4, cast(l_shipdate as date)) x"""),
    "register_events": (["register_base", "register_deltas"], """
    select * from register_base
    union all
    select * from register_deltas
    where effective_date > date '1998-01-01'
       or (effective_date = date '1998-01-01' and version_source in ('TERMNTD', 'CANC'))"""),
    "register_versions": (["register_events"], """
    select md5(concat_ws('-', coalesce(cast(isin as varchar), '_dbt_utils_surrogate_key_null_'),
                             coalesce(cast(trading_venue_mic as varchar), '_dbt_utils_surrogate_key_null_'),
                             coalesce(cast(effective_date as varchar), '_dbt_utils_surrogate_key_null_'))) as instrument_version_sk,
      isin, trading_venue_mic,
      cast(row_number() over w as bigint) as version_no, version_source, effective_date as valid_from,
      coalesce(cast(lead(effective_date) over w - interval 1 day as date), date '9999-12-31') as valid_to,
      lead(effective_date) over w is null as is_current, version_source = 'TERMNTD' as is_terminated,
      record_sequence, source_file, instrument_full_name
    from register_events e
    where not exists (select 1 from register_events c where c.version_source = 'CANC'
                        and c.isin = e.isin and c.trading_venue_mic = e.trading_venue_mic)
    window w as (partition by isin, trading_venue_mic order by effective_date, source_file, record_sequence)"""),
    "rates": ([], """
    select cast(c_nationkey as bigint) as currency, cast(o_orderdate as date) as rate_date,
      max(o_totalprice) / 100000 as units_per_eur
    from orders join customer on o_custkey = c_custkey where c_nationkey <> 0
    group by c_nationkey, cast(o_orderdate as date)"""),
    "fx_tickets": ([], """
    select o_orderkey as fx_trade_id, o_custkey as account_id, cast(c_nationkey as bigint) as sell_currency,
      cast((c_nationkey + 7) % 25 as bigint) as buy_currency, cast(o_totalprice as decimal(18,2)) as buy_amount,
      cast(o_orderdate as date) as trade_date, cast(o_orderkey % 50 as decimal(9,4)) as margin_bp
    from orders join customer on o_custkey = c_custkey"""),
    "assignments": ([], """
    select o_custkey as client_id, o_orderkey % 6 as rm_id, cast(o_orderdate as date) as assigned_date,
      o_orderkey as tie from orders"""),
    "cash_events": ([], """
    select user_id as account_id, event_id, cast(ts as date) as event_date, event_type,
      cast(case when event_type in ('purchase', 'error') then -value else value end as decimal(18,2)) as amount
    from events"""),
    "dirty_dates": ([], """
    select p_partkey as id, case p_size % 10 when 0 then '9999-12-31T00:00:00Z' when 1 then '1900-01-01'
      when 2 then 'n/a' when 3 then '' when 4 then cast(null as varchar)
      else '20' || cast(p_size % 50 + 10 as varchar) || '-06-15T22:00:00Z' end as raw
    from part"""),
}


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the named CTEs and their dependencies, in order.
    ``extra`` adds query-local CTEs after the shared ones."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in CTES[n][0]:
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} as ({CTES[n][1]}\n)" for n in ordered]
    parts += [f"{n} as ({s}\n)" for n, s in (extra or {}).items()]
    if not parts:
        return body
    return "with " + ",\n".join(parts) + "\n" + body
