"""Queries exercising the scalar column functions and the calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkbook.functions import dates as D
from sparkbook.functions import keys as K
from sparkbook.functions import text as X
from sparkbook.operators import calendar as cal
from sparkbook.plans import standins as S
from sparkbook.plans.oracle_sql import with_ctes
from sparkbook.plans.registry import register

# CFI category letters accepted by the register schema.
CFI_LETTERS = ["C", "D", "E", "F", "H", "I", "J", "O", "R", "S"]

_INSTR_SQL = {"instr": """select p_partkey as id, p_name as name, p_brand as brand,
    ['C','D','E','F','H','I','J','O','R','S'][p_size % 10 + 1] || upper(substr(p_name, 1, 1)) || 'XXXX' as cfi_code,
    case p_size % 7 when 0 then '' when 1 then 'N/A' else cast(p_size * 10 as varchar) end as nominal_raw,
    case p_size % 5 when 0 then '' when 1 then 'N/A' when 2 then cast(null as varchar) else p_name end as raw_name,
    case p_size % 3 when 0 then 'true' when 1 then 'false' end as raw_flag,
    'XS' || lpad(cast(p_partkey as varchar), 9, '0') || cast(p_size % 10 as varchar) as isin_raw,
    case when p_size % 4 = 0 then lower(p_brand) else lpad(cast(p_partkey * 7919 as varchar), 18, 'A') || '00' end as lei_raw,
    upper(substr(p_name, 1, 4)) as mic_raw
  from part"""}


def instr(spark, d):
    p = S.table(spark, d, "part")
    letters = F.array(*[F.lit(x) for x in CFI_LETTERS])
    m7, m5, m3 = F.col("p_size") % 7, F.col("p_size") % 5, F.col("p_size") % 3
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.concat(F.element_at(letters, (F.col("p_size") % 10 + 1).cast("int")),
                 F.upper(F.substring("p_name", 1, 1)), F.lit("XXXX")).alias("cfi_code"),
        F.when(m7 == 0, "").when(m7 == 1, "N/A").otherwise((F.col("p_size") * 10).cast("string")).alias("nominal_raw"),
        F.when(m5 == 0, "").when(m5 == 1, "N/A").when(m5 == 2, F.lit(None).cast("string"))
        .otherwise(F.col("p_name")).alias("raw_name"),
        F.when(m3 == 0, "true").when(m3 == 1, "false").alias("raw_flag"),
        F.concat(F.lit("XS"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), (F.col("p_size") % 10).cast("string"))
        .alias("isin_raw"),
        F.when(F.col("p_size") % 4 == 0, F.lower("p_brand"))
        .otherwise(F.concat(F.lpad((F.col("p_partkey") * 7919).cast("string"), 18, "A"), F.lit("00"))).alias("lei_raw"),
        F.upper(F.substring("p_name", 1, 4)).alias("mic_raw"),
    )


def isql(body):
    return with_ctes(body, extra=_INSTR_SQL)


@register("q_safe_cast", isql(
    "select id, coalesce(try_cast(case when nominal_raw is null or nominal_raw in ('', 'N/A') then null "
    "else nominal_raw end as double), 0.0) as nominal, substr(name, 1, 120) as short_name from instr"))
def q_safe_cast(spark, d):
    """Tolerant numeric parse with default, truncated name."""
    return instr(spark, d).select("id", X.safe_double("nominal_raw").alias("nominal"),
                                  F.substring("name", 1, 120).alias("short_name"))


@register("q_sentinel_date", with_ctes(
    "select id, case when substr(raw, 1, 4) >= '9990' then null when substr(raw, 1, 4) <= '1900' then null "
    "else try_cast(substr(raw, 1, 10) as date) end as parsed_date from dirty_dates", "dirty_dates"))
def q_sentinel_date(spark, d):
    """Sentinel-aware tolerant date decode."""
    return S.dirty_dates(spark, d).select("id", D.parse_source_date("raw").alias("parsed_date"))


@register("q_sentinel_ts", with_ctes(
    "select id, cast(epoch(case when substr(raw, 1, 4) >= '9990' then null when substr(raw, 1, 4) <= '1900' then null "
    "else try_cast(raw as timestamp) end) as bigint) as epoch_seconds from dirty_dates", "dirty_dates"))
def q_sentinel_ts(spark, d):
    """P5: sentinel-aware tolerant timestamp decode (UTC)."""
    ts = D.parse_source_timestamp("raw")
    return S.dirty_dates(spark, d).select("id", F.unix_timestamp(ts).cast("bigint").alias("epoch_seconds"))


@register("q_compact_date", with_ctes(
    "select o_orderkey as id, cast(try_strptime(case o_orderkey % 10 when 0 then '' when 1 then 'N/A' "
    "when 2 then cast(null as varchar) else strftime(o_orderdate, '%Y%m%d') end, '%Y%m%d') as date) as parsed_date from orders"))
def q_compact_date(spark, d):
    """P6: 'YYYYMMDD' strings to dates, null-safe."""
    o = S.table(spark, d, "orders")
    m = F.col("o_orderkey") % 10
    raw = F.when(m == 0, "").when(m == 1, "N/A").when(m == 2, F.lit(None).cast("string")) \
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return o.select(F.col("o_orderkey").alias("id"), D.compact_date(raw).alias("parsed_date"))


@register("q_absence", isql(
    "select id, nullif(raw_name, '') as name_or_null, (raw_name is null or raw_name in ('', 'N/A')) as is_absent, "
    "case when raw_name is null or raw_name in ('', 'N/A') then 'unknown' else raw_name end as name_or_default, "
    "trim(raw_name) = '' as is_empty_string from instr"))
def q_absence(spark, d):
    """Empty-string and N/A absence conventions."""
    return instr(spark, d).select(
        "id", X.nullif_empty("raw_name").alias("name_or_null"), X.is_blank("raw_name").alias("is_absent"),
        X.default_if_blank("raw_name", "unknown").alias("name_or_default"),
        (F.trim("raw_name") == "").alias("is_empty_string"))


@register("q_flags", isql(
    "select id, raw_flag = 'true' as flag3, coalesce(raw_flag = 'true', false) as flag2, "
    "nominal_raw not in ('', 'N/A') as has_nominal from instr"))
def q_flags(spark, d):
    """Three-valued string flags and derived booleans."""
    return instr(spark, d).select("id", X.to_bool("raw_flag").alias("flag3"), X.to_flag("raw_flag").alias("flag2"),
                                  (~F.col("nominal_raw").isin("", "N/A")).alias("has_nominal"))


@register("q_cfi_decode", isql(
    "select id, substr(cfi_code, 1, 1) as cfi_category, case substr(cfi_code, 1, 1) when 'C' then "
    "'collective_investment' when 'D' then 'debt' when 'E' then 'equity' end as asset_class from instr"))
def q_cfi_decode(spark, d):
    """CFI category letter and its asset class."""
    cat = X.cfi_category("cfi_code")
    return instr(spark, d).select("id", cat.alias("cfi_category"), X.cfi_asset_class(cat).alias("asset_class"))


_ASSET_SQL = """select id, cls as asset_class,
    case when cls = 'bond' then 'percent_of_par' when cls is not null then 'per_unit' end as price_convention,
    case when cls = 'bond' then (case when nominal >= 100 then nominal else 1000.0 end) else 1.0 end as nominal_step
  from (select id, nominal, case when substr(cfi_code, 1, 1) = 'C' then 'fund'
      when substr(cfi_code, 1, 1) = 'D' then (case when nominal >= 100 then 'bond' else 'structured' end)
      when substr(cfi_code, 1, 1) = 'E' then (case when substr(cfi_code, 1, 2) = 'ES' then 'equity' else 'certificate' end)
    end as cls
    from (select id, cfi_code, coalesce(try_cast(case when nominal_raw in ('', 'N/A') then null else nominal_raw end
      as double), 0.0) as nominal from instr) a) b"""


@register("q_asset_class", isql(_ASSET_SQL))
def q_asset_class(spark, d):
    """Finer asset class, price convention and dealing step."""
    i = instr(spark, d).select("id", "cfi_code", X.safe_double("nominal_raw").alias("nominal"))
    cls = X.asset_class("cfi_code", "nominal")
    conv = X.price_convention(cls)
    return i.select("id", cls.alias("asset_class"), conv.alias("price_convention"),
                    X.nominal_step("nominal", conv).alias("nominal_step"))


# Stand-in tagging rules over the test vocabulary (the library default is the
# crypto keyword set); exclusions win over any keyword.
DEMO_RULES = [("WIDGET", "WDG"), ("GEAR", "GER"), ("BOLT", "BLT"), ("RING", "RNG")]
DEMO_EXCLUDES = ["HOT ", "COLD "]


@register("q_keyword_tag", isql(
    "select id, case when upper(name) like '%HOT %' or upper(name) like '%COLD %' then '' "
    "when upper(name) like '%WIDGET%' then 'WDG' when upper(name) like '%GEAR%' then 'GER' "
    "when upper(name) like '%BOLT%' then 'BLT' when upper(name) like '%RING%' then 'RNG' else '' end as tag, "
    "'' as crypto_tag from instr"))
def q_keyword_tag(spark, d):
    """First-keyword tagging with exclusion tokens."""
    return instr(spark, d).select("id", X.keyword_tag("name", DEMO_RULES, DEMO_EXCLUDES).alias("tag"),
                                  X.keyword_tag("name").alias("crypto_tag"))


@register("q_surrogate_key", isql(
    "select id, md5(concat_ws('-', coalesce(cast(id as varchar), '_dbt_utils_surrogate_key_null_'), "
    "coalesce(cast(raw_flag as varchar), '_dbt_utils_surrogate_key_null_'), "
    "coalesce(cast(brand as varchar), '_dbt_utils_surrogate_key_null_'))) as sk from instr"))
def q_surrogate_key(spark, d):
    """md5 surrogate key with null token."""
    return instr(spark, d).select("id", K.surrogate_key("id", "raw_flag", "brand").alias("sk"))


@register("q_stable_bucket", isql(
    "select id, cast(('0x' || substr(sha256(name || cast(id as varchar)), 1, 16))::UBIGINT % 16 as bigint) as bucket "
    "from instr"))
def q_stable_bucket(spark, d):
    """Engine-independent 64-bit hash bucket of an identifier."""
    return instr(spark, d).select("id", K.stable_bucket(F.concat("name", F.col("id").cast("string")), 16).alias("bucket"))


@register("q_bad_format", isql(
    "select id, isin_raw, lei_raw, mic_raw, "
    "not coalesce(regexp_matches(isin_raw, '^[A-Z]{2}[A-Z0-9]{9}[0-9]$'), false) as bad_isin, "
    "not coalesce(regexp_matches(lei_raw, '^[A-Z0-9]{18}[0-9]{2}$'), false) as bad_lei, "
    "not coalesce(regexp_matches(mic_raw, '^[A-Z0-9]{4}$'), false) as bad_mic from instr "
    "where not coalesce(regexp_matches(isin_raw, '^[A-Z]{2}[A-Z0-9]{9}[0-9]$'), false) "
    "or not coalesce(regexp_matches(lei_raw, '^[A-Z0-9]{18}[0-9]{2}$'), false) "
    "or not coalesce(regexp_matches(mic_raw, '^[A-Z0-9]{4}$'), false)"))
def q_bad_format(spark, d):
    """Identifier format violations (blank allowed)."""
    i = instr(spark, d)
    bi, bl, bm = X.bad_format("isin_raw", "ISIN"), X.bad_format("lei_raw", "LEI"), X.bad_format("mic_raw", "MIC")
    return i.select("id", "isin_raw", "lei_raw", "mic_raw", bi.alias("bad_isin"), bl.alias("bad_lei"),
                    bm.alias("bad_mic")).filter("bad_isin or bad_lei or bad_mic")


_ORD_DATES = {"od": """select o_orderkey as id, cast(o_orderdate as date) as first_date,
    case when o_orderstatus = 'F' then cast(o_orderdate as date) + 30 end as termination_date,
    case when o_orderstatus <> 'O' then cast(o_orderdate as date) + cast(o_orderkey % 90 as int) end as maturity_date
  from orders"""}


def order_dates(spark, d):
    o = S.table(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_orderkey").alias("id"), day.alias("first_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(day, 30)).alias("termination_date"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(day, (F.col("o_orderkey") % 90).cast("int"))).alias("maturity_date"),
    )


@register("q_last_tradeable", with_ctes(
    "select id, least(coalesce(termination_date, date '9999-12-31'), coalesce(maturity_date, date '9999-12-31')) "
    "as last_tradeable_date from od", extra=_ORD_DATES))
def q_last_tradeable(spark, d):
    """Last tradeable day = earliest of termination and maturity."""
    return order_dates(spark, d).select("id", D.min_date("termination_date", "maturity_date").alias("last_tradeable_date"))


@register("q_liveness", with_ctes(
    "select id, first_date, termination_date from od where first_date <= date '1999-12-31' "
    "and coalesce(termination_date >= date '1999-12-31', true)", extra=_ORD_DATES))
def q_liveness(spark, d):
    """Instruments live at a window end (first <= end <= termination)."""
    od = order_dates(spark, d)
    return od.filter(D.is_live(F.to_date(F.lit("1999-12-31")), "first_date", "termination_date")).select(
        "id", "first_date", "termination_date")


@register("q_calendar", with_ctes("select calendar_date, is_trading_day from calendar", "calendar"))
def q_calendar(spark, d):
    """Trading calendar from a date range and closing days."""
    return S.calendar(spark, d)


@register("q_dim_dates", with_ctes("select * from dates", "dates"))
def q_dim_dates(spark, d):
    """Date dimension with month-end and last-trading-day flags."""
    return S.dates(spark, d)


@register("q_session_offset", with_ctes(
    "select calendar_date, lead(calendar_date, 2) over (order by calendar_date) as offset_date "
    "from calendar where is_trading_day", "calendar"))
def q_session_offset(spark, d):
    """Settlement date two sessions later."""
    return cal.session_offset(S.calendar(spark, d), 2)


@register("q_session_flags", with_ctes(
    "select calendar_date, row_number() over (partition by date_trunc('month', calendar_date) order by calendar_date desc) = 1 "
    "as is_month_last_session, row_number() over (partition by date_trunc('quarter', calendar_date) "
    "order by calendar_date desc) = 1 as is_quarter_last_session, row_number() over (partition by "
    "date_trunc('quarter', calendar_date) order by calendar_date desc) <= 5 as is_quarter_tail_session "
    "from calendar where is_trading_day", "calendar"))
def q_session_flags(spark, d):
    """Last session of month / quarter and the quarter's last five."""
    return cal.session_flags(S.calendar(spark, d), 5)


@register("q_roll_date", with_ctes(
    "select c.calendar_date, (select min(o.calendar_date) from calendar o where o.is_trading_day "
    "and o.calendar_date >= c.calendar_date) as following_date, (select max(o.calendar_date) from calendar o "
    "where o.is_trading_day and o.calendar_date <= c.calendar_date) as preceding_date from calendar c", "calendar"))
def q_roll_date(spark, d):
    """Roll every day to the next / previous open day."""
    return cal.roll_map(S.calendar(spark, d))


@register("q_trading_date", with_ctes(
    "select t.trade_id, t.trade_date from trades t left join dates c on t.trade_date = c.date_key "
    "where coalesce(c.is_trading_day, false) = false", "trades", "dates"))
def q_trading_date(spark, d):
    """Facts dated on a closed or unknown day."""
    from sparkbook.operators.quality import is_trading_date
    return is_trading_date(S.trades(spark, d), "trade_date", S.dates(spark, d)).select("trade_id", "trade_date")


@register("q_missing_dates", with_ctes(
    "select cast(e as date) as missing_publication_date from (select unnest(generate_series("
    "(select min(effective_date) from register_deltas), (select max(effective_date) from register_deltas), "
    "interval 1 day)) as e) x where cast(e as date) not in (select effective_date from register_deltas)",
    "register_deltas"))
def q_missing_dates(spark, d):
    """Publication days missing from the delta chain."""
    return _missing_dates(S.register_deltas(spark, d))


@register("q_missing_dates_broken", with_ctes(
    "select cast(e as date) as missing_publication_date from (select unnest(generate_series((select min(effective_date) from chain), "
    "(select max(effective_date) from chain), interval 1 day)) as e) x where cast(e as date) not in (select effective_date from chain)",
    "register_deltas", extra={"chain": "select effective_date from register_deltas where day(effective_date) not in (13, 14)"}))
def q_missing_dates_broken(spark, d):
    """The same check on a chain whose 13th and 14th of every month were never published."""
    return _missing_dates(S.register_deltas(spark, d).filter(~F.dayofmonth("effective_date").isin(13, 14)))


def _missing_dates(deltas):
    pub = deltas.select(F.col("effective_date").alias("d")).distinct()
    bounds = pub.agg(F.min("d").alias("start_date"), F.max("d").alias("end_date"))
    expected = cal.date_range(bounds, "start_date", "end_date", "missing_publication_date")
    return expected.join(pub, expected["missing_publication_date"] == pub["d"], "left_anti")


@register("q_max_date", with_ctes(
    "select snapshot_publication_date from (select max(effective_date) as snapshot_publication_date "
    "from register_deltas) x where snapshot_publication_date <> date '1998-01-01'", "register_deltas"))
def q_max_date(spark, d):
    """The latest publication must equal the configured base date."""
    m = S.register_deltas(spark, d).agg(F.max("effective_date").alias("snapshot_publication_date"))
    return m.filter(F.col("snapshot_publication_date") != F.to_date(F.lit(S.REGISTER_BASE_DATE)))


@register("q_calendar_recon", with_ctes(
    "select rate_date as calendar_date, 'quoted_but_closed' as finding from (select distinct rate_date from rates) where rate_date not in "
    "(select calendar_date from calendar where is_trading_day) union all select calendar_date, 'open_but_unquoted' from calendar where is_trading_day "
    "and calendar_date not in (select rate_date from rates) and calendar_date between date '1993-01-01' and date '1997-12-31'", "rates", "calendar"))
def q_calendar_recon(spark, d):
    """Days on which observed rates and the calendar's rules disagree (both directions)."""
    return cal.reconcile_quotes(S.calendar(spark, d), S.rates(spark, d), since="1993-01-01", until="1997-12-31")
