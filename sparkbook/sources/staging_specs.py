"""Staging of the book's eighteen raw tables as data: source column, target name, kind.

Kinds: a SQL type is a strict cast in generated tables and a tolerant one in
published tables; the others name a decoder of ``DECODERS``. A column given by
its name alone is kept as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbook.functions import dates as D
from sparkbook.functions import text as X

NUMERIC = "decimal(38,9)"

DECODERS = {
    "present": X.nullif_empty,  # '' is absence
    "flag": X.to_bool,  # 'true', anything else, absent
    "flag_or_false": X.to_flag,
    "operating": lambda c: F.col(c) == "OPRT",
    "compact_date": D.compact_date,
    "source_date": D.parse_source_date,
    "source_timestamp": D.parse_source_timestamp,
    "timestamp_if_present": lambda c: F.nullif(F.col(c), F.lit("")).try_cast("timestamp"),
}

_REGISTER = """
isin | trading_venue_mic | issuer_lei | relevant_trading_venue > relevant_trading_venue_mic | relevant_competent_authority
full_name > instrument_full_name | short_name > instrument_short_name | cfi_code | cfi_category | notional_ccy > notional_currency
option_type | option_exercise_style | delivery_type | source_file
debt_total_issued_nominal > total_issued_nominal_amount : numeric | debt_nominal_per_unit > nominal_value_per_unit : numeric | price_multiplier : numeric
commodity_deriv_indicator > is_commodity_derivative : flag | issuer_requested > is_issuer_requested : flag
debt_maturity_dt > debt_maturity_date : source_date | derivative_expiry_dt > derivative_expiry_date : source_date
valid_from > register_valid_from_date : source_date | publication_date : date
admission_approval_dt > admission_approved_at : source_timestamp | admission_request_dt > admission_requested_at : source_timestamp
first_trade_dt > first_traded_at : source_timestamp | termination_dt > terminated_at : source_timestamp | ingested_at : timestamp
"""

# What each raw table is staged to.
PUBLISHED = {
    "rates": "currency | source_file | fx_rate > units_per_eur : numeric | date > rate_date : date | publication_date : date | ingested_at : timestamp",
    "instruments": _REGISTER,
    "instrument_deltas": _REGISTER + "record_sequence | record_type | never_published > is_never_published : flag_or_false",
    "entities": """
lei | successor_lei : present | managing_lou | legal_name | legal_country | legal_city | hq_country | hq_city | legal_jurisdiction : present | legal_form_code
entity_category | entity_status | registration_status | conformity_flag : present | source_file | publication_date : date
entity_creation_date > entity_created_at : timestamp_if_present | initial_registration_date > initially_registered_at : timestamp
last_update_date > last_updated_at : timestamp | next_renewal_date > next_renewal_at : timestamp | ingested_at : timestamp
""",
    "venues": """
mic | operating_mic | lei : present | market_name_institution_description > market_name | legal_entity_name : present | market_category_code
iso_country_code > country_code | city | status | source_file | oprt_sgmt > is_operating_mic : operating | creation_date : compact_date
last_update_date : compact_date | last_validation_date : compact_date | expiry_date : compact_date | publication_date : date | ingested_at : timestamp
""",
}
GENERATED = {
    "accounts": "account_id | client_id | desk_id | rm_id | base_currency | mandate_type | house_model | arrival_book_value : numeric | migrated > is_migrated | opened_date : date",
    "calendar_days": "is_trading_day | calendar_date : date",
    "cash_events": "event_id > cash_event_id | account_id | isin | event_type | currency > event_currency | amount : numeric | event_date : date | entitlement_date : date",
    "clients": "client_id | lei | client_name | client_type | domicile_country | risk_profile | client_since > client_since_date : date",
    "crypto_mappings": "isin | underlying_symbol | instrument_name | asset_class | match_basis",
    "desks": "desk_id | head_rm_id | desk_name | region > desk_region",
    "fx_trades": "fx_id > fx_trade_id | account_id | related_trade_id | sell_currency | buy_currency | sell_amount : numeric | buy_amount : numeric | reference_rate : numeric | margin_bp : numeric | trade_date : date",
    "position_snapshots": "account_id | isin | currency > position_currency | quantity | is_month_end | snapshot_date : date",
    "prices": "isin | currency > price_currency | price_source | price_convention | price : numeric | business_date : date",
    "relationship_managers": "rm_id | desk_id | rm_name | title",
    "rm_assignments": "client_id | rm_id | assigned_date : date",
    "trades": "trade_id | account_id | isin | mic > trading_venue_mic | side > trade_side | trade_type | currency > trade_currency | quantity | price : numeric | gross_consideration : numeric | accrued_interest : numeric | fees : numeric | trade_date : date | settlement_date : date",
    "transfers": "transfer_id | account_id | isin | mic > trading_venue_mic | direction > transfer_direction | currency > transfer_currency | quantity | market_price : numeric | market_value : numeric | transfer_date : date",
}
TABLES = PUBLISHED | GENERATED


def columns(table: str) -> list[tuple[str, str, str | None]]:
    """(source, target, kind) of a table's columns, in order."""
    out = []
    for item in TABLES[table].replace("\n", " | ").split("|"):
        names, _, kind = (x.strip() for x in item.partition(":"))
        source, _, target = (x.strip() for x in names.partition(">"))
        if source:
            out.append((source, target or source, kind or None))
    return out


def _column(source: str, kind: str | None, tolerant: bool) -> Column:
    if kind is None:
        return F.col(source)
    if kind in DECODERS:
        return DECODERS[kind](source)
    kind = NUMERIC if kind == "numeric" else kind
    # The load time is ours: it must parse even in a published table.
    return F.col(source).try_cast(kind) if tolerant and source != "ingested_at" else F.col(source).cast(kind)


def stage_table(raw: DataFrame, table: str) -> DataFrame:
    """Stage a raw table by its entry in TABLES; a column missing from the input raises (schema drift)."""
    spec = columns(table)
    missing = [s for s, _, _ in spec if s not in raw.columns]
    if missing:
        raise ValueError(f"{table}: columns missing from source: {missing}")
    return raw.select(*[_column(s, kind, table in PUBLISHED).alias(target) for s, target, kind in spec])
