"""The eighteen staging projections on literal rows."""

import datetime as dt
from decimal import Decimal

import pytest

from sparkbook.sources.staging_specs import GENERATED, PUBLISHED, TABLES, columns, stage_table


def raw(spark, table, **values):
    names = list(dict.fromkeys(s for s, _, _ in columns(table)))
    return spark.createDataFrame([tuple(values.get(n) for n in names)], ", ".join(f"{n} string" for n in names))


def test_eighteen_tables_with_distinct_targets():
    assert len(TABLES) == 18 and len(PUBLISHED) == 5 and len(GENERATED) == 13
    for table in TABLES:
        targets = [t for _, t, _ in columns(table)]
        assert len(targets) == len(set(targets)) > 1


@pytest.mark.parametrize("table", sorted(TABLES))
def test_every_table_stages_an_all_null_row(spark, table):
    row = stage_table(raw(spark, table), table).first()
    assert all(v is None or v is False for v in row)


def test_published_values(spark):
    r = stage_table(raw(spark, "instrument_deltas", isin="DE0001102333", debt_nominal_per_unit="1000", price_multiplier="x", commodity_deriv_indicator="true",
                        issuer_requested="false", debt_maturity_dt="9999-12-31", valid_from="2026-07-18", first_trade_dt="2020-01-02T03:04:05Z",
                        publication_date="2026-07-18", ingested_at="2026-07-19 00:00:00"), "instrument_deltas").first()
    assert r.nominal_value_per_unit == Decimal(1000) and r.price_multiplier is None
    assert (r.is_commodity_derivative, r.is_issuer_requested, r.is_never_published) == (True, False, False)
    assert r.debt_maturity_date is None and r.register_valid_from_date == dt.date(2026, 7, 18)
    assert r.first_traded_at.replace(tzinfo=None) == dt.datetime(2020, 1, 2, 3, 4, 5)
    v = stage_table(raw(spark, "venues", mic="XETR", lei="", oprt_sgmt="OPRT", creation_date="20050627", expiry_date="", last_update_date="soon"), "venues").first()
    assert (v.lei, v.is_operating_mic, v.creation_date, v.expiry_date, v.last_update_date) == (None, True, dt.date(2005, 6, 27), None, None)
    e = stage_table(raw(spark, "entities", successor_lei="", entity_status="NULL", entity_creation_date=""), "entities").first()
    assert (e.successor_lei, e.entity_status, e.entity_created_at) == (None, "NULL", None)
    f = stage_table(raw(spark, "rates", currency="USD", fx_rate="1.17", date="2026-07-13"), "rates").first()
    assert f.units_per_eur == Decimal("1.17") and f.rate_date == dt.date(2026, 7, 13)


def test_generated_values_must_parse(spark):
    t = stage_table(raw(spark, "trades", side="BUY", mic="XETR", price="98.5", trade_date="2026-07-01"), "trades").first()
    assert (t.trade_side, t.trading_venue_mic, t.price, t.trade_date) == ("BUY", "XETR", Decimal("98.5"), dt.date(2026, 7, 1))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_table(raw(spark, "trades", price="much"), "trades").collect()
    with pytest.raises(ValueError, match="side"):
        stage_table(raw(spark, "trades").drop("side"), "trades")
