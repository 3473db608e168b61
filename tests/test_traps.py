"""Semantic edge cases (the traps listed in SURVEY 0.1) on literal frames."""

import datetime as dt

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from sparkbook.functions import text as X
from sparkbook.operators import calendar as cal
from sparkbook.operators import positions as pos
from sparkbook.operators import temporal as T
from sparkbook.operators.joins import asof_join, resolve_version
from sparkbook.operators.recon import reconcile
from sparkbook.sources.staging import stage

D = dt.date


def _dates(spark, start="2026-07-01", end="2026-07-10"):
    b = spark.createDataFrame([(D.fromisoformat(start), D.fromisoformat(end))], "start_date date, end_date date")
    return cal.dim_dates(cal.trading_calendar(b)), cal.trading_calendar(b)


def _mv(spark, rows):
    return spark.createDataFrame(rows, "account_id bigint, isin string, movement_date date, quantity_delta bigint")


def test_closed_day_movement_dropped_or_rolled(spark):
    dates, calendar = _dates(spark)
    # 2026-07-04 is a Saturday
    mv = _mv(spark, [(1, "A", D(2026, 7, 1), 10), (1, "A", D(2026, 7, 4), 5)])
    book = pos.position_book(mv, dates, ["account_id", "isin"])
    last = book.filter(F.col("business_date") == D(2026, 7, 10)).first()
    assert last.closing_quantity == 10
    rolled = pos.roll_movements(mv, cal.roll_map(calendar))
    book2 = pos.position_book(rolled, dates, ["account_id", "isin"])
    assert book2.filter(F.col("business_date") == D(2026, 7, 6)).first().closing_quantity == 15
    assert book.filter(F.dayofweek("business_date").isin(1, 7)).count() == 0


def test_book_matches_range_aggregation(spark):
    dates, _ = _dates(spark)
    mv = _mv(spark, [(1, "A", D(2026, 7, 1), 10), (1, "A", D(2026, 7, 2), -3), (2, "A", D(2026, 7, 6), 4)])
    book = pos.position_book(mv, dates, ["account_id", "isin"])
    got = {(r.account_id, r.business_date): r.closing_quantity for r in book.collect()}
    assert got[(1, D(2026, 7, 3))] == 7 and got[(2, D(2026, 7, 7))] == 4
    assert (2, D(2026, 7, 3)) not in got


def test_carry_forward_first_held_day_stays_null_unless_lookback(spark):
    days = spark.createDataFrame([("A", D(2026, 7, 2)), ("A", D(2026, 7, 3))], "isin string, business_date date")
    prices = spark.createDataFrame(
        [("A", D(2026, 7, 1), 5.0, "EUR", "simulated", "per_unit"), ("A", D(2026, 7, 3), 6.0, "EUR", "simulated", "per_unit")],
        "isin string, business_date date, price double, price_currency string, price_source string, price_convention string")
    ref = {r.business_date: r for r in pos.carry_forward_prices(days, prices).collect()}
    assert ref[D(2026, 7, 2)].price is None and ref[D(2026, 7, 2)].price_source == "carried_forward"
    lb = {r.business_date: r for r in pos.carry_forward_prices(days, prices, lookback=True).collect()}
    assert lb[D(2026, 7, 2)].price == 5.0 and lb[D(2026, 7, 3)].price_source == "simulated"


def _events(spark, rows):
    return spark.createDataFrame(rows, "isin string, trading_venue_mic string, version_source string, "
                                 "effective_date date, source_file string, record_sequence bigint")


def test_same_day_events_keep_vs_last(spark):
    base = _events(spark, [("I", "M", "BASE", D(1960, 1, 1), "base", 0)])
    deltas = _events(spark, [("I", "M", "MODFD", D(2026, 7, 2), "d1", 1), ("I", "M", "MODFD", D(2026, 7, 2), "d1", 2)])
    keep = T.replay_versions(base, deltas)
    assert T.interval_order_violations(keep).count() == 1
    last = T.replay_versions(base, deltas, same_day="last")
    assert last.count() == 2 and T.interval_order_violations(last).count() == 0
    assert T.timeline_gaps(last, ["isin", "trading_venue_mic"]).count() == 0
    assert T.current_count_violations(last, ["isin", "trading_venue_mic"]).count() == 0


def test_cancel_erases_whole_history_and_base_scope(spark):
    base = _events(spark, [("I", "M", "BASE", D(1960, 1, 1), "base", 0), ("J", "M", "BASE", D(1960, 1, 1), "base", 0)])
    deltas = _events(spark, [("I", "M", "CANC", D(2026, 7, 2), "d", 1), ("J", "M", "MODFD", D(2026, 7, 1), "d", 1),
                             ("J", "M", "TERMNTD", D(2026, 7, 1), "d0", 2)])
    v = T.replay_versions(base, deltas, base_date="2026-07-01")
    assert v.filter("isin = 'I'").count() == 0
    # on the base date only TERMNTD/CANC are in scope
    assert sorted(r.version_source for r in v.filter("isin = 'J'").collect()) == ["BASE", "TERMNTD"]


def test_interval_and_asof_joins(spark):
    facts = spark.createDataFrame([("I", D(2026, 7, 1)), ("I", D(2026, 7, 5)), (None, D(2026, 7, 5))], "isin string, d date")
    dim = spark.createDataFrame([("I", D(2026, 1, 1), D(2026, 7, 3), "v1"), ("I", D(2026, 7, 4), D(9999, 12, 31), "v2")],
                                "isin string, valid_from date, valid_to date, instrument_version_sk string")
    got = sorted(((r.d, r.instrument_version_sk or "") for r in resolve_version(facts, dim, ["isin"], "d").collect()))
    assert got == [(D(2026, 7, 1), "v1"), (D(2026, 7, 5), ""), (D(2026, 7, 5), "v2")]
    rates = spark.createDataFrame([("USD", D(2026, 7, 1), 1.1), ("USD", D(2026, 7, 3), 1.2)], "ccy string, rd date, r double")
    left = spark.createDataFrame([("USD", D(2026, 6, 30)), ("USD", D(2026, 7, 2)), ("USD", D(2026, 7, 9))], "ccy string, d date")
    a = {r.d: r.r for r in asof_join(left, rates, ["ccy"], "d", "rd", ["r"]).collect()}
    assert a == {D(2026, 6, 30): None, D(2026, 7, 2): 1.1, D(2026, 7, 9): 1.2}


def test_three_valued_flags_and_blanks(spark):
    df = spark.createDataFrame([("true",), ("false",), (None,), ("N/A",)], "f string")
    rows = df.select(X.to_bool("f").alias("b"), X.to_flag("f").alias("g"), X.is_blank("f").alias("z")).collect()
    assert [r.b for r in rows] == [True, False, None, False]
    assert [r.g for r in rows] == [True, False, False, False]
    assert [r.z for r in rows] == [False, False, True, True]


def test_strict_vs_tolerant_cast(spark):
    df = spark.createDataFrame([("12",), ("x",)], "q string")
    assert [r.q for r in stage(df, [("q", "q", "bigint", "tolerant")]).collect()] == [12, None]
    with pytest.raises(NumberFormatException, match="CAST_INVALID_INPUT"):
        stage(df, [("q", "q", "bigint", "strict")]).collect()
    with pytest.raises(ValueError):
        stage(df, [("missing", "q", "bigint")])


def test_reconcile_absence_is_zero(spark):
    a = spark.createDataFrame([("X", 1), ("Y", 0)], "k string, q bigint")
    b = spark.createDataFrame([("X", 1), ("Z", 2)], "k string, p bigint")
    got = sorted(tuple(r) for r in reconcile(a, b, ["k"], "q", "p").collect())
    assert got == [("Z", 0, 2)]
