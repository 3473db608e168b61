"""The independent statement: sums of dyadic day blocks against plain Python and against the running-sum book."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sparkbook.operators import calendar as cal
from sparkbook.operators.positions import position_book
from sparkbook.operators.recon import positions_at, positions_by_blocks, reconcile

KEYS = ["account_id", "isin"]
SCHEMA = "account_id int, isin string, movement_date date, quantity_delta long"
D0 = dt.date(2024, 1, 1)


def moves(seed=3, n=600, hot=200):
    """A third of the movements on one holding and day."""
    rng = random.Random(seed)
    out = [(rng.choice([1, 2, None]), rng.choice("AB"), D0 + dt.timedelta(days=rng.randint(0, 500)), rng.choice([None, *range(-9, 10)])) for _ in range(n - hot)]
    return out + [(1, "A", D0 + dt.timedelta(days=40), 1)] * hot + [(1, "A", None, 5), (3, "B", D0, 7), (3, "B", D0 + dt.timedelta(days=9), -7)]


def plain(data, days):
    out = {}
    for day in days:
        for k in {(r[0], r[1]) for r in data}:
            q = sum(r[3] or 0 for r in data if (r[0], r[1]) == k and r[2] is not None and r[2] <= day)
            if q:
                out[(*k, day)] = q
    return out


def test_blocks_against_plain_python(spark):
    data = moves()
    days = [D0 + dt.timedelta(days=x) for x in (-1, 0, 1, 2, 8, 30, 31, 32, 39, 40, 41, 127, 128, 255, 256, 499, 500, 501, 5000)]
    st = spark.createDataFrame([(x,) for x in days] + [(None,), (D0,)], "s date")
    got = positions_by_blocks(spark.createDataFrame(data, SCHEMA).repartition(4), st, KEYS)
    assert {(r.account_id, r.isin, r.snapshot_date): r.quantity for r in got.collect()} == plain(data, days)
    assert positions_by_blocks(spark.createDataFrame([], SCHEMA), st, KEYS).count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


def test_a_day_that_has_no_number_fails(spark):
    with pytest.raises(Exception, match="day out of range"):
        positions_by_blocks(spark.createDataFrame([(1, "A", dt.date(1700, 1, 1), 1)], SCHEMA), spark.createDataFrame([(D0,)], "s date"), KEYS).collect()


def calendar(spark):
    bounds = spark.createDataFrame([(D0, D0 + dt.timedelta(days=400))], "start_date date, end_date date")
    return cal.dim_dates(cal.trading_calendar(bounds))


def breaks(spark, book_moves, statement_moves):
    dates = calendar(spark)
    ends = dates.filter("is_last_trading_day_of_month").select("date_key")
    book = position_book(book_moves, dates, KEYS).filter("is_last_trading_day_of_month").withColumnRenamed("business_date", "as_of_date")
    st = positions_by_blocks(statement_moves, ends, KEYS)
    return reconcile(book, st, [*KEYS, "as_of_date"], "closing_quantity", "quantity", right_keys=[*KEYS, "snapshot_date"]).count()


def test_a_planted_error_on_either_side_shows(spark):
    data = [r for r in moves() if r[0] is not None and r[2] is not None and r[2].weekday() < 5 and r[3]]
    df = spark.createDataFrame(data, SCHEMA)
    assert breaks(spark, df, df) == 0
    wrong = df.withColumn("quantity_delta", F.when((F.col("movement_date") == D0 + dt.timedelta(days=44)), F.col("quantity_delta") + 1).otherwise(F.col("quantity_delta")))
    late = df.withColumn("movement_date", F.when(F.col("quantity_delta") == 9, F.date_add("movement_date", 28)).otherwise(F.col("movement_date")))
    assert late.exceptAll(df).count() > 0
    for bad in (late, df.filter("quantity_delta <> -8"), wrong.unionByName(df.limit(1))):
        assert breaks(spark, bad, df) > 0 and breaks(spark, df, bad) > 0


def test_blocks_agree_with_periods(spark):
    data = [r for r in moves(seed=8) if r[2] is not None and r[3]]
    dates = calendar(spark)
    df = spark.createDataFrame(data, SCHEMA).filter("movement_date <= date '2025-02-04' and account_id is not null")
    ends = dates.filter("is_last_trading_day_of_month").select("date_key")
    a = positions_at(df, ends, dates, KEYS, open_days_only=False)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, positions_by_blocks(df, ends, KEYS).collect()))


def test_union_distinct_by_name(spark):
    from sparkbook.operators.sets import union_distinct

    a, b = spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], "k int, v string"), spark.createDataFrame([("x", 1), (None, None), ("y", 2)], "v string, k int")
    assert sorted(map(tuple, union_distinct(a, b).collect()), key=str) == [(1, "x"), (2, "y"), (None, None)]
