"""As-of and interval joins: results against plain Python, hot keys, and plans without range joins."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkbook.operators import joins as J
from sparkbook.plans.catalog import QUERIES

from .conftest import SMOKE

D0 = dt.date(2020, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def joins_of(df):
    """The join lines of a plan with their conditions."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.split("\n") if re.search(r"\bJoin\b", line)]


def plain_asof(left, right):
    out = []
    for i, k, t in left:
        before = [(x, v) for kk, x, v in right if kk == k and k is not None and t is not None and x is not None and x <= t]
        out.append((i, k, t, max(before, key=lambda r: r[0])[1] if before else None))
    return out


def series(seed=1, n=400, span=900):
    """A third of all rows on key ``h``; null keys and times; days before the first rate; null values."""
    rng = random.Random(seed)
    key = lambda: "h" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])
    left = [(i, key(), None if rng.random() < 0.05 else day(rng.randint(-40, span))) for i in range(n)]
    right = {(key(), day(rng.randint(0, span))) for _ in range(n)}
    return left, [(k, t, None if rng.random() < 0.1 else rng.randint(0, 99)) for k, t in sorted(right, key=str)] + [("a", None, 7)]


@pytest.mark.parametrize("period", ["month", "year", "day", None, lambda c: F.datediff(c, F.lit(D0)).cast("int") / 7])
def test_asof_against_plain_python(spark, period):
    left, right = series()
    a, b = spark.createDataFrame(left, "i int, k string, t date"), spark.createDataFrame(right, "k string, u date, v int")
    got = J.asof_join(a, b, ["k"], "t", "u", ["v"], period)
    assert got.columns == ["i", "k", "t", "v"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_asof(left, right))


def test_asof_on_numbers_strings_and_timestamps(spark):
    left, right = series(seed=3)
    for cast, kind in ((lambda t: t and (t - D0).days, "long"), (lambda t: t and t.isoformat(), "string"), (lambda t: t and dt.datetime(t.year, t.month, t.day, 5), "timestamp")):
        lo, ro = [(i, k, cast(t)) for i, k, t in left], [(k, cast(t), v) for k, t, v in right]
        a, b = spark.createDataFrame(lo, f"i int, k string, t {kind}"), spark.createDataFrame(ro, f"k string, u {kind}, v int")
        assert sorted(map(tuple, J.asof_join(a, b, {"k": "k"}, "t", "u", ["v"]).collect())) == sorted(plain_asof(lo, ro))


def test_asof_several_keys_and_values_and_empty_sides(spark):
    a = spark.createDataFrame([(1, "x", day(3)), (1, "y", day(3)), (2, "x", day(9))], "k int, l string, t date")
    b = spark.createDataFrame([(1, "x", day(1), 10, "p"), (1, "x", day(3), 11, None), (2, "x", day(10), 12, "q")], "k int, l string, u date, v int, w string")
    got = J.asof_join(a, b, ["k", "l"], "t", "u", ["v", "w", "u"]).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "x", day(3), 11, None, day(3)), (1, "y", day(3), None, None, None), (2, "x", day(9), None, None, None)]
    assert J.asof_join(a.limit(0), b, ["k", "l"], "t", "u", ["v"]).collect() == []
    assert {r.v for r in J.asof_join(a, b.limit(0), ["k", "l"], "t", "u", ["v"]).collect()} == {None}


@pytest.mark.parametrize("name", ["q_asof_rate", "q_fx_check", "q_accrued", "q_asof_owner", "q_periodic_fees", "q_resolve_version", "q_one_version"])
def test_no_join_has_an_inequality(spark, name):
    lines = joins_of(QUERIES[name].build(spark, SMOKE))
    assert lines and not [x for x in lines if re.search(r"[<>]=? ", x.replace("<=>", ""))]


def test_a_hot_key_is_scanned_by_period(spark):
    """The rows of a key are in as many groups as it has months: none holds more than a few per cent of them."""
    left = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.date_add(F.lit(D0), (F.col("id") % 1000).cast("int")).alias("t"), "id")
    right = spark.range(1000).select(F.lit(0).alias("k"), F.date_add(F.lit(D0), F.col("id").cast("int")).alias("u"), F.col("id").alias("v"))
    got = J.asof_join(left, right, ["k"], "t", "u", ["v"])
    assert got.filter("k = 0 and v <> datediff(t, date '2020-01-01')").count() == 0 and got.filter("k = 0 and v is null").count() == 0
    assert got.count() == 30000 and got.filter("k <> 0 and v is not null").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.split("\n") if "Window [" in x]
    # one scan by key and period, one over the key's periods
    assert sorted(x.count("__p#") > 0 for x in windows) == [True, True] and len(windows) == 2


def chain(versions, key="K", step=1):
    return [(key, day(i * step), day(i * step + step - 1), f"{key}{i}") for i in range(versions)]


def plain_versions(facts, versions):
    out = []
    for i, k, t in facts:
        hits = [v for kk, a, b, v in versions if kk == k and k is not None and t is not None and None not in (a, b) and a <= t <= b]
        out += [(i, k, t, v) for v in hits] or [(i, k, t, None)]
    return out


def register(seed=5):
    rng = random.Random(seed)
    versions = chain(200, "K", 3) + [("open", day(-5000), dt.date(9999, 12, 31), "o1"), ("open", day(100), day(130), "o2")]
    versions += [("over", day(0), day(500), "w1"), ("over", day(20), day(40), "w2"), ("over", day(30), day(600), "w3"), ("back", day(9), day(3), "b1")]
    versions += [(None, day(0), day(900), "n1"), ("K", None, day(2), "n2"), ("K", day(0), None, "n3")]
    versions += [("edge", dt.date(2020, 1, 31), dt.date(2020, 2, 1), "e1"), ("edge", dt.date(2020, 2, 2), dt.date(2021, 1, 31), "e2"), ("edge", dt.date(2021, 2, 1), dt.date(2022, 2, 28), "e3")]
    facts = [(i, rng.choice(["K", "open", "over", "back", "edge", "none", None]), None if rng.random() < 0.05 else day(rng.randint(-10, 800))) for i in range(600)]
    facts += [(1000 + i, "edge", d) for i, d in enumerate([dt.date(2020, 1, 31), dt.date(2020, 2, 1), dt.date(2021, 1, 31), dt.date(2021, 2, 1), dt.date(2022, 2, 28), dt.date(2022, 3, 1)])]
    return facts, versions


@pytest.mark.parametrize("long_months", [0, 1, 3, 10_000_000])
def test_versions_against_plain_python(spark, monkeypatch, long_months):
    facts, versions = register()
    if long_months > 12:  # everything by month: bounds that the calendar of a test can hold
        versions = [(k, a, min(b, day(900)) if b else b, v) for k, a, b, v in versions]
    monkeypatch.setattr(J, "LONG_MONTHS", long_months)
    f = spark.createDataFrame(facts, "i int, isin string, d date")
    v = spark.createDataFrame(versions, "isin string, valid_from date, valid_to date, instrument_version_sk string")
    got = J.resolve_version(f, v, ["isin"], "d")
    assert got.columns == ["i", "isin", "d", "instrument_version_sk"]
    want = plain_versions(facts, versions)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    inner = J.resolve_version(f, v, ["isin"], "d", how="inner").collect()
    assert Counter(map(tuple, inner)) == Counter(w for w in want if w[3] is not None)


def test_count_versions_finds_gaps_and_overlaps(spark):
    facts, versions = register()
    f = spark.createDataFrame(facts, "i int, isin string, d date")
    v = spark.createDataFrame(versions, "isin string, valid_from date, valid_to date, instrument_version_sk string")
    got = {(r.isin, r.d): r.version_rows for r in J.count_versions(f, v, ["isin"], "d").collect()}
    hits = Counter((k, t) for _, k, t, x in plain_versions(facts, versions) if x)
    for _, k, t in facts:
        if k is not None and t is not None:
            assert got[k, t] == len({x for _, kk, tt, x in plain_versions([(0, k, t)], versions) if x}), (k, t, hits[k, t])


def test_a_long_chain_meets_a_fact_with_its_month_only(spark):
    """10,000 one-day versions of a key that a third of all facts carry: at most 31 candidates a fact."""
    facts = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.lit("K")).otherwise(F.col("id").cast("string")).alias("isin"), F.date_add(F.lit(D0), (F.col("id") % 10000).cast("int")).alias("d"))
    versions = spark.range(10000).select(F.lit("K").alias("isin"), F.date_add(F.lit(D0), F.col("id").cast("int")).alias("valid_from"), F.col("id").alias("instrument_version_sk"))
    versions = versions.withColumn("valid_to", F.col("valid_from"))
    got = J.resolve_version(facts, versions, ["isin"], "d")
    assert got.filter("isin = 'K' and instrument_version_sk <> id").count() == 0 and got.count() == 9000
    assert got.filter("isin = 'K' and instrument_version_sk is null").count() == 0
    per_month = versions.groupBy("isin", J.month_of(F.col("valid_from")).alias("m")).count().agg(F.max("count")).first()[0]
    assert per_month == 31


def test_points_are_read_once(spark):
    """The two levels of the as-of scan share the exchange of the points."""
    df = QUERIES["q_asof_rate"].build(spark, SMOKE)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
