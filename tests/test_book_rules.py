"""Book arithmetic and calendars on literal frames, and checks shown able to fail."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkbook.functions import finance as FN
from sparkbook.operators import book as B
from sparkbook.operators import calendar as cal
from sparkbook.operators import defects as DF
from sparkbook.operators import quality as Q
from sparkbook.operators import temporal as TP
from sparkbook.operators.joins import asof_join
from sparkbook.plans.q_quality import CLEAN
from sparkbook.session import checkpoint_root

from .conftest import SMOKE

D = dt.date


def one(spark, expr, **values):
    row = ", ".join(f"{v!r} as {k}" if isinstance(v, str) else f"{v} as {k}" for k, v in values.items())
    return float(spark.sql(f"select {row}").select(expr.alias("x")).first().x)


def test_gross_is_in_cents(spark):
    g = FN.gross("q", "p", "c")
    assert one(spark, g, q=333, p=99.1234, c="percent_of_par") == pytest.approx(330.08)
    assert one(spark, g, q=3, p=1.005, c="per_unit") == pytest.approx(3.02)


def test_lot_floor_knows_the_price_convention(spark):
    lot = FN.lot_floor("b", "p", "s", "c")
    assert one(spark, lot, b=10000.0, p=98.0, s=1000.0, c="percent_of_par") == 10000.0
    assert one(spark, lot, b=10000.0, p=98.0, s=1.0, c="per_unit") == 102.0
    assert one(spark, lot, b=10.0, p=98.0, s=1.0, c="per_unit") == 0.0


def test_payment_months_wrap_inside_the_year(spark):
    i = spark.createDataFrame([("A", 4, 11, 31), ("B", 1, 2, 30)], "isin string, n int, m int, d int")
    got = sorted((r.isin, r.pay_date) for r in B.payment_schedule(i, "isin", "n", "m", "d", 2023, 2024).collect())
    year = lambda y, feb: [("A", D(y, 2, feb)), ("A", D(y, 5, 31)), ("A", D(y, 8, 31)), ("A", D(y, 11, 30))]
    assert got == [*year(2023, 28), *year(2024, 29), ("B", D(2023, 2, 28)), ("B", D(2024, 2, 29))]


def test_fx_pegs_and_first_rate(spark):
    days = spark.createDataFrame([(0, D(2024, 1, 1)), (1, D(2023, 1, 1)), (1, D(2024, 5, 1)), (2, D(2024, 1, 1)), (3, D(2024, 1, 1))], "currency long, trade_date date")
    rates = spark.createDataFrame([(1, D(2024, 1, 1), 1.1), (1, D(2024, 4, 1), 1.2)], "currency long, rate_date date, units_per_eur double")
    pegs = spark.createDataFrame([(2, 7.45)], "currency long, units_per_eur double")
    got = {(r.currency, r.trade_date): r.units_per_eur for r in B.fx_rate(days, rates, before_start="first", pegs=pegs).collect()}
    assert got == {(0, D(2024, 1, 1)): 1.0, (1, D(2023, 1, 1)): 1.1, (1, D(2024, 5, 1)): 1.2, (2, D(2024, 1, 1)): 7.45, (3, D(2024, 1, 1)): None}
    assert {r.units_per_eur for r in B.fx_rate(days.filter("trade_date < '2024-01-01'"), rates).collect()} == {None}


def test_two_calendars_do_not_mix(spark):
    bounds = spark.createDataFrame([("X", D(2024, 1, 1), D(2024, 1, 31)), ("Y", D(2024, 1, 1), D(2024, 1, 31))], "calendar_code string, start_date date, end_date date")
    closed = spark.createDataFrame([("Y", D(2024, 1, 3)), ("Y", D(2024, 1, 31))], "calendar_code string, calendar_date date")
    c = cal.trading_calendar(bounds, closed)
    nxt = {(r.calendar_code, r.calendar_date): r.offset_date for r in cal.session_offset(c, 2).collect()}
    assert nxt["X", D(2024, 1, 1)] == D(2024, 1, 3) and nxt["Y", D(2024, 1, 1)] == D(2024, 1, 4)
    roll = {(r.calendar_code, r.calendar_date): r.following_date for r in cal.roll_map(c).collect()}
    assert roll["X", D(2024, 1, 3)] == D(2024, 1, 3) and roll["Y", D(2024, 1, 3)] == D(2024, 1, 4)
    last = {(r.calendar_code, r.date_key) for r in cal.dim_dates(c).filter("is_last_trading_day_of_month").collect()}
    assert last == {("X", D(2024, 1, 31)), ("Y", D(2024, 1, 30))}
    flags = {(r.calendar_code, r.calendar_date) for r in cal.session_flags(c).filter("is_month_last_session").collect()}
    assert flags == last


def test_quotes_outvote_the_calendar(spark):
    bounds = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 7))], "start_date date, end_date date")
    c = cal.trading_calendar(bounds, closing_month_days=[(1, 1)])
    quotes = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 2),), (D(2024, 1, 4),)], "rate_date date")
    got = {(r.calendar_date, r.finding) for r in cal.reconcile_quotes(c, quotes, until="2024-01-04").collect()}
    assert got == {(D(2024, 1, 1), "quoted_but_closed"), (D(2024, 1, 3), "open_but_unquoted")}


def test_erasure_spares_null_keys_and_reads_once(spark):
    ev = spark.createDataFrame([("A", "X", "NEW"), ("A", "X", "CANC"), ("B", "X", "NEW"), (None, "X", "CANC"), (None, "X", "NEW"), ("C", "X", None)],
                               "isin string, mic string, version_source string")
    got = sorted((r.isin or "", r.version_source or "") for r in TP.erase_cancelled(ev, ["isin", "mic"]).collect())
    assert got == [("", "CANC"), ("", "NEW"), ("B", "NEW"), ("C", "")]


def test_building_a_join_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("join-build", "join-build")
    a = spark.range(100).selectExpr("id", "date_add(date '2024-01-01', cast(id as int)) as d")
    asof_join(a, a.withColumnRenamed("d", "e").withColumn("v", F.lit(1)), ["id"], "d", "e", ["v"])
    assert len(tracker.getJobIdsForGroup("join-build")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_row_is_taken_and_its_copies_stay(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (3, "c")], "id int, v string")
    assert sorted(r.id for r in DF.without_one(df, df.filter("id = 1").limit(1)).collect()) == [1, 1, 2, 3]
    assert sorted(r.id for r in DF.without_one(df, df.filter("id = 2")).collect()) == [1, 1, 1, 3]
    with pytest.raises(ValueError):
        DF.remove_row(df.limit(0), "id")


@pytest.mark.parametrize("name", sorted(CLEAN))
def test_clean_input_passes_the_check(spark, name):
    assert CLEAN[name](spark, SMOKE).limit(1).count() == 0


def test_all_ten_defects_have_a_clean_side():
    assert len(CLEAN) == 10


def test_report_of_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "")], "id int, v string")
    checks = [Q.Check("v set", Q.not_null(df, "v")), Q.Check("id unique", Q.unique(df, "id"), severity="warn"),
              Q.Check("v known", Q.accepted_values(df, "v", ["a", ""])), Q.Check("few blanks", Q.not_empty_string(df, "v"), error_if=2)]
    got = {r.check: (r.violations, r.status) for r in Q.run_checks(checks).collect()}
    assert got == {"v set": (1, "fail"), "id unique": (1, "warn"), "v known": (0, "pass"), "few blanks": (1, "warn")}
    with pytest.raises(ValueError):
        Q.run_checks([])


def test_unset_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_ex_date_drop_is_kept_and_never_below_a_cent(spark):
    series = spark.createDataFrame([("A", D(2024, 1, d), p) for d, p in ((1, 10.0), (2, 11.0), (3, 2.0), (4, 12.0))], "isin string, day date, price double")
    dividends = spark.createDataFrame([("A", D(2024, 1, 2), 1.0), ("A", D(2024, 1, 3), 5.0), ("A", D(2024, 1, 4), 1.0)], "isin string, ex_date date, amount double")
    got = [round(r.adjusted_price, 4) for r in B.ex_date_adjust(series, dividends, "isin", "day", "price").orderBy("day").collect()]
    assert got == [10.0, 10.0, 0.01, 9.01]  # 1, then cut to 1.99, then 1 more


def test_profile_tilt_weighs_share_and_step(spark):
    inst = spark.createDataFrame([("x", 10)] * 3 + [("y", 100)], "class_of string, step int")
    targets = spark.createDataFrame([("p", "x", 0.5), ("p", "y", 0.5), ("q", "y", 1.0)], "profile string, class string, target double")
    got = {(r.profile, r["class"]): r.multiplier for r in B.profile_tilt(inst, targets, "class_of", "step", 50.0).collect()}
    assert got == {("p", "x"): pytest.approx(0.5 / 0.75), ("p", "y"): pytest.approx(0.5 / 0.5), ("q", "y"): pytest.approx(2.0)}


def test_a_failing_layer_stops_the_run(spark):
    from sparkbook.operators.layers import Layer, LayerFailed, run_pipeline

    built = []

    def layer(name, rows, bad):
        def build(t):
            built.append(name)
            return {name: spark.createDataFrame(rows, "id int")}

        return Layer(name, build, lambda t: [Q.Check("id set", Q.not_null(t[name], "id"), severity="error" if bad else "warn")])

    tables, report = run_pipeline([layer("a", [(1,)], True), layer("b", [(None,)], False)], {})
    assert set(tables) == {"a", "b"} and {(r.layer, r.status) for r in report.collect()} == {("a", "pass"), ("b", "warn")}
    with pytest.raises(LayerFailed) as failed:
        run_pipeline([layer("c", [(None,)], True), layer("e", [(1,)], True)], {})
    assert failed.value.layer == "c" and "e" not in built and failed.value.report.count() == 1
