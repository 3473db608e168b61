"""Upkeep of the register by days: equal to the full replay, and only touched buckets are rewritten."""

import datetime as dt
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkbook.operators.temporal import replay_versions
from sparkbook.sources.register_store import RegisterStore

SCHEMA = "isin string, trading_venue_mic string, version_source string, effective_date date, source_file string, record_sequence long, name string"
BASE = dt.date(2026, 1, 10)


def base_rows():
    return [(f"I{i}", "XA" if i % 2 else "XB", "BASE", dt.date(1960, 1, 1), "base", 0, f"n{i}") for i in range(12)] + [(None, "XA", "BASE", dt.date(1960, 1, 1), "base", 0, "null key")]


def deltas(seed, days=6):
    """Per day a few events: new and changed keys, terminations, cancellations, two events of a key on one day, null keys."""
    rng = random.Random(seed)
    out = defaultdict(list)
    for n in range(days):
        day = BASE + dt.timedelta(days=n)
        for s in range(rng.randint(0, 7)):
            i = rng.choice([None, *range(16)])
            kind = rng.choice(["NEW", "MODFD", "MODFD", "MODFD", "TERMNTD", "CANC"])
            out[day].append((None if i is None else f"I{i}", "XA" if i and i % 2 else "XB", kind, day, f"d{n}", s + 1, f"n{rng.randint(0, 99)}"))
        out[day] += [(f"I{n}", "XA" if n % 2 else "XB", "MODFD", day, f"d{n}", 50 + k, f"twice{k}") for k in range(2)]
    return out


def content(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize(("seed", "same_day"), [(1, "keep"), (2, "last"), (3, "keep")])
def test_day_by_day_equals_the_full_replay(spark, tmp_path, seed, same_day):
    base, days = spark.createDataFrame(base_rows(), SCHEMA), deltas(seed)
    store = RegisterStore(str(tmp_path / "reg"), buckets=5, base_date=str(BASE), same_day=same_day)
    store.create(base)
    so_far = []
    for day in sorted(days):
        so_far += days[day]
        store.apply(spark.createDataFrame(days[day], SCHEMA))
        full = replay_versions(base, spark.createDataFrame(so_far, SCHEMA), base_date=str(BASE), same_day=same_day)
        assert content(store.read(spark)) == content(full)


def test_order_and_repetition_of_deliveries_do_not_matter(spark, tmp_path):
    base, days = spark.createDataFrame(base_rows(), SCHEMA), deltas(4, days=4)
    full = replay_versions(base, spark.createDataFrame([r for d in days.values() for r in d], SCHEMA))
    store = RegisterStore(str(tmp_path / "reg"), buckets=3)
    store.create(base)
    for day in [*sorted(days, reverse=True), min(days)]:
        store.apply(spark.createDataFrame(days[day], SCHEMA))
    assert content(store.read(spark)) == content(full)


def files(path):
    out = defaultdict(set)
    for d, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out[os.path.basename(d)].add((n, os.stat(os.path.join(d, n)).st_mtime_ns))
    return out


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "reg")
    store = RegisterStore(path, buckets=8)
    store.create(spark.createDataFrame(base_rows(), SCHEMA))
    before = files(path)
    touched = store.apply(spark.createDataFrame([("I1", "XA", "MODFD", BASE, "d", 1, "x"), ("I1", "XA", "CANC", BASE, "d", 2, None)], SCHEMA))
    after = files(path)
    assert len(touched) == 1 and len(before) > 3
    for bucket in before:
        assert (before[bucket] == after[bucket]) == (bucket != f"bucket={touched[0]}")
    assert store.apply(spark.createDataFrame([], SCHEMA)) == [] and files(path) == after
    # the erased key stays erased
    store.apply(spark.createDataFrame([("I1", "XA", "NEW", BASE + dt.timedelta(days=9), "e", 1, "again")], SCHEMA))
    assert store.read(spark).filter("isin = 'I1'").count() == 0 and store.stored(spark).filter(F.col("erased")).count() == 1


def test_a_register_may_start_empty(spark, tmp_path):
    store = RegisterStore(str(tmp_path / "reg"), buckets=4)
    store.create(spark.createDataFrame([("I0", "XA", "BASE", dt.date(1960, 1, 1), "base", 0, "n")], SCHEMA))
    store.apply(spark.createDataFrame([("I5", "XA", "NEW", BASE, "d", 1, "n5"), ("I5", "XA", "TERMNTD", BASE + dt.timedelta(days=2), "d", 2, "n5")], SCHEMA))
    got = [(r.version_no, r.valid_to, r.is_current, r.is_terminated) for r in store.read(spark).filter("isin = 'I5'").orderBy("version_no").collect()]
    assert got == [(1, BASE + dt.timedelta(days=1), False, False), (2, dt.date(9999, 12, 31), True, True)]


def test_a_delivery_moves_the_register_once_by_key_and_once_by_bucket(spark, tmp_path, monkeypatch):
    store = RegisterStore(str(tmp_path / "reg"), buckets=4)
    store.create(spark.createDataFrame(base_rows(), SCHEMA))
    plans = []
    write = RegisterStore._write
    monkeypatch.setattr(RegisterStore, "_write", lambda self, rows: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), write(self, rows)))
    store.apply(spark.createDataFrame([("I1", "XA", "MODFD", BASE, "d", 1, "x"), ("I2", "XB", "CANC", BASE, "d", 2, None)], SCHEMA))
    exchanges = [line for line in plans[0].splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and "Join" not in plans[0]  # versions with events; tombstones, which are keys alone


def test_keys_without_an_event_keep_all_their_columns(spark, tmp_path):
    """A delivery that lacks a column empties it for its own keys alone."""
    store = RegisterStore(str(tmp_path / "reg"), buckets=1)
    store.create(spark.createDataFrame(base_rows(), SCHEMA))
    store.apply(spark.createDataFrame([("I1", "XA", "MODFD", BASE, "d", 1)], SCHEMA.replace(", name string", "")))
    got = {(r.isin, r.version_no): r.name for r in store.read(spark).collect()}
    assert got["I1", 1] is None and got["I1", 2] is None and got["I2", 1] == "n2" and got[None, 1] == "null key"
