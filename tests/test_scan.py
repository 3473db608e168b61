"""Ordered scans: numbering and running sums against plain Python, with hot keys and hot days."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkbook.operators import scan
from sparkbook.plans.catalog import QUERIES

from .conftest import SMOKE

D0 = dt.date(2024, 1, 1)


def rows(n=3000, seed=2):
    """A third of all rows on one (key, day); null keys, days and values."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if i % 3 == 0:
            k, d = "hot", D0
        else:
            k, d = rng.choice(["a", "b", "hot", None]), rng.choice([None, *[D0 + dt.timedelta(days=x) for x in range(5)]])
        out.append((k, d, i, None if rng.random() < 0.05 else rng.randint(-9, 9), f"t{i}"))
    rng.shuffle(out)
    return out


SCHEMA = "k string, d date, i int, v long, t string"


def plain(data):
    groups = defaultdict(list)
    for r in data:
        groups[r[0]].append(r)
    place, total = {}, {}
    for g in groups.values():
        run = 0
        for n, r in enumerate(sorted(g, key=lambda r: (r[1] is not None, r[1] or D0, r[2]))):
            run += r[3] or 0
            place[r[2]], total[r[2]] = n, run
    return place, total


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_hot_day_against_plain_python(spark, partitions):
    data, old = rows(), spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        run = scan.prefix_sum(df, ["k"], ["d", "i"], "v", "run")
        num = scan.numbered(df, ["k"], ["d", "i"], "place")
        assert run.columns == [*df.columns, "run"] and num.columns == [*df.columns, "place"]
        got, at = {r.i: r.run for r in run.collect()}, {r.i: r.place for r in num.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    place, total = plain(data)
    assert got == total and at == place


def test_a_hot_day_is_cut_into_pieces(spark):
    """A third of all rows on one key and day lie in about a third of the pieces, and no piece holds many more rows than another."""
    data = rows(12000)
    dealt = scan.in_pieces(spark.createDataFrame(data, SCHEMA).repartition(5), ["k"], ["d", "i"], pieces=30)
    sizes = [r["count"] for r in dealt.groupBy("__piece").count().collect()]
    hot = dealt.filter(F.col("k").eqNullSafe("hot") & (F.col("d") == D0)).select("__piece").distinct().count()
    assert hot >= 8 and max(sizes) < 3 * 12000 / 30


def test_several_keys_no_keys_decimals_and_an_empty_table(spark):
    df = spark.createDataFrame([("a", 1, 1, "1.10"), ("a", 1, 2, "2.20"), ("a", 2, 1, "-3.30"), (None, 1, 1, "4.00")], "k string, l int, o int, s string")
    df = df.withColumn("v", F.col("s").cast("decimal(18,2)"))
    got = {(r.k, r.l, r.o): str(r.running) for r in scan.prefix_sum(df, ["k", "l"], ["o"], "v").collect()}
    assert got == {("a", 1, 1): "1.10", ("a", 1, 2): "3.30", ("a", 2, 1): "-3.30", (None, 1, 1): "4.00"}
    assert [r.number for r in scan.numbered(df, [], ["k", "l", "o"]).orderBy("k", "l", "o").collect()] == [0, 1, 2, 3]
    assert scan.prefix_sum(df.limit(0), ["k"], ["o"], "v").collect() == []



def test_the_ledger_is_built_once(spark):
    """What is left to run reads the written pieces, not the facts."""
    for name in ("q_running_cash", "q_tightest_cash"):
        files = QUERIES[name].build(spark, SMOKE).inputFiles()
        assert files and not [f for f in files if "testdata" in f]
