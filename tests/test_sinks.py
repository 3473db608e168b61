"""Sinks, fingerprints and loads: nothing kept that should go, nothing lost that should stay."""

import datetime as dt
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbook.plans import standins
from sparkbook.plans.catalog import QUERIES
from sparkbook.sources import files as FS
from sparkbook.sources.incremental import high_water_mark, increment, write_partitions
from sparkbook.streaming import prices as P
from sparkbook.streaming.prices import load_prices_stream

from .conftest import SMOKE


def fp(spark, rows, schema="a string, b string"):
    return FS.fingerprint(spark.createDataFrame(rows, schema)).first()


def test_fingerprint_tells_fields_and_nulls_apart(spark):
    pairs = [([("a\x1fb", "c")], [("a", "b\x1fc")]), ([("\\N", "x")], [(None, "x")]), ([("N", "x")], [(None, "x")]),
             ([("", "ab")], [("ab", "")]), ([("1:a", "")], [("a", "1:")]), ([("x", "y")], [("x", "y"), ("x", "y")])]
    for left, right in pairs:
        assert fp(spark, left) != fp(spark, right)
    assert fp(spark, [("x", "y"), (None, "z")]) == fp(spark, [(None, "z"), ("x", "y")])
    assert fp(spark, []).n_rows == 0


def test_verify_load_sees_a_changed_value(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    assert FS.verify_load(a, a.orderBy(F.col("id").desc())).first().content_equal
    changed = FS.verify_load(a, a.withColumn("v", F.lit("x"))).first()
    assert (changed.source_rows, changed.loaded_rows, changed.schema_equal, changed.content_equal) == (2, 2, True, False)
    assert not FS.verify_load(a, a.select("v", "id")).first().schema_equal


def test_refused_file_keeps_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "source_file string, x int")
    assert FS.gated_write(rows, [rows.limit(0)], path, file_col="source_file").count() == 0
    refused = FS.gated_write(rows, [rows.filter("x = 2")], path, file_col="source_file")
    assert [r.source_file for r in refused.collect()] == ["b"]
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 3]
    with pytest.raises(ValueError):
        FS.gated_write(rows, [rows], path)


def test_replace_table_drops_stale_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    FS.replace_table(rows, path, ["p"])
    FS.replace_table(rows.filter("x = 2"), path, ["p"])
    assert [r.x for r in spark.read.parquet(path).collect()] == [2]


def test_clustered_table_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    FS.write_clustered(spark.range(500).select(F.col("id").alias("isin"), (F.col("id") % 5).alias("p")), path, "p", ["isin"])
    back = spark.read.parquet(path)
    assert back.count() == 500 and back.filter("p = 3").count() == 100
    starts = back.groupBy(F.input_file_name()).agg(F.min("isin").alias("lo"), F.max("isin").alias("hi"), F.min("p").alias("p"))
    files = sorted((r.p, r.lo, r.hi) for r in starts.collect())
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(files, files[1:], strict=False))


def test_manifest_combines_in_order(spark):
    a, b = spark.range(3), spark.range(4)
    m = {r.table_name: r for r in FS.manifest({"b": b, "a": a}).collect()}
    assert set(m) == {"a", "b", "*"} and m["*"].n_rows == 7
    again = {r.table_name: r.fingerprint for r in FS.manifest({"a": a, "b": b}).collect()}
    assert again["*"] == m["*"].fingerprint != {r.table_name: r.fingerprint for r in FS.manifest({"a": b, "b": a}).collect()}["*"]


def test_gap_is_refused(spark):
    listing = spark.createDataFrame([(dt.date(2026, 7, 20),)], "publication_date date")
    FS.require_no_gap(FS.resume_plan(listing, "2026-07-19"))
    with pytest.raises(ValueError, match="2026-07-18"):
        FS.require_no_gap(FS.resume_plan(listing, "2026-07-17"))
    since = FS.sets_in_range(listing, "2026-07-20", "2026-07-20")
    assert since.count() == 1 and FS.sets_in_range(listing, "2026-07-21", "2026-07-30").count() == 0


SCHEMA = T.StructType([T.StructField("isin", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("business_date", T.DateType())])


def test_second_file_of_a_day_adds_to_the_first(spark, tmp_path):
    source, target, day = str(tmp_path / "in"), str(tmp_path / "out"), dt.date(2026, 7, 1)
    name = f"s{uuid.uuid4().hex}"

    def land(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        load_prices_stream(spark, source, SCHEMA, target, name=name)
        return {r.isin: r.price for r in spark.read.parquet(target).filter(F.col("business_date") == day).collect()}

    assert land([("A", 1.0, day)]) == {"A": 1.0}
    assert land([("B", 2.0, day)]) == {"A": 1.0, "B": 2.0}
    assert land([("A", 3.0, day), ("C", 5.0, dt.date(2026, 7, 2))]) == {"A": 3.0, "B": 2.0}


def test_partition_replacement_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "d1"), (2, "d2")], "x int, business_date string")
    write_partitions(df, path)
    write_partitions(df.filter("x = 2").withColumn("x", F.lit(9)), path)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 9]


def test_a_batch_reads_the_files_of_its_own_days_only(spark, tmp_path, monkeypatch):
    source, target, name = str(tmp_path / "in"), str(tmp_path / "out"), f"s{uuid.uuid4().hex}"
    read = []
    inner = P.days_from_files
    monkeypatch.setattr(P, "days_from_files", lambda session, files, *a: (read.append(len(files)), inner(session, files, *a))[1])

    def land(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        load_prices_stream(spark, source, SCHEMA, target, name=name)

    for n in range(1, 6):
        land([("A", float(n), dt.date(2026, 7, n))])
    land([("B", 9.0, dt.date(2026, 7, 2)), ("B", 9.5, dt.date(2026, 7, 20))])
    land([("A", 7.0, dt.date(2026, 7, 2)), ("A", 7.5, dt.date(2026, 7, 20))])
    assert read == [1, 1, 1, 1, 1, 2, 3]  # of 7 files
    got = {(r.isin, r.business_date.day): r.price for r in spark.read.parquet(target).collect()}
    assert got == {("A", 1): 1.0, ("A", 2): 7.0, ("A", 3): 3.0, ("A", 4): 4.0, ("A", 5): 5.0, ("B", 2): 9.0, ("B", 20): 9.5, ("A", 20): 7.5}
    # a batch that runs again writes the same
    again = spark.read.schema(SCHEMA).parquet(source).withColumn(P.FILE, F.col("_metadata.file_path")).filter("business_date = date '2026-07-03'")
    P.index_batch(again, target, name, 2, "business_date")
    assert len(P.files_of_days(spark, target, spark.createDataFrame([(dt.date(2026, 7, 3),)], "day date"))) == 1
    assert len(spark.read.parquet(P.file_index(target)).select("file").distinct().collect()) == 7


def test_high_water_mark_from_folder_names(spark, tmp_path):
    path = str(tmp_path / "p")
    assert high_water_mark(spark, path) is None
    write_partitions(spark.createDataFrame([(1, dt.date(2026, 7, 1)), (2, dt.date(2026, 6, 30)), (3, None)], "x int, business_date date"), path)
    spark.sparkContext.setJobGroup("hwm", "hwm")
    assert high_water_mark(spark, path) == dt.date(2026, 7, 1)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("hwm")) == 0
    rows = spark.createDataFrame([(1, dt.date(2026, 7, 1)), (2, dt.date(2026, 7, 2))], "x int, business_date date")
    assert [r.x for r in increment(rows, high_water_mark(spark, path)).collect()] == [2]
    assert increment(rows, None).count() == increment(rows, rows.limit(0)).count() == 2 and increment(rows, rows).count() == 0


def test_the_price_query_builds_without_a_job(spark):
    """Reading the tables' schemas takes a job each; the query adds none."""

    def jobs(group, build):
        spark.sparkContext.setJobGroup(group, group)
        build(spark, SMOKE)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs("prices-query", QUERIES["q_incremental_prices"].build) == jobs("prices-alone", standins.prices)


def test_a_point_lookup_reads_a_fifteenth(spark, tmp_path):
    """Bytes by Spark's own input metrics: a key on a day, and a hashed key that the table is not sorted by."""
    rows = spark.range(300_000).select(
        F.format_string("DE%08d", F.expr("id div 6")).alias("isin"), F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 6 * 100).cast("int")).alias("valid_from"),
        F.md5(F.col("id").cast("string")).alias("sk"), F.sha1(F.col("id").cast("string")).alias("name"))
    FS.replace_table(rows.repartition(8, "sk"), str(tmp_path / "plain"))
    FS.write_clustered(rows, str(tmp_path / "laid"), None, ["isin"], files_per_partition=8, bloom=["sk"], row_group_bytes=1 << 18)
    read = spark.read.option("parquet.hadoop.vectored.io.enabled", "false")
    plain, laid = read.parquet(str(tmp_path / "plain")), read.parquet(str(tmp_path / "laid"))
    for where, least in (("isin = 'DE00021000' and valid_from = date '2000-07-19'", 15), (f"sk = '{rows.filter('id = 123456').first()['sk']}'", 3), ("sk = '77777777777777777777777777777777'", 3)):
        (a, left), (b, right) = FS.bytes_read(plain.filter(where)), FS.bytes_read(laid.filter(where))
        assert left == right and a >= least * b, (where, a, b)


PINNED = [(1, "a", 1.5, dt.date(2026, 7, 1)), (2, None, -0.25, None), (2, None, -0.25, None), (3, "\u00fc", 0.0, dt.date(1960, 1, 1))]


def test_pinned_fingerprint_and_two_runs(spark):
    """The value is fixed: a change of framing, hash or sum shows here. Order and partitions do not matter, other content does."""
    schema = "id int, name string, x double, day date"
    one = FS.fingerprint(spark.createDataFrame(PINNED, schema)).first()
    two = FS.fingerprint(spark.createDataFrame(PINNED[::-1], schema).repartition(3)).first()
    assert tuple(one) == tuple(two) == (4, "18427089645040484175", "9290421379635267419")
    assert tuple(FS.fingerprint(spark.createDataFrame(PINNED[:3], schema)).first()) != tuple(one)


def test_tree_levels_add_up_and_narrow_a_difference(spark):
    a = spark.range(5000).select("id", (F.col("id") * 7).alias("v"))
    tree = FS.fingerprint_tree(a, ["id"], depth=2)
    rows = {(r.level, r.prefix): r for r in tree.collect()}
    whole = FS.fingerprint(a).first()
    assert tuple(rows[0, ""])[2:] == tuple(whole) and len(rows) == 1 + 16 + 256
    for level in (0, 1):
        for (lv, prefix), r in rows.items():
            if lv == level:
                below = [x for (k, p), x in rows.items() if k == level + 1 and p.startswith(prefix)]
                assert r.n_rows == sum(x.n_rows for x in below) and int(r.fp_a) == sum(int(x.fp_a) for x in below) % 2**64
    changed = a.withColumn("v", F.when(F.col("id") == 77, 0).otherwise(F.col("v"))).filter("id <> 4000").unionByName(a.filter("id = 4001"))
    found = {(r.level, r.prefix): (r.left_rows, r.right_rows) for r in FS.differing_buckets(tree, FS.fingerprint_tree(changed, ["id"], depth=2)).collect()}
    homes = {hashlib.sha256(f"{len(str(i))}:{i}".encode()).hexdigest()[:2] for i in (77, 4000, 4001)}
    assert all(FS.bucket_rows(a, ["id"], p).filter("id in (77, 4000, 4001)").count() for p in homes)
    assert {p for k, p in found if k == 2} == homes and (0, "") in found and len(found) <= 7
    assert FS.differing_buckets(tree, FS.fingerprint_tree(a.repartition(7), ["id"], depth=2)).count() == 0
    assert FS.differing_buckets(tree, FS.fingerprint_tree(a.limit(0), ["id"], depth=2)).filter("right_rows > 0").count() == 0


def test_a_manifest_reads_each_table_once(spark, tmp_path):
    for n in ("a", "b"):
        spark.range(9).write.parquet(str(tmp_path / n))
    plan = FS.manifest({n: spark.read.parquet(str(tmp_path / n)) for n in ("a", "b")})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
