"""Readers, sinks and the incremental/streaming loads on hand-written files."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbook.sources import files as FS
from sparkbook.sources import registers as R
from sparkbook.sources.incremental import increment, write_partitions
from sparkbook.streaming.prices import load_prices_stream

FULL = """<?xml version="1.0" encoding="UTF-8"?>
<Doc xmlns{px}="urn:test:fulins">
  <{p}RefData><{p}FinInstrmGnlAttrbts><{p}Id>DE0001102333</{p}Id><{p}FullNm>Bund 2030</{p}FullNm>
    <{p}ClssfctnTp>DBFTFB</{p}ClssfctnTp></{p}FinInstrmGnlAttrbts>
    <{p}TradgVnRltdAttrbts><{p}Id>XETR</{p}Id></{p}TradgVnRltdAttrbts></{p}RefData>
  <{p}RefData><{p}FinInstrmGnlAttrbts><{p}Id>US0378331005</{p}Id>
    <{p}ClssfctnTp>ESVUFR</{p}ClssfctnTp></{p}FinInstrmGnlAttrbts>
    <{p}TradgVnRltdAttrbts><{p}Id>XNAS</{p}Id></{p}TradgVnRltdAttrbts></{p}RefData>
</Doc>
"""

SCHEMA = T.StructType([
    T.StructField("FinInstrmGnlAttrbts", T.StructType([
        T.StructField("Id", T.StringType()), T.StructField("FullNm", T.StringType()),
        T.StructField("ClssfctnTp", T.StringType())])),
    T.StructField("TradgVnRltdAttrbts", T.StructType([T.StructField("Id", T.StringType())])),
])
MAPPING = {"isin": "FinInstrmGnlAttrbts.Id", "full_name": "FinInstrmGnlAttrbts.FullNm",
           "cfi_code": "FinInstrmGnlAttrbts.ClssfctnTp", "trading_venue_mic": "TradgVnRltdAttrbts.Id"}


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_register_xml_default_and_prefixed_namespace(spark):
    d = tempfile.mkdtemp(prefix="sb-xml-")
    a = _write(os.path.join(d, "FULINS_D_20260718_01of01.xml"), FULL.format(px="", p=""))
    b = _write(os.path.join(d, "FULINS_D_20260718_01of01_ns.xml"), FULL.format(px=":f", p="f:"))
    for path in (a, b):
        df = R.read_register(spark, path, "RefData", SCHEMA, MAPPING)
        rows = sorted(df.collect(), key=lambda r: r.record_sequence)
        assert [r.isin for r in rows] == ["DE0001102333", "US0378331005"]
        assert rows[1].full_name is None and rows[0].trading_venue_mic == "XETR"
        meta = R.file_meta(R.read_xml(spark, path, "RefData", SCHEMA), r"^FULINS_([A-Z])_(\d{8})_", {"cfi_category": 1})
        assert {r.cfi_category for r in meta.collect()} == {"D"}


def test_csv_projection_keeps_literal_null_and_guards_drift(spark):
    d = tempfile.mkdtemp(prefix="sb-csv-")
    p = _write(os.path.join(d, "golden.csv"), "LEI,Entity.Status,Extra\nABC,NULL,1\nDEF,,2\n")
    df = R.read_csv_projected(spark, p, {"LEI": "lei", "Entity.Status": "entity_status"})
    got = {r.lei: r.entity_status for r in df.collect()}
    assert got["ABC"] == "NULL"
    try:
        R.read_csv_projected(spark, p, {"Missing": "x"})
        raise AssertionError("drift not detected")
    except ValueError:
        pass


def test_wide_rate_matrix_unpivot_and_unnamed_columns(spark):
    d = tempfile.mkdtemp(prefix="sb-fx-")
    p = _write(os.path.join(d, "eurofxref-hist-2026-07-13.csv"),
               "Date,USD,JPY,\n2026-07-13,1.17,N/A,\n2026-07-10,1.16,171.2,\n")
    header = R.named_columns(spark, p)
    named = [c for c in header if c and c != "Date"]
    wide = spark.read.option("header", "true").csv(p).select("Date", *named)
    long = R.unpivot_matrix(wide, "Date", named)
    assert long.count() == 3
    q = {r.currency: r.quoted_cells for r in R.quoted_cells(wide, named).collect()}
    assert q == {"USD": 2, "JPY": 1}


def test_gated_write_refuses_failing_files(spark):
    d = tempfile.mkdtemp(prefix="sb-gate-")
    df = spark.createDataFrame([("f1", "A"), ("f1", None), ("f2", "B")], "source_file string, isin string")
    refused = FS.gated_write(df, [df.filter(F.col("isin").isNull())], os.path.join(d, "out"), file_col="source_file")
    assert [r.source_file for r in refused.collect()] == ["f1"]
    back = spark.read.parquet(os.path.join(d, "out"))
    assert [r.isin for r in back.collect()] == ["B"]


def test_incremental_partition_replace_is_idempotent(spark):
    d = tempfile.mkdtemp(prefix="sb-inc-")
    target = os.path.join(d, "prices")
    day = dt.date
    src = spark.createDataFrame([("A", day(2026, 7, 1), 1.0), ("A", day(2026, 7, 2), 2.0)],
                                "isin string, business_date date, price double")
    write_partitions(src, target)
    fp1 = FS.fingerprint(spark.read.parquet(target)).first()
    write_partitions(src.filter(F.col("business_date") == day(2026, 7, 2)), target)
    fp2 = FS.fingerprint(spark.read.parquet(target)).first()
    assert fp1 == fp2
    nxt = spark.createDataFrame([("A", day(2026, 7, 2), 9.0), ("A", day(2026, 7, 3), 3.0)], src.schema)
    inc = increment(nxt, spark.read.parquet(target))
    assert [r.business_date for r in inc.collect()] == [day(2026, 7, 3)]


def test_price_stream_available_now(spark):
    d = tempfile.mkdtemp(prefix="sb-stream-")
    src, target = os.path.join(d, "in"), os.path.join(d, "out")
    schema = "isin string, business_date date, price double"
    day = dt.date
    spark.createDataFrame([("A", day(2026, 7, 1), 1.0)], schema).write.parquet(os.path.join(src, "b1"))
    spark.createDataFrame([("A", day(2026, 7, 2), 2.0)], schema).write.parquet(os.path.join(src, "b2"))
    st = spark.createDataFrame([], schema).schema
    load_prices_stream(spark, os.path.join(src, "*"), st, target, name=os.path.basename(d))
    assert spark.read.parquet(target).count() == 2


def test_fingerprint_detects_change(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, None), (1, "x")], "k int, v string")
    c = spark.createDataFrame([(1, "x"), (2, "")], "k int, v string")
    fa, fb, fc = (FS.fingerprint(x).first() for x in (a, b, c))
    assert fa == fb and fa != fc
