"""Large register files cut at record ends: same rows as the XML source, several tasks a file."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbook.sources import instruments as I
from sparkbook.sources import registers as R
from sparkbook.sources import xml_records as X

from .test_instruments import GOOD, delta_file

SCHEMA = T.StructType([T.StructField("Id", T.StringType()), T.StructField("N", T.StructType([T.StructField("V", T.ArrayType(T.StringType()))]))])


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def document(n, seed, prefix="", attributes=False, gap="\n  "):
    """``n`` records of very different lengths."""
    rng = random.Random(seed)
    p = prefix and prefix + ":"
    rows = []
    for i in range(n):
        vs = "".join(f"<{p}V>{'é&amp;' * rng.choice([1, 3, 300])}{k}</{p}V>" for k in range(rng.randint(0, 3)))
        rows.append(f"<{p}Rec{f' no={chr(34)}{i}{chr(34)}' if attributes and i % 2 == 0 else ''}>{gap}<{p}Id>r{i}</{p}Id><{p}N>{vs}</{p}N></{p}Rec>{gap}")
    ns = f" xmlns:{prefix}='urn:x'" if prefix else " xmlns='urn:x'"
    return f"<?xml version='1.0'?><{p}Doc{ns}><{p}Head><{p}Period><{p}Dt>2026-07-18</{p}Dt></{p}Period></{p}Head>{gap}{''.join(rows)}</{p}Doc>"


@pytest.mark.parametrize(("prefix", "attributes", "gap"), [("", False, ""), ("f", False, "\n  "), ("", True, "\n"), ("ns.1-a", True, "")])
def test_same_records_as_the_xml_source_from_several_tasks(spark, tmp_path, small_splits, prefix, attributes, gap):
    sizes = {"a.xml": 120, "b.xml": 1, "c.xml": 0, "d.xml": 40}
    for k, (name, n) in enumerate(sizes.items()):
        (tmp_path / name).write_text(document(n, k, prefix, attributes, gap), encoding="utf-8")
    got = X.read_records(spark, str(tmp_path), "Rec", SCHEMA)
    rows = [(r.source_file, r.record_sequence, r.record.Id, r.record.N.V if r.record.N else None) for r in got.collect()]
    theirs = R.read_xml(spark, str(tmp_path), "Rec", SCHEMA).select(F.col("_metadata.file_name").alias("f"), "Id", "N").collect()
    want = [(r.f, int(r.Id[1:]) + 1, r.Id, r.N.V if r.N else None) for r in theirs]
    assert sorted(rows, key=str) == sorted(want, key=str) and len(rows) == 161
    tasks = got.filter("source_file = 'a.xml'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 5
    heads = X.header_values(spark, str(tmp_path), "Rec", "Period", "Dt").collect()
    assert sorted((r.source_file, r.value) for r in heads) == [(f, "2026-07-18") for f in sizes]


def test_one_split_gives_the_same_numbers(spark, tmp_path, small_splits):
    path = tmp_path / "a.xml"
    path.write_text(document(90, 7), encoding="utf-8")
    many = X.read_records(spark, str(path), "Rec", SCHEMA)
    parts = many.rdd.getNumPartitions()
    numbers = sorted((r.record.Id, r.record_sequence) for r in many.collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")
    one = X.read_records(spark, str(path), "Rec", SCHEMA)
    assert parts > 5 and one.rdd.getNumPartitions() == 1
    assert sorted((r.record.Id, r.record_sequence) for r in one.collect()) == numbers


def test_deltas_of_a_large_file(spark, tmp_path, small_splits):
    delta_file(tmp_path, "DLTINS_20260718_01of02.xml", GOOD * 40)
    delta_file(tmp_path, "DLTINS_20260719_02of02.xml", GOOD, date="2026-07-19")
    got = I.read_deltas(spark, str(tmp_path))
    rows = got.select("source_file", "record_sequence", "record_type", "isin", "reporting_date").orderBy("source_file", "record_sequence").collect()
    kinds = ["NEW", "MODFD", "TERMNTD", "CANC"]
    assert [(r.record_sequence, r.record_type, r.reporting_date) for r in rows] == [(i + 1, kinds[i % 4], "2026-07-18") for i in range(160)] + [(i + 1, kinds[i], "2026-07-19") for i in range(4)]
    assert I.delta_rules(got, I.underlyings(got)).count() == 0


def test_a_record_that_does_not_parse_has_null_fields(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<Doc><Rec><Id>1</Id></Rec><Rec><Id>2</Rec><Rec></Rec><Rec/><Rec><Id>3</Id></Rec></Doc>")
    got = X.read_records(spark, str(tmp_path), "Rec", SCHEMA).orderBy("record_sequence").collect()
    assert [(r.record_sequence, r.record.Id if r.record else None) for r in got] == [(1, "1"), (2, None), (3, None), (4, "3")]
