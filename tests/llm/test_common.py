import pytest
from pyspark.sql import functions as F

from sparkbook.llm.common import dropped, hash_sample, row_key, saved, shared_root

from .data import frame, rows


@pytest.mark.parametrize(("size", "wanted"), [(5000, 40), (30, 40), (0, 5)])
def test_hash_sample_is_the_lowest_hashes(spark, size, wanted):
    df = spark.range(size).withColumn("v", F.col("id") % 7)
    every = sorted((r.h, r.id) for r in df.withColumn("h", F.xxhash64("id")).collect())
    got = sorted((r.h, r.id) for r in hash_sample(df, wanted, "id").collect())
    # of the rows whose hash share is lowest; with few rows, all of them
    assert len(got) == min(size, wanted) and set(got) <= set(every)
    assert got == sorted((r.h, r.id) for r in hash_sample(df.repartition(5), wanted, "id").collect())


def test_saved_tables_are_new_each_time_and_can_be_dropped(spark):
    a, b = saved(spark.range(3).toDF("x"), "t"), saved(spark.range(4).toDF("x"), "t")
    assert (a.count(), b.count()) == (3, 4)
    assert set(a.inputFiles()).isdisjoint(b.inputFiles())
    dropped(a)
    assert b.count() == 4
    with pytest.raises(Exception):  # noqa: B017
        a.count()


def test_row_key_names_content(spark):
    data = rows()
    keyed = frame(spark, data).select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("k"))
    assert keyed.select("k").distinct().count() == len({(r[0], r[1]) for r in data})


def test_unset_shared_folder_is_an_error():
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())
