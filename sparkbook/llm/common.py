"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words in every contract: space and U+0009 to U+000D.
#: bytes.split() without arguments cuts at exactly these, bytes.lower() lower-cases A-Z only.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows per Arrow batch: texts can be long, so batches are kept small.
ARROW_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; the cluster names it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
    return root.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame under the shared folder and read it back.

    The written table has no lineage, so a lost executor costs the tasks it
    ran and never the plan that made the table. Each call has a folder of its
    own: nothing is overwritten while something else reads it.
    """
    path = f"{shared_root(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table made by saved() that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    ours = path(f"{shared_root(spark)}/llm").toUri().getPath()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        at = path(folder)
        if at.toUri().getPath().startswith(f"{ours}/"):
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark deletes a query's shuffle files when the query ends: for steps that are each run once and saved()."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def row_key(*cols: Column) -> Column:
    """128 bits that name a row by its content; rows repeated in full share it."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit("row"), *reversed(cols)).alias("b"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_share(h: Column, wanted: int, size: Column) -> Column:
    """Whether a row's hash is among the lowest: about four times ``wanted`` of ``size`` rows pass, whatever the size."""
    return F.pmod(h, F.lit(1 << 40)) / F.lit(float(1 << 40)) * size < 4.0 * wanted


def hash_sample(df: DataFrame, rows: int, *cols: str) -> DataFrame:
    """The ``rows`` rows of lowest hash (column ``h``) over ``cols``, for bounded training samples.

    Ranking sees only the rows that hash_share() lets pass, so the one task that
    takes the lowest reads a bounded number however many tasks there are.
    """
    size = df.agg(F.count("*")).scalar()
    return df.withColumn("h", F.xxhash64(*cols)).filter(hash_share(F.col("h"), rows, size)).orderBy("h", *cols).limit(rows)
