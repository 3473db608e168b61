"""Incremental price loading as a file-source stream.

New price files landing in a folder are picked up with
``trigger(availableNow=True)``. A day may be spread over several files and
batches, so each batch rebuilds the days it touches, and of rows with one key
the file that came last wins. Re-delivery is therefore idempotent and a second
file of a day adds to the first.

Which files hold a day is kept beside the target (``_file_days``, one row per
file and day): a batch reads the files of its own days and no others, however
long the history is. A batch writes its own part of that index before the
prices, so a batch that is run again replaces it. The stream's checkpoint
lives under the shared checkpoint root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkbook.session import checkpoint_root
from sparkbook.sources.incremental import write_partitions

FILE = "__file"


def file_index(target: str) -> str:
    return f"{target}/_file_days"


def index_batch(batch: DataFrame, target: str, name: str, batch_id: int, date_col: str) -> DataFrame:
    """Record which days the batch's files hold; returns (file, day) of the batch."""
    part = f"{file_index(target)}/stream={name}/batch={batch_id}"
    batch.select(F.col(FILE).alias("file"), F.col(date_col).alias("day")).distinct().write.mode("overwrite").parquet(part)
    return batch.sparkSession.read.parquet(part)


def files_of_days(spark: SparkSession, target: str, days: DataFrame) -> list[str]:
    """Paths of all files seen so far that hold one of ``days`` (column day): a listing, as Spark keeps one of any read."""
    index = spark.read.parquet(file_index(target)).select("file", "day")
    return sorted(r[0] for r in index.join(days.select("day").distinct(), "day", "left_semi").select("file").distinct().collect())


def days_from_files(spark: SparkSession, files: Sequence[str], schema: StructType, days: DataFrame, date_col: str, keys: Sequence[str]) -> DataFrame:
    """All rows of these files for the given days (column day), the latest file's row of each key."""
    cols = [f.name for f in schema]
    rows = spark.read.schema(schema).parquet(*files).select(
        *cols, F.col("_metadata.file_modification_time").alias("__at"), F.col("_metadata.file_name").alias("__name"))
    rows = rows.join(days.select(F.col("day").alias(date_col)).distinct(), date_col, "left_semi")
    rest = [c for c in cols if c not in (date_col, *keys)]
    latest = F.max_by(F.struct(*rest), F.struct("__at", "__name")).alias("__r")
    return rows.groupBy(date_col, *keys).agg(latest).select(date_col, *keys, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*cols)


def load_prices_stream(spark: SparkSession, source_dir: str, schema: StructType, target: str,
                       name: str = "prices_stream", date_col: str = "business_date", keys: Sequence[str] = ("isin",)) -> None:
    """Load what has landed since the last call; ``name`` is the stream's own, one target may take several."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        days = index_batch(batch, target, name, batch_id, date_col)
        files = files_of_days(session, target, days)
        if files:
            write_partitions(days_from_files(session, files, schema, days, date_col, keys), target, date_col)

    rows = spark.readStream.schema(schema).parquet(source_dir).withColumn(FILE, F.col("_metadata.file_path"))
    q = (rows.writeStream.foreachBatch(upsert).option("checkpointLocation", f"{checkpoint_root(spark)}/streams/{name}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
