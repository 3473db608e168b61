"""Records of large XML files, read by many tasks per file.

Spark's XML source gives a multi-line file to one task. Here the text source
cuts a file at the end of each ``tag>``, which splits like any line-based file,
and ``from_xml`` parses the pieces that close a record. A record's number in its
file comes from its place in its split and the counts of the splits before, one
small row per split; no file is gathered anywhere.

Works for UTF-8 files whose record tags are written ``<tag>`` or ``<tag attributes>``
and ``</tag>``, with or without a namespace prefix; no other element's name may end in
the record's, and a self-closing record holds nothing and is not returned.
Compressed files that do not split are one task each. A record that does not
parse has null fields; an empty file has no records.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = r"(?:[\w.-]+:)?"
CLOSES = rf"</{PREFIX}$"


def _pieces(spark: SparkSession, paths: str | Sequence[str], tag: str) -> DataFrame:
    text = spark.read.option("lineSep", f"{tag}>").text(paths if isinstance(paths, str) else list(paths))
    return text.select("value", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("__split"))


def _opening(tag: str) -> tuple[Column, str]:
    """Whether a piece holds its record's opening tag (one with attributes), and the pattern up to it."""
    tag = rf"<{PREFIX}{re.escape(tag)}\s[^>]*"
    return F.col("value").rlike(tag), rf"(?s)^(.*){tag}>"


def read_records(spark: SparkSession, paths: str | Sequence[str], tag: str, schema: T.StructType) -> DataFrame:
    """(record, source_file, record_sequence): one row per ``tag`` element, numbered from 1 in document order."""
    found = _pieces(spark, paths, tag).filter(F.col("value").rlike(CLOSES)).withColumn("__at", F.monotonically_increasing_id())
    # One row per split; rows of a split have consecutive ids, since a split is read by one task in order.
    splits = found.groupBy("__path", "__split").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__path").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("__path").alias("__p"), F.col("__split").alias("__s"), "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    own, upto = _opening(tag)
    body = F.regexp_replace(F.when(own, F.regexp_replace("value", upto, "")).otherwise(F.col("value")), CLOSES, "")
    parsed = F.from_xml(F.concat(F.lit("<record>"), body, F.lit("</record>")), schema, {"ignoreNamespace": "true"})
    # A row of some 60 bytes per split: 48 MB for 100 TB in splits of 128 MB.
    j = found.join(F.broadcast(splits), (F.col("__path") == F.col("__p")) & (F.col("__split") == F.col("__s")))
    number = (F.col("__at") - F.col("__first") + F.col("__before") + 1).cast("int")
    return j.select(parsed.alias("record"), "source_file", number.alias("record_sequence"))


def header_values(spark: SparkSession, paths: str | Sequence[str], tag: str, parent: str, child: str) -> DataFrame:
    """(source_file, value): the text of each ``child`` directly below a ``parent`` element outside the records. Nothing is parsed as XML."""
    own, upto = _opening(tag)
    closes = F.col("value").rlike(CLOSES)
    outside = F.when(closes & own, F.regexp_extract("value", upto, 1)).when(closes, F.lit("")).otherwise(F.col("value"))
    text = _pieces(spark, paths, tag).select("source_file", outside.alias("text")).filter(F.col("text").contains(parent))
    element = rf"(?s)<{PREFIX}{parent}(?:\s[^>]*)?>\s*<{PREFIX}{child}(?:\s[^>]*)?>([^<]*)</"
    return text.select("source_file", F.explode(F.regexp_extract_all("text", F.lit(element), 1)).alias("value"))
