"""Readers for published reference files: register XML (full and delta),
projected CSV, wide rate matrices, plus file-name metadata and lineage.

All raw columns are strings with a declared schema (never inferred); a
declared column missing from a file is a schema-drift error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbook.functions.text import is_blank
from sparkbook.sources.xml_records import read_records

# Delta record types = the name of the record's single child.
DELTA_TYPES = {"NewRcrd": "NEW", "ModfdRcrd": "MODFD", "TermntdRcrd": "TERMNTD", "CancRcrd": "CANC"}


def file_meta(df: DataFrame, pattern: str, groups: dict[str, int], strict: bool = True) -> DataFrame:
    """Columns from the source file name (e.g. publication date); a file
    whose name does not match fails the job when ``strict``."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"([^/]+)$", 1)
    out = df.withColumn("source_file", name)
    for col, g in groups.items():
        v = F.regexp_extract(name, pattern, g)
        if strict:
            v = F.when(v == "", F.raise_error(F.concat(F.lit("unexpected file name: "), name))).otherwise(v)
        out = out.withColumn(col, v)
    return out


def add_lineage(df: DataFrame, publication_date: Column | str | None = None, ingested_at=None) -> DataFrame:
    out = df
    if "source_file" not in out.columns:
        out = out.withColumn("source_file", F.regexp_extract(F.col("_metadata.file_name"), r"([^/]+)$", 1))
    if publication_date is not None:
        out = out.withColumn("publication_date", F.lit(publication_date) if isinstance(publication_date, str) else publication_date)
    return out.withColumn("ingested_at", F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp())


def read_xml(spark: SparkSession, paths: str | Sequence[str], row_tag: str, schema: T.StructType) -> DataFrame:
    """XML records under ``row_tag`` with a declared schema; namespace
    prefixes are ignored so prefixed and default-namespace files read alike."""
    r = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", "true").schema(schema)
    return r.load(paths if isinstance(paths, str) else list(paths))


def read_register(spark: SparkSession, paths, row_tag: str, schema: T.StructType, mapping: dict[str, str]) -> DataFrame:
    """One row per record with path-mapped string columns (``mapping`` is
    target -> dotted struct path) plus the file name and document order."""
    raw = read_records(spark, paths, row_tag, schema)
    return raw.select(*[F.col(f"record.{path}").cast("string").alias(target) for target, path in mapping.items()], "source_file", "record_sequence")


def delta_type(record: str = "r") -> Column:
    """Change type = name of the one non-null child struct; 0 or >1 fails."""
    present = [F.col(f"{record}.{k}").isNotNull().cast("int") for k in DELTA_TYPES]
    n = present[0]
    for p in present[1:]:
        n = n + p
    kind = F.lit(None).cast("string")
    for k, v in reversed(list(DELTA_TYPES.items())):
        kind = F.when(F.col(f"{record}.{k}").isNotNull(), F.lit(v)).otherwise(kind)
    return F.when(n == 1, kind).otherwise(F.raise_error(F.lit("delta record without exactly one change type")))


def explode_children(df: DataFrame, parent_keys: Sequence[str], branches: Sequence[tuple[str, Column]]) -> DataFrame:
    """Child table with a 1-based ordinal in fixed branch order.

    ``branches`` is an ordered list of (child type, array<struct<id, name>>)
    columns; empty or null branches contribute nothing.
    """
    def tagger(kind: str):
        def tag(x: Column) -> Column:
            return F.struct(F.lit(kind).alias("underlying_type"), x["id"].alias("underlying_id"),
                            x["name"].alias("underlying_name"))
        return tag

    parts = [F.transform(F.coalesce(arr, F.array()), tagger(t)) for t, arr in branches]
    allc = F.concat(*parts)
    x = df.select(*parent_keys, F.posexplode(allc).alias("__pos", "__c"))
    return x.select(*parent_keys, "__c.*", (F.col("__pos") + 1).cast("int").alias("ordinal"))


def read_csv_projected(spark: SparkSession, path: str, mapping: dict[str, str]) -> DataFrame:
    """CSV with a header, all strings, projected and renamed by ``mapping``
    (source header -> target). The literal 'NULL' is data, not null."""
    df = spark.read.option("header", "true").option("inferSchema", "false").option("nullValue", "\u0000").csv(path)
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"schema drift, missing columns: {missing}")
    return df.select(*[F.col(f"`{s}`").alias(t) for s, t in mapping.items()])


def pick_slot(slots: Sequence[dict[str, str]], type_col: str, wanted: str, fields: Sequence[str]) -> Column:
    """First numbered slot whose type equals ``wanted`` (null types never
    match), as a struct so the slot's fields stay together."""
    out = F.lit(None).cast(T.StructType([T.StructField(f, T.StringType()) for f in fields]))
    for s in reversed(list(slots)):
        out = F.when(F.col(s[type_col]) == wanted, F.struct(*[F.col(s[f]).cast("string").alias(f) for f in fields])).otherwise(out)
    return out


def unpivot_matrix(wide: DataFrame, id_col: str, value_cols: Sequence[str], var: str = "currency",
                   val: str = "fx_rate") -> DataFrame:
    """Wide matrix -> long (id, var, value), dropping null / '' / 'N/A'."""
    long = wide.unpivot([id_col], list(value_cols), var, val)
    return long.filter(~is_blank(val))


def quoted_cells(wide: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    """Non-blank cells per column of the wide matrix (one pass)."""
    agg = wide.agg(*[F.count_if(~is_blank(c)).cast("bigint").alias(c) for c in value_cols])
    return agg.unpivot([], list(value_cols), "currency", "quoted_cells")


def named_columns(spark: SparkSession, path: str) -> list[str]:
    """Header cells of a CSV file, read as data, so unnamed (empty) trailing
    columns can be told apart from named ones."""
    head = spark.read.text(path).limit(1).first()
    return [] if head is None else [c.strip() for c in head[0].split(",")]
