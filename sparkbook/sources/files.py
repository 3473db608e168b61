"""File-set logic on listing DataFrames and table-level write/verify sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field separator and null marker of the content fingerprint.
FIELD_SEP = "\x1f"
NULL_MARK = "N"


def latest_set(listing: DataFrame, stamp_col: str = "publication_date") -> DataFrame:
    """Files of the newest publication (semi-join on the max stamp)."""
    newest = listing.agg(F.max(stamp_col).alias(stamp_col))
    return listing.join(newest, stamp_col, "left_semi")


def sets_in_range(listing: DataFrame, since: str, until: str, stamp_col: str = "publication_date") -> DataFrame:
    """Files published in [since, until]."""
    return listing.filter(F.col(stamp_col).between(F.to_date(F.lit(since)), F.to_date(F.lit(until))))


def resume_plan(listing: DataFrame, watermark: str, stamp_col: str = "publication_date") -> DataFrame:
    """One row: the watermark held, the day the chain needs next, the
    earliest listed publication after the watermark, and whether that leaves
    an unhealable hole (earliest listed is later than the day needed)."""
    wm = F.to_date(F.lit(watermark))
    after = listing.filter(F.col(stamp_col) > wm)
    agg = after.agg(F.min(stamp_col).alias("earliest_listed"), F.count(F.lit(1)).alias("files_to_fetch"))
    return agg.select(
        wm.alias("watermark"), F.date_add(wm, 1).alias("next_needed"), "earliest_listed", "files_to_fetch",
        F.coalesce(F.col("earliest_listed") > F.date_add(wm, 1), F.lit(False)).alias("is_gap"),
    )


def require_no_gap(plan: DataFrame) -> None:
    """Refuse a chain whose next needed day is no longer listed: a later delta cannot be applied over a hole."""
    row = plan.first()
    if row is not None and row["is_gap"]:
        raise ValueError(f"publications from {row['next_needed']} on are needed, the earliest listed is {row['earliest_listed']}: take a new base")


def framed(cols: Sequence[str]) -> Column:
    """A row as one string from which its fields can be told apart: each is
    preceded by its length, and a null by a mark that no length can be."""
    parts = []
    for c in cols:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK)))
    return F.concat_ws(FIELD_SEP, *parts)


def _summed(halves: DataFrame, *by: str) -> DataFrame:
    """Row count and the two sums mod 2^64 of the halves __a and __b, as text."""
    two64 = F.lit(Decimal(2**64))
    g = halves.groupBy(*by).agg(F.sum("__n").alias("n_rows"), F.sum("__a").alias("__sa"), F.sum("__b").alias("__sb"))
    total = lambda c: F.pmod(F.coalesce(c, F.lit(Decimal(0)).cast("decimal(38,0)")), two64).cast("decimal(20,0)").cast("string")
    return g.select(*by, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), total(F.col("__sa")).alias("fp_a"), total(F.col("__sb")).alias("fp_b"))


def _halves(df: DataFrame, cols: Sequence[str], *more: Column) -> DataFrame:
    h = F.sha2(framed(cols), 256)
    two = [F.conv(F.substring(h, at, 16), 16, 10).cast("decimal(28,0)").alias(n) for at, n in ((1, "__a"), (17, "__b"))]
    return df.select(*more, F.lit(1).cast("long").alias("__n"), *two)


def fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Order-insensitive content fingerprint: row count plus two 64-bit sums
    (mod 2^64) of per-row sha256 slices over the framed values.

    A commutative aggregate, so it combines map-side and never gathers the
    rows or their hashes; any changed, added or removed row changes it. Sums
    are kept in decimals wide enough for 10^18 rows.
    """
    return _summed(_halves(df, list(cols or df.columns)))


def fingerprint_tree(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None, depth: int = 3) -> DataFrame:
    """(level, prefix, n_rows, fp_a, fp_b): fingerprints of a table and of its buckets, from the whole (level 0) down.

    A row's bucket is the first ``depth`` hex digits of its key's hash, so a level
    has 16 times the buckets of the one above, and a bucket's fingerprint is
    the sum of its children's: the table is read once, the levels above come
    from 16^depth rows. Trees of one key, columns and depth are compared with
    ``differing_buckets`` without reading the tables again.
    """
    prefix = F.substring(F.sha2(framed(list(keys)), 256), 1, depth).alias("__prefix")
    leaves = _halves(df, list(cols or df.columns), prefix).groupBy("__prefix").agg(*[F.sum(c).alias(c) for c in ("__n", "__a", "__b")])
    two64 = F.lit(Decimal(2**64))
    part = lambda c: F.pmod(F.col(c), two64).cast("decimal(28,0)").alias(c)
    levels = leaves.select("__prefix", "__n", part("__a"), part("__b"), F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
    return _summed(levels.withColumn("prefix", F.expr("substring(__prefix, 1, level)")), "level", "prefix")


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """(level, prefix, left_rows, right_rows) of the buckets in which two fingerprint trees differ; none for equal tables.

    Level 0 tells whether the tables differ, the deepest level where: read on with ``bucket_rows``.
    """
    value = F.struct("n_rows", "fp_a", "fp_b")
    null = F.lit(None).cast("struct<n_rows: bigint, fp_a: string, fp_b: string>")
    both = left.select("level", "prefix", value.alias("l"), null.alias("r")).unionByName(right.select("level", "prefix", null.alias("l"), value.alias("r")))
    met = both.groupBy("level", "prefix").agg(F.max("l").alias("l"), F.max("r").alias("r")).filter(~F.col("l").eqNullSafe(F.col("r")))
    rows = lambda side: F.coalesce(F.col(f"{side}.n_rows"), F.lit(0)).cast("long")
    return met.select("level", "prefix", rows("l").alias("left_rows"), rows("r").alias("right_rows"))


def bucket_rows(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """The rows of one bucket of a fingerprint tree."""
    return df.filter(F.sha2(framed(list(keys)), 256).startswith(prefix))


def verify_load(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Load fidelity, one row: row counts, ordered (name, type) lists and contents must agree."""
    kinds = [[(f.name, f.dataType.simpleString()) for f in x.schema] for x in (src, dst)]
    a = fingerprint(src).select(F.col("n_rows").alias("source_rows"), F.concat("fp_a", F.lit("-"), "fp_b").alias("__a"), F.lit(1).alias("__one"))
    b = fingerprint(dst).select(F.col("n_rows").alias("loaded_rows"), F.concat("fp_a", F.lit("-"), "fp_b").alias("__b"), F.lit(1).alias("__one"))
    return a.join(b, "__one").select("source_rows", "loaded_rows", F.lit(kinds[0] == kinds[1]).alias("schema_equal"),
                                     (F.col("__a") == F.col("__b")).alias("content_equal"))


def gated_write(df: DataFrame, fatal_checks: Sequence[DataFrame], path: str, order: Sequence[str] | None = None,
                file_col: str | None = None) -> DataFrame | None:
    """Write ``df`` only where no fatal check fires.

    Without ``file_col`` the whole write is refused on any violation. With it,
    the gate is per source file and the table is replaced: a file with a
    violation has no rows in it afterwards, not even those of an earlier load.
    Returns the refused file names as a frame (None without ``file_col``).
    """
    rows = df.select(*order) if order else df
    if file_col is None:
        for c in fatal_checks:
            if c.limit(1).count() > 0:
                raise ValueError("fatal check failed; nothing written")
        replace_table(rows, path)
        return None
    refused = reduce(DataFrame.unionByName, [c.select(file_col) for c in fatal_checks]).distinct() if fatal_checks else df.select(file_col).limit(0)
    replace_table(rows.join(refused, file_col, "left_anti"), path, [file_col])
    return refused


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), options: dict[str, str] | None = None) -> None:
    """Replace the whole table at ``path``: partitions absent from ``df`` go too, whatever the session's overwrite mode."""
    df.write.mode("overwrite").options(**(options or {})).option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def write_clustered(df: DataFrame, path: str, partition_by: str | None, cluster_by: Sequence[str], files_per_partition: int = 1,
                    bloom: Sequence[str] = (), row_group_bytes: int | None = None) -> None:
    """Replace a table laid out for point lookups: one folder per value of
    ``partition_by`` (none: one folder), rows range-clustered on ``cluster_by``
    inside, so that file, row-group and page statistics prune an equality on
    them. A large folder is dealt over ``files_per_partition`` ranges or more;
    none is one task's work.

    ``bloom``: columns that are looked up but not clustered on, such as a
    hashed version key: each row group keeps a Bloom filter of their values, and a
    lookup skips the groups that cannot hold its value. Smaller row groups
    (``row_group_bytes``) skip more and cost more footer.
    """
    n = max(files_per_partition, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    folders = [partition_by] if partition_by else []
    keys = [*folders, *cluster_by]
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom}
    if bloom:
        # Of sizes from 512 bytes to one MB, each row group keeps the one that its values need.
        options["parquet.bloom.filter.adaptive.enabled"] = "true"
        options |= {f"parquet.bloom.filter.candidates.number#{c}": "12" for c in bloom}
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
    replace_table(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys), path, folders, options)


def bytes_read(df: DataFrame) -> tuple[int, list]:
    """The bytes that running ``df`` reads from its files, by the input metrics of its own tasks, and its rows (for lookups: few)."""
    sc, group = df.sparkSession.sparkContext, f"bytes-{uuid.uuid4().hex}"
    sc.setJobGroup(group, group)
    try:
        rows = df.collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    tracker, store = sc.statusTracker(), sc._jsc.sc().statusStore()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    stages = {s for j in jobs if j for s in j.stageIds}
    return sum(store.lastStageAttempt(s).inputBytes() for s in stages), rows


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, fingerprint) per table and a combined row '*' over all names and fingerprints in order. Each table is read once."""
    one = [fingerprint(df).select(F.lit(name).alias("table_name"), "n_rows", F.concat("fp_a", F.lit("-"), "fp_b").alias("fingerprint"))
           for name, df in sorted(tables.items())]
    rows = reduce(DataFrame.unionByName, one)
    # One short line per table of the release: bounded by the number of tables.
    lines = F.array_sort(F.collect_list(F.concat("table_name", F.lit(":"), "fingerprint")))
    both = rows.rollup("table_name").agg(F.sum("n_rows").alias("n_rows"), F.min("fingerprint").alias("__own"), lines.alias("__lines"), F.grouping("table_name").alias("__all"))
    total = F.col("__all") == 1
    return both.select(F.when(total, F.lit("*")).otherwise(F.col("table_name")).alias("table_name"), "n_rows",
                       F.when(total, F.sha2(F.array_join("__lines", "\n"), 256)).otherwise(F.col("__own")).alias("fingerprint"))
