"""A versioned register on disk, upkept day by day.

Rows are stored in buckets of their key. A delivery reads and rewrites the
buckets of its keys alone: events and stored versions meet in one shuffle by
key, and the replay of what it brings closes a key's open version, appends new
ones, ends the last one on a termination, and erases the key's history on a
cancellation; keys without an event come out as they went in. The result is what a full replay of
everything delivered so far gives, whatever the order of delivery.

Erased keys leave a tombstone, since a cancelled key stays erased whatever
comes after. An event delivered again (same key, date, file and sequence) takes
the place of the earlier one, so a delivery can be repeated, for example after
a failure: buckets are replaced in one commit of the write, and until then
the register is as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkbook.operators.temporal import in_base_scope, replay_versions
from sparkbook.session import discard, materialise


@dataclass(frozen=True)
class RegisterStore:
    """``path`` on storage that driver and executors share. ``buckets`` is fixed for the life of the register: some
    hundreds of MB a bucket, so that a delivery of few keys leaves most of them alone."""

    path: str
    keys: Sequence[str] = ("isin", "trading_venue_mic")
    buckets: int = 64
    base_date: str | None = None
    same_day: str = "keep"
    type_col: str = "version_source"
    date_col: str = "effective_date"
    order: Sequence[str] = ("effective_date", "source_file", "record_sequence")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _replayed(self, events: DataFrame, then: Sequence[str] = ()) -> DataFrame:
        out = replay_versions(events, None, self.keys, order=[*self.order, *then], type_col=self.type_col, date_col=self.date_col, same_day=self.same_day)
        return out.withColumn("erased", F.lit(False)).withColumn("bucket", self._bucket())

    def _tombstones(self, keys: DataFrame) -> DataFrame:
        return keys.distinct().withColumn("erased", F.lit(True)).withColumn("bucket", self._bucket())

    def _cancelled(self, events: DataFrame) -> DataFrame:
        return events.filter(F.col(self.type_col) == "CANC").select(*self.keys).dropna()

    def _write(self, rows: DataFrame) -> None:
        # The rows may be read from the buckets they replace: those are swapped when all is written.
        # A bucket above the advisory size is written by several tasks.
        rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)

    def create(self, base: DataFrame) -> None:
        """Start the register from a base snapshot; replaces what stands at ``path``."""
        rows = self._replayed(base).unionByName(self._tombstones(self._cancelled(base)), allowMissingColumns=True)
        rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(self.path)

    def stored(self, spark: SparkSession) -> DataFrame:
        """All rows with ``bucket`` and ``erased``."""
        return spark.read.parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """The register: one row per version."""
        return self.stored(spark).filter(~F.col("erased")).drop("erased", "bucket")

    def apply(self, deltas: DataFrame) -> list[int]:
        """Take in a delivery; returns the buckets that were rewritten."""
        spark = deltas.sparkSession
        scoped = deltas if self.base_date is None else deltas.filter(in_base_scope(self.date_col, self.type_col, self.base_date))
        events = materialise(scoped, "delivery")
        touched = sorted(r[0] for r in events.select(self._bucket()).distinct().collect())  # at most ``buckets`` numbers
        if not touched:
            discard(events)
            return []
        stored = self.stored(spark).filter(F.col("bucket").isin(touched))
        computed = [c for c in self._replayed(events).columns if c not in events.columns]
        past = stored.withColumnsRenamed({"valid_from": self.date_col, "version_no": "__nth"}).drop(*[c for c in computed if c != "erased"])
        # Versions of the delivered keys keep the columns that events have.
        extra = [c for c in past.columns if c not in (*events.columns, "erased", "__nth")]
        both = past.withColumn("__new", F.lit(False)).unionByName(events.withColumns({"__new": F.lit(True), "erased": F.lit(False)}), allowMissingColumns=True)
        key = Window.partitionBy(*self.keys)
        again = Window.partitionBy(*dict.fromkeys([*self.keys, *[c for c in self.order if c in events.columns and c in past.columns]]))
        met = both.withColumns({"__gone": F.max("erased").over(key), "__named": F.max("__new").over(key), "__again": F.max("__new").over(again)})
        live = met.filter(~F.col("__gone") & (F.col("__new") | ~F.col("__again"))).withColumns({c: F.when(~F.col("__named"), F.col(c)) for c in extra})
        # Ties in the order keep the place they have.
        replayed = self._replayed(live.drop("__new", "__gone", "__named", "__again", "erased"), ["__nth"]).drop("__nth")
        tombs = self._tombstones(stored.filter("erased").select(*self.keys).unionByName(self._cancelled(events)))
        self._write(replayed.unionByName(tombs, allowMissingColumns=True))
        discard(events)
        return touched
