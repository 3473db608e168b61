"""Exact dedup by content sort.

Texts are normalised (A-Z lower-cased, nothing else) and range-partitioned by
splitters that Spark samples; an external sort inside each partition puts
equals side by side, and neighbours are compared in full. The sort key starts
with the leading bytes and a hash of the normalised text, then the text
itself: equal texts are adjacent, and the sampled splitters stay small however
long the texts are. The row id closes the key, so a text that a third of all
rows share is spread over many partitions like any other range.

A run of equals that touches an end of its partition may go on in the next, so
each partition hands on its first and last run with the whole text; equal ones
(two per partition at most) are merged by a grouped full comparison.

Defined cases: null counts as empty, and all empty texts are equal; rows
repeated in full are members of one group and each gets its row; a null
doc_id is kept only if its group has no other; empty table: no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbook.llm.common import saved, shuffle_partitions, small_batches

LEADING = 24
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sorted_runs(docs: DataFrame) -> DataFrame:
    """One row per document: (doc_id, text_sha256, part, run, edge); ``edge`` holds the text on the first row of a run at a partition's end."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER).alias("norm"))
    rows = rows.select("doc_id", "norm", F.substring("norm", 1, LEADING).alias("lead"), F.xxhash64("norm").alias("h"))
    dealt = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "lead", "h", "doc_id").sortWithinPartitions("lead", "h", "norm", "doc_id")
    dealt = dealt.select("doc_id", "norm", F.sha2("norm", 256).alias("sha"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, last, first_text = TaskContext.get().partitionId(), -1, None, None
        for batch in batches:
            ids, norm, sha = batch.columns
            if not len(norm):
                continue
            same = pc.fill_null(pc.equal(norm, pa.concat_arrays([pa.array([last], norm.type), norm.slice(0, len(norm) - 1)])), False)
            new = pc.invert(same).cast(pa.int64())
            run_of = pc.add(pc.cumulative_sum(new), run)
            if first_text is None:
                first_text = norm[0].as_py()
            edge = pa.array([first_text if r.as_py() == 0 and n.as_py() else None for r, n in zip(run_of, new, strict=True)] if run <= 0 else [None] * len(norm), pa.string())
            run, last = run_of[-1].as_py(), norm[-1].as_py()
            yield pa.RecordBatch.from_arrays([ids, sha, pa.array([part] * len(ids), pa.int32()), run_of, edge], names=["doc_id", "text_sha256", "part", "run", "edge"])
        if run > 0:
            # The last run's text is known only now; a row without a document carries it.
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.array([part], pa.int32()), pa.array([run], pa.int64()), pa.array([last], pa.string())], names=["doc_id", "text_sha256", "part", "run", "edge"])

    small_batches(docs.sparkSession)
    return dealt.mapInArrow(runs, "doc_id long, text_sha256 string, part int, run long, edge string")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) per document; of equal texts the largest doc_id stays."""
    marked = saved(sorted_runs(docs), "runs")
    members = marked.filter("text_sha256 is not null")
    tally = [F.count("text_sha256").alias("group_size"), F.max("doc_id").alias("keep_id")]
    runs = marked.groupBy("part", "run").agg(*tally, F.max("edge").alias("edge"))
    merged = runs.filter("edge is not null").groupBy("edge").agg(F.sum("group_size").alias("group_size"), F.max("keep_id").alias("keep_id"), F.collect_list(F.struct("part", "run")).alias("runs"))
    ends = merged.select(F.explode("runs").alias("at"), "group_size", "keep_id").select("at.part", "at.run", "group_size", "keep_id")
    groups = runs.filter("edge is null").select("part", "run", "group_size", "keep_id").union(ends)
    groups = groups.select(F.col("part").alias("in_part"), F.col("run").alias("in_run"), "group_size", "keep_id")
    joined = members.join(groups, (F.col("part") == F.col("in_part")) & (F.col("run") == F.col("in_run")))
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


#: DuckDB SQL for exact_duplicates() over the table documents.
SQL = f"""
with d as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as norm from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, sha256(norm) as text_sha256
from d window w as (partition by norm)
"""
