"""Line dedup with overlapping windows of three lines.

Every window of ``width`` consecutive lines is hashed; a window that occurs
more than once anywhere keeps its first occurrence (smallest document, then
smallest position), and the lines that later occurrences cover are removed.
Overlapping windows cover a long passage as one stretch. Lines are compared
without the white space at their ends, and lines of white space only do not
count: they go with the stretch around them.

Windows are grouped by a 128-bit hash with map-side minima, so a window that a
third of all documents hold costs one partial row per task; only windows found
twice or more are joined back, and that join is split where it is skewed.
Texts move once, together with the stretches to remove from them.

Defined cases: null text stays null and has no lines; a text of fewer lines
than a window is never changed; where a window overlaps its own repeat (one
line over and over), the repeat's lines go; rows repeated in full count as one
occurrence and are treated alike; null doc_ids sort first; an empty table
gives no rows; other columns pass through ``dedup_lines``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbook.llm.common import row_key, saved, small_batches

WIDTH = 3
WHITE = " \t\n\v\f\r"


def line_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per window: its hash, its document and the raw line numbers [first, past) that it covers."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            out: list[tuple] = []
            ids, a, b = (batch.column(k).to_pylist() for k in (0, 2, 3))
            for k, text in enumerate(batch.column(1)):
                lines = [(n, x) for n, line in enumerate((text.as_py() or "").split("\n")) if (x := line.strip(WHITE))]
                for i in range(len(lines) - width + 1):
                    digest = xxh3_128_digest("\n".join(x for _, x in lines[i : i + width]).encode("utf-8", "surrogatepass"))
                    out.append((digest, ids[k], a[k], b[k], lines[i][0], lines[i + width - 1][0] + 1))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["window", "doc_id", "a", "b", "first", "past"])

    small_batches(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    return keyed.select("doc_id", "text", "key.a", "key.b").mapInArrow(of, "window binary, doc_id long, a long, b long, first int, past int")


def later_occurrences(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(a, b, stretches): for each document that repeats a window seen before, the line ranges to remove."""
    windows = saved(line_windows(docs, width), "windows")
    at = F.struct("doc_id", "a", "b", "first")
    first = windows.groupBy("window").agg(F.min(at).alias("kept"), F.count("*").alias("n")).filter("n > 1").select(F.col("window").alias("repeated"), "kept")
    later = windows.join(first, F.col("window") == F.col("repeated")).filter(~at.eqNullSafe(F.col("kept")))
    return later.groupBy("a", "b").agg(F.collect_set(F.struct("first", "past")).alias("stretches"))


def merged(stretches: list) -> list[tuple[int, int]]:
    """Union of line ranges, in order."""
    out: list[list[int]] = []
    for first, past in sorted((s["first"], s["past"]) for s in stretches):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], past)
        else:
            out.append([first, past])
    return [(a, b) for a, b in out]


CUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("removed_lines", T.LongType()), T.StructField("removed", T.StringType())])


@F.pandas_udf(CUT)
def cut_lines(texts: pd.Series, stretches: pd.Series) -> pd.DataFrame:
    out = []
    for text, own in zip(texts, stretches, strict=True):
        if text is None or own is None:
            out.append((text, 0, ""))
            continue
        lines, parts, at = text.split("\n"), [], 0
        ranges = merged(own)
        for a, b in ranges:
            parts += lines[at:a]
            at = b
        out.append(("\n".join(parts + lines[at:]), sum(b - a for a, b in ranges), ",".join(f"{a}:{b}" for a, b in ranges)))
    return pd.DataFrame(out, columns=["text", "removed_lines", "removed"])


def with_cuts(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(row, cut): the document as it was and what is left of it (text, removed_lines, removed as first:past of raw lines)."""
    later = later_occurrences(docs, width).select(F.col("a").alias("of_a"), F.col("b").alias("of_b"), "stretches")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"))
    joined = row.join(later, (F.col("key.a") == F.col("of_a")) & (F.col("key.b") == F.col("of_b")), "left")
    return joined.select("row", cut_lines(F.col("row.text").cast("string"), "stretches").alias("cut"))


def line_report(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_lines, removed_lines, removed, text) per document; text is what is left."""
    lines = F.coalesce(F.size(F.split(F.col("row.text"), "\n", -1)), F.lit(0)).cast("long")
    return with_cuts(docs.select("doc_id", "text"), width).select("row.doc_id", lines.alias("n_lines"), "cut.removed_lines", "cut.removed", "cut.text")


def dedup_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with later occurrences removed from ``text``; ``n_chars`` follows it, other columns stay as they were."""
    cut = with_cuts(docs, width)
    kinds = dict(docs.dtypes)
    new = {"text": F.col("cut.text"), "n_chars": F.length("cut.text").cast(kinds.get("n_chars", "long"))}
    return cut.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


#: DuckDB SQL for line_report() over the table documents with unique doc_id.
SQL = r"""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as n
  from documents where text is not null
),
c as (
  select doc_id, n, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line from l
  where trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''
),
w as (
  select doc_id, n as first, lead(n, 2) over p + 1 as past, line || chr(10) || lead(line) over p || chr(10) || lead(line, 2) over p as three
  from c window p as (partition by doc_id order by n)
),
f as (select doc_id, first, past, row_number() over (partition by three order by doc_id nulls first, first) as nth from w where three is not null),
g as (select distinct l.doc_id, l.n from l join f on l.doc_id = f.doc_id and f.nth > 1 and l.n >= f.first and l.n < f.past),
s as (select doc_id, min(n) as a, max(n) + 1 as b, count(*) as k from (select doc_id, n, n - row_number() over (partition by doc_id order by n) as grp from g) group by doc_id, grp),
r as (select doc_id, sum(k)::bigint as removed_lines, string_agg(a || ':' || b, ',' order by a) as removed from s group by doc_id),
t as (select l.doc_id, string_agg(l.line, chr(10) order by l.n) as text from l anti join g on l.doc_id = g.doc_id and l.n = g.n group by l.doc_id)
select d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines, coalesce(r.removed_lines, 0)::bigint as removed_lines, coalesce(r.removed, '') as removed,
       case when d.text is null then null else coalesce(t.text, '') end as text
from documents d left join r on d.doc_id = r.doc_id left join t on d.doc_id = t.doc_id
"""
