"""Quality rules with adaptive thresholds from mergeable quantile sketches.

DataFrame functions only. Each document gets exact counts; ratios of them go
into quantile sketches per language and source, and thresholds come from the
sketches' quartiles in place of fixed cutoffs: a document fails when a ratio
lies beyond the quartiles by more than ``SPREAD`` times their distance (and by
more than a least slack, so that groups alike throughout lose nothing).

A sketch is a histogram of integers whose buckets keep the leading eight
bits (a relative error below 1/128), that is, rows of (group, metric, bucket,
count). It merges by adding counts: partial sums are taken before the shuffle, a
source with a third of all rows costs its buckets, and a group of fewer than
``LEAST`` documents takes the merged sketch of its language, or of everything.
Thresholds are joined back by language and source.

Repeats inside a text are found in its own row: windows of three words are
hashed (64 bits), and only texts with equal hashes are sorted to find where.

Defined cases: null text has no words and fails the base rule; null language
and null source are values of their own; repeated rows count as often as they
occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkbook.llm.common import WORD, saved

SYMBOLS = r"[#*$%&|<>]"
SPREAD, LEAST = 3, 100
#: metric: (numerator, denominator, scale, least slack, whether small values fail too)
METRICS = {
    "symbols": ("n_symbols", "word_chars", 1000, 50, False),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 400, False),
    "repeats": ("n_repeat_words", "n_words", 1000, 300, False),
    "word_length": ("word_chars", "n_words", 100, 150, True),
}


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)."""
    d = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    d = d.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    d = d.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    windows = F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    d = d.withColumn("windows", F.coalesce(windows, F.array().cast("array<bigint>")))
    has_repeat = F.size("windows") > F.size(F.array_distinct("windows"))
    d = d.withColumn("placed", F.when(has_repeat, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    found = F.filter("placed", lambda s, k: (s["h"] == F.get("placed", k + 1)["h"]) | ((k > 0) & (s["h"] == F.get("placed", F.greatest(k - 1, F.lit(0)))["h"])))
    at = F.sort_array(F.transform(found, lambda s: s["i"]))
    covered = F.aggregate(
        at, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")), lambda acc: acc["n"],
    )
    return d.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def ratio(metric: str) -> Column:
    over, under, scale, _, _ = METRICS[metric]
    return F.when(F.col(under) > 0, F.expr(f"{over} * {scale} div {under}")).otherwise(0)


def bucket(value: Column) -> Column:
    """The value with all but its leading eight bits cleared."""
    shift = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n) over the rows given."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), bucket(ratio(m).cast("long")).alias("bucket")) for m in METRICS])).alias("v")
    return measured.select("lang", "source", values).groupBy("lang", "source", "v.metric", "v.bucket").agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, docs, q1, q3): quartiles of the merged sketches, one row per group and metric."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys, "metric")
    ranked = merged.withColumn("upto", F.sum("n").over(whole.orderBy("bucket"))).withColumn("docs", F.sum("n").over(whole))
    least = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("docs") * q, F.col("bucket")))
    return ranked.groupBy(*keys, "metric").agg(F.first("docs").alias("docs"), least(1).alias("q1"), least(3).alias("q3"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, low_<metric>, high_<metric>): own sketch, or the language's, or all, whichever has LEAST documents."""
    own = quartiles(sketch, ["lang", "source"])
    by_lang = quartiles(sketch, ["lang"]).select(F.col("lang").alias("l_lang"), F.col("metric").alias("l_metric"), F.col("docs").alias("l_docs"), F.col("q1").alias("l_q1"), F.col("q3").alias("l_q3"))
    of_all = quartiles(sketch, []).select(F.col("metric").alias("a_metric"), F.col("q1").alias("a_q1"), F.col("q3").alias("a_q3"))
    t = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("metric") == F.col("l_metric"))).join(of_all, F.col("metric") == F.col("a_metric"))
    pick = lambda q: F.when(F.col("docs") >= LEAST, F.col(q)).when(F.col("l_docs") >= LEAST, F.col(f"l_{q}")).otherwise(F.col(f"a_{q}"))
    t = t.select("lang", "source", "metric", pick("q1").alias("q1"), pick("q3").alias("q3"))
    slack = reduce(lambda c, m: c.when(F.col("metric") == m, METRICS[m][3]), METRICS, F.when(F.lit(False), 0))
    room = F.greatest(SPREAD * (F.col("q3") - F.col("q1")), slack)
    t = t.withColumn("low", F.col("q1") - room).withColumn("high", F.col("q3") + room)
    ends = [F.max(F.when(F.col("metric") == m, F.col(end))).alias(f"{end}_{m}") for m in METRICS for end in ("low", "high")]
    return t.groupBy("lang", "source").agg(*ends)


def judged(docs: DataFrame) -> DataFrame:
    """The measures of each document with base_failed, kept and the metrics that failed (``reasons``)."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = saved(measures(docs).withColumn("base_failed", base), "measures")
    # Written first, the thresholds have a size that the planner knows: documents need no shuffle by group.
    limits = saved(thresholds(sketches(measured.filter(~F.col("base_failed")))), "limits")
    limits = limits.withColumnRenamed("lang", "t_lang").withColumnRenamed("source", "t_source")
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    fails = {m: (ratio(m) > F.col(f"high_{m}")) | ((ratio(m) < F.col(f"low_{m}")) if METRICS[m][4] else F.lit(False)) for m in METRICS}
    reasons = F.array_compact(F.array(*[F.when(f, F.lit(m)) for m, f in fails.items()]))
    out = joined.withColumn("reasons", F.concat_ws(",", reasons))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("reasons") == "")).drop("t_lang", "t_source", *[f"{e}_{m}" for m in METRICS for e in ("low", "high")])


def quality_report(docs: DataFrame) -> DataFrame:
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reasons")


def _limit(end: str, m: str) -> str:
    slack = METRICS[m][3]
    room = f"greatest({SPREAD} * (q3 - q1), {slack})"
    return f"max(case when metric = '{m}' then {'q1 - ' + room if end == 'low' else 'q3 + ' + room} end) as {end}_{m}"


_VALUES = " union all ".join(
    f"select lang, source, '{m}' as metric, (case when {u} > 0 then {o} * {s} // {u} else 0 end)::bigint as v from b where not base_failed" for m, (o, u, s, _, _) in METRICS.items()
)
_RATIO = {m: f"(case when {u} > 0 then {o} * {s} // {u} else 0 end)" for m, (o, u, s, _, _) in METRICS.items()}
_FAILS = {m: f"({_RATIO[m]} > high_{m}" + (f" or {_RATIO[m]} < low_{m})" if METRICS[m][4] else ")") for m in METRICS}


def _quartile_sql(name: str, keys: list[str]) -> str:
    by = "".join(f"{k}, " for k in keys)
    return f"""{name} as (
  select {by}metric, any_value(docs) as docs, min(case when upto * 4 >= docs then bucket end) as q1, min(case when upto * 4 >= docs * 3 then bucket end) as q3
  from (select {by}metric, bucket, sum(n) over (partition by {by}metric order by bucket) as upto, sum(n) over (partition by {by}metric) as docs
        from (select {by}metric, bucket, sum(n) as n from sk group by {by}metric, bucket))
  group by {by}metric)"""


#: DuckDB SQL for quality_report() over the table documents with unique doc_id.
SQL = rf"""
with d as (select doc_id, lang, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
p as (select doc_id, unnest(words) as w, generate_subscripts(words, 1) as i from d),
tri as (select doc_id, i, w || ' ' || lead(w) over o || ' ' || lead(w, 2) over o as three from p window o as (partition by doc_id order by i)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, three) as n from tri where three is not null) where n > 1),
cov as (select doc_id, count(distinct i + k) as n from rep, (values (0), (1), (2)) s(k) group by doc_id),
m as (
  select d.doc_id, lang, source, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))::bigint as n_lines,
         (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::bigint as n_dup_lines,
         coalesce(cov.n, 0)::bigint as n_repeat_words
  from d left join cov on d.doc_id = cov.doc_id
),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
vals as ({_VALUES}),
sk as (select lang, source, metric, (v >> greatest(length(bin(v)) - 8, 0)) << greatest(length(bin(v)) - 8, 0) as bucket, count(*) as n from vals group by all),
{_quartile_sql("own", ["lang", "source"])},
{_quartile_sql("bl", ["lang"])},
{_quartile_sql("al", [])},
t as (
  select own.lang, own.source, own.metric,
         case when own.docs >= {LEAST} then own.q1 when bl.docs >= {LEAST} then bl.q1 else al.q1 end as q1,
         case when own.docs >= {LEAST} then own.q3 when bl.docs >= {LEAST} then bl.q3 else al.q3 end as q3
  from own join bl on own.lang is not distinct from bl.lang and own.metric = bl.metric join al on own.metric = al.metric
),
lim as (select lang, source, {", ".join(_limit(e, m) for m in METRICS for e in ("low", "high"))} from t group by lang, source),
j as (
  select b.*, concat_ws(',', {", ".join(f"case when {_FAILS[m]} then '{m}' end" for m in METRICS)}) as reasons
  from b left join lim on b.lang is not distinct from lim.lang and b.source is not distinct from lim.source
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and reasons = '' as kept, reasons from j
"""
