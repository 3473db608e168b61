"""How five filters interact: what each removes alone, after others, and on average over all orders.

Filters A to D are conditions on a text; E is an existential self-join: a left
semi join on hash, exact text and smaller doc_id marks a document that has an
identical text under a smaller doc_id. The ids that E marks are united with the
ids and failures of the other filters, and the bits of each document are
aggregated to counts per part and combination (at most 32 a part), from which
every order's figures follow without reading a document again.

Hashes are counted first, and only texts whose hash occurs twice are compared (the
texts move once unless the planner can broadcast those hashes). The right side
of the self-join is one row per hash and text (map-side minimum of doc_id), so a
row of the left meets one row for each text of its hash. A hash with more than
1/HOT of the rows has its left rows salted by doc_id and its right rows repeated
per salt; there are less than HOT such hashes, so that list is broadcast.

Defined cases: null text counts as empty; null source is the part ``""``; a null
doc_id is neither smaller nor larger, so it is not marked by E and marks none;
rows repeated in full each count, equal doc_ids do not mark each other; a
document counts as good or toxic if any row of labels says so; empty table: no
rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkbook.llm.common import saved

FILTERS = "ABCDE"
WHITE = r"[\x20\x09-\x0D]+"
CAPITALS, MARKS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "#$%&*|"
#: Hashes with more than 1/HOT of all rows are salted, into one salt per 1/HOT.
HOT = 1000


def _holding(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def failing(text: Column, words: Column) -> Column:
    """Bits 0 to 3: whether filters A to D fail on a text with these words."""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    conditions = [n < 50, 100 * distinct < 65 * n, 100 * _holding(text, CAPITALS) > 5 * F.length(text), _holding(text, MARKS) > 0]
    return sum((c.cast("int") * (1 << k) for k, c in enumerate(conditions)), F.lit(0))


def text_hash(text: Column) -> list[Column]:
    """128 bits."""
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.lit("audit"), text).alias("h2")]


def duplicated(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, part, h, h2) of the rows that have an identical text under a smaller doc_id; ``rows`` has the hashes of ``docs`` (id, part, text)."""
    twice = rows.groupBy("h", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    total = rows.agg(F.count(F.lit(1))).scalar()
    many = F.floor(F.col("n") * HOT / total).cast("int")
    twice = saved(twice.select("h", "h2", (many + 1).alias("salts")), "repeated")
    hot = F.broadcast(twice.filter("salts > 1").select(F.col("h").alias("hot_h"), F.col("h2").alias("hot_h2"), F.col("salts").alias("hot_salts")))
    left = docs.select("doc_id", "part", "text", *text_hash(F.col("text")))
    left = left.join(hot, (F.col("h") == F.col("hot_h")) & (F.col("h2") == F.col("hot_h2")), "left")
    left = left.withColumn("salt", F.when(F.col("hot_salts").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("hot_salts"))).otherwise(0).cast("int"))
    spread = twice.select("h", "h2", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    left = left.join(spread, ["h", "h2", "salt"], "left_semi").select("doc_id", "part", "text", "h", "h2", "salt")
    left = saved(left, "candidates")
    first = left.filter("doc_id is not null").groupBy("h", "h2", "text").agg(F.min("doc_id").alias("smallest"))
    first = first.join(twice, ["h", "h2"]).select(
        F.col("h").alias("of_h"), F.col("h2").alias("of_h2"), F.col("text").alias("same"), "smallest", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("of_salt"))
    met = (F.col("h") == F.col("of_h")) & (F.col("h2") == F.col("of_h2")) & (F.col("salt") == F.col("of_salt")) & (F.col("text") == F.col("same")) & (F.col("smallest") < F.col("doc_id"))
    return left.join(first, met, "left_semi").select("doc_id", "part", "h", "h2")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents per part and combination of failing filters."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = F.filter(F.split("text", WHITE), lambda w: w != "")
    bits = failing(F.col("text"), F.col("words")).alias("bits")
    rows = saved(docs.withColumn("words", words).select("doc_id", "part", *text_hash(F.col("text")), bits), "failures")
    marked = duplicated(docs, rows).select("doc_id", "part", "h", "h2", F.lit(1 << FILTERS.index("E")).alias("bits"), F.lit(0).alias("row"))
    united = rows.withColumn("row", F.lit(1)).unionByName(marked)
    each = united.groupBy("doc_id", "part", "h", "h2").agg(F.bit_or("bits").alias("bits"), F.sum("row").alias("n"))
    # One doc_id meets its label once per part and combination, however many rows it has.
    per_id = each.groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
    label = labels.select(F.col("doc_id").cast("long").alias("labelled"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    label = label.groupBy("labelled").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    joined = per_id.join(label, F.col("doc_id") == F.col("labelled"), "left")
    counted = {c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")}
    return joined.groupBy("part", "bits").agg(F.sum("n").alias("n"), *counted.values())


def _orders(spark: SparkSession) -> DataFrame:
    """(filter_order, step, own, before): each step of the 120 orders, its filter and the mask of those before it."""
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    rows = [("".join(p), k + 1, bit[f], sum(bit[x] for x in p[:k])) for p in permutations(FILTERS) for k, f in enumerate(p)]
    return spark.createDataFrame(rows, "filter_order string, step int, own int, before int")


def audited(combos: DataFrame) -> DataFrame:
    """One row per part, order and step from the counts of combinations().

    A step's counts depend on its filter and on which filters came before, not on
    their order: 80 states per part are summed, and the 600 steps look theirs up.
    The filter is first among the k that a document fails in 120/k of the orders.
    """
    states = [(1 << k, m) for k in range(len(FILTERS)) for m in range(1 << len(FILTERS)) if not m >> k & 1]
    state = F.explode(F.array(*[F.struct(F.lit(o).alias("own"), F.lit(b).alias("before")) for o, b in states])).alias("state")
    each = combos.select("*", state).select("part", "bits", "n", "good", "toxic", "state.own", "state.before")
    fails, earlier = F.col("bits").bitwiseAND(F.col("own")) > 0, F.col("bits").bitwiseAND(F.col("before")) > 0

    def counted(when: Column, what: str = "n") -> Column:
        return F.sum(F.when(when, F.col(what)).otherwise(0))

    first = F.sum(F.when(fails, F.col("n") * F.expr("120 div bit_count(bits)")).otherwise(0))
    sums = each.groupBy("part", "own", "before").agg(
        counted(~fails & ~earlier).alias("kept"), counted(fails & ~earlier).alias("removed"), counted(fails & earlier).alias("redundant"),
        counted(F.col("bits") == F.col("own")).alias("unique_fails"), counted(fails & ~earlier, "good").alias("good_lost"),
        counted(fails & ~earlier, "toxic").alias("toxic_lost"), first.alias("shapley"))
    steps = F.broadcast(_orders(combos.sparkSession))  # 600 rows
    return sums.join(steps, ["own", "before"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audited(combinations(docs, labels))


#: DuckDB SQL for audit() over the tables documents and labels.
SQL = r"""
with recursive d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
),
l as (select doc_id, max(coalesce(quality, 0) = 1) as good, max(coalesce(toxic, 0) = 1) as toxic from labels group by doc_id),
e as (
  select part, len(w) < 50 as a, 100 * len(list_distinct(w)) < 65 * len(w) as b, 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) as c,
         regexp_matches(text, '[#$%&*|]') as d, coalesce(min(d.doc_id) over (partition by text) < d.doc_id, false) as e,
         coalesce(good, false) as good, coalesce(toxic, false) as toxic
  from d left join l on d.doc_id = l.doc_id
),
f as (select part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: (x = 'A' and a) or (x = 'B' and b) or (x = 'C' and c) or (x = 'D' and d) or (x = 'E' and e)) as failed, good, toxic from e),
g as (select part, failed, count(*) as n, count_if(good) as good, count_if(toxic) as toxic from f group by part, failed),
o as (
  select '' as filter_order
  union all
  select filter_order || x from o, (values ('A'), ('B'), ('C'), ('D'), ('E')) v(x) where strpos(filter_order, x) = 0
),
s as (select filter_order, step, substr(filter_order, step, 1) as own, string_split(substr(filter_order, 1, step - 1), '') as before
      from o, (select unnest([1, 2, 3, 4, 5]) as step) where length(filter_order) = 5),
r as (
  select part, filter_order, step, own,
         sum(case when not list_contains(failed, own) and not list_has_any(failed, before) then n else 0 end)::bigint as kept,
         sum(case when list_contains(failed, own) and not list_has_any(failed, before) then n else 0 end)::bigint as removed,
         sum(case when list_contains(failed, own) and list_has_any(failed, before) then n else 0 end)::bigint as redundant,
         sum(case when failed = [own] then n else 0 end)::bigint as unique_fails,
         sum(case when list_contains(failed, own) and not list_has_any(failed, before) then good else 0 end)::bigint as good_lost,
         sum(case when list_contains(failed, own) and not list_has_any(failed, before) then toxic else 0 end)::bigint as toxic_lost
  from g, s group by part, filter_order, step, own
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, own))::bigint as shapley
from r
"""
