"""Mixing sources to target weights.

Words are summed per source, targets follow from the sources' weights, and a
source's repetition rate is its target over its size. Each document is emitted
floor(rate) times, plus one more copy if a uniform number drawn from the hash
of its id and a seed is below the fraction. Of ``SEEDS`` fixed seeds each source
takes the one whose draws bring its words nearest the target (the first of
equals): what all seeds would take is summed in one aggregate over the sizes.
Rates and seeds come from one small row per source; documents are never
gathered or sorted, so a source with a third of all rows is read like any other.

Targets: sources by code point (null last) weigh ``weights`` in turn and share
all words; a target stops at ``cap`` times its source's size and the excess is
reshared by weight until none is above. The end state gives each source
min(cap * size, weight * level): capping sources in the order of size per
weight finds the level.

Defined cases: a null or empty text has size 0 and is copied like the others of
its source; null is a source of its own; repeated rows with one id are drawn
alike; an empty table gives no rows; a null doc_id draws by its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkbook.llm.common import WORD, dropped, saved

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix"
#: Seeds that a source chooses from.
SEEDS = 32


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Windows over the whole frame run in one task: its rows are sources, whose
    number does not follow the number of documents.
    """
    order = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.expr("cast(source as binary)")))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(order - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight).withColumn("ratio", F.col("source_size") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), F.expr("cast(source as binary)"))
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    ranked = ranked.withColumn("nth", F.row_number().over(by_ratio))
    ranked = ranked.withColumn("capped", F.coalesce(F.sum("source_size").over(upto), F.lit(0)) * cap)
    ranked = ranked.withColumn("open_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
    ranked = ranked.withColumn("level", (F.sum("source_size").over(every) - F.col("capped")) / F.col("open_weight"))
    # The first source, by size per weight, that the level leaves below its cap sets the level for all after it.
    level = F.min(F.struct((F.col("level") > cap * F.col("ratio")).alias("over"), F.col("nth"), F.col("level"))).over(every)["level"]
    return ranked.select("source", "source_size", F.least(F.lit(float(cap)) * F.col("source_size"), F.col("weight") * level).alias("target"))


def uniform(name: Column, seed: Column) -> Column:
    """In [0, 1), the same for the same document and seed in every run."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", name, seed)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _name() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.col("text"))


def _rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)


def _seed(seed: str, k: int) -> str:
    return seed if k == 0 else f"{seed}{k}"


def seeded(sized: DataFrame, weights: tuple[int, ...], cap: int, seed: str) -> DataFrame:
    """(of, source_size, target, rate, chosen) per source, written; ``sized``: name, source, size per document."""
    # Written first, the targets have a size that the planner knows: documents need no shuffle by source.
    targets = saved(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap), "targets")
    targets = targets.withColumnRenamed("source", "of").withColumn("rate", _rate())
    seeds = [_seed(seed, k) for k in range(SEEDS)]
    fraction = F.col("rate") - F.floor("rate")
    j = sized.join(targets, F.col("source").eqNullSafe(F.col("of")))
    took = [F.sum(F.col("size") * (F.floor("rate") + (uniform(F.col("name"), F.lit(x)) < fraction).cast("long"))).alias(f"took_{k}") for k, x in enumerate(seeds)]
    sums = j.groupBy("of").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("rate").alias("rate"), *took)
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"took_{k}") - F.col("target")).alias("off"), F.lit(k).alias("k")) for k in range(SEEDS)]))["k"]
    return saved(sums.select("of", "source_size", "target", "rate", F.element_at(F.array(*[F.lit(x) for x in seeds]), nearest + 1).alias("chosen")), "seeds")


def _copies() -> Column:
    return F.floor("rate") + (uniform(F.col("name"), F.col("chosen")) < F.col("rate") - F.floor("rate")).cast("long")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _name().alias("name"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"))


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) per document."""
    sized = saved(_sized(docs), "sizes")
    joined = sized.join(seeded(sized, weights, cap, seed), F.col("source").eqNullSafe(F.col("of")))
    return joined.select("doc_id", "source", "size", "source_size", "target", _copies().alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mixed documents themselves, repeats included, with the columns of ``docs``."""
    sized = saved(_sized(docs).drop("doc_id"), "sizes")
    rates = seeded(sized, weights, cap, seed)
    dropped(sized)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _name().alias("name"), F.col("source").cast("string").alias("source"))
    drawn = row.join(rates, F.col("source").eqNullSafe(F.col("of")))
    return drawn.withColumn("copy", F.explode(F.array_repeat(F.lit(1), _copies().cast("int")))).select("row.*")


#: DuckDB SQL for the query over the table documents.
SQL = rf"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size, coalesce(cast(doc_id as varchar), text) as name from documents
),
s as (
  select source, sum(size)::bigint as source_size,
         1 + (row_number() over (order by source is null, encode(source)) - 1) % 3 as weight
  from d group by source
),
-- with the sources of smaller size per weight capped, the level that uses up all words; the first that caps no more holds
lv as (
  select ratio, ((select sum(source_size) from s) - 3.0::double * coalesce(sum(source_size) over (order by ratio range between unbounded preceding and current row exclude group), 0))
                / sum(weight) over (order by ratio range between current row and unbounded following) as level
  from (select *, source_size::double / weight as ratio from s)
),
l as (select level from lv where level <= 3 * ratio order by ratio limit 1),
t as (select source, source_size, least(3.0 * source_size, weight * level) as target, case when source_size > 0 then least(3.0 * source_size, weight * level) / source_size else 1.0 end as rate from s cross join l),
-- what each document would give under each seed
g as (
  select d.doc_id, d.source, d.size, t.source_size, t.target, k,
         d.size * (floor(rate)::bigint + case when ('0x' || substr(md5(concat_ws(':', name, '{SEED}' || case when k = 0 then '' else k::varchar end)), 1, 8))::bigint / 4294967296.0::double < rate - floor(rate) then 1 else 0 end) as taken
  from d join t on d.source is not distinct from t.source, range({SEEDS}) r(k)
),
c as (select source, arg_min(k, (off, k)) as k from (select source, k, abs(sum(taken) - any_value(target)) as off from g group by source, k) group by source)
select g.doc_id, g.size, g.source_size, g.target, g.taken::bigint as taken from g join c on g.source is not distinct from c.source and g.k = c.k
"""
