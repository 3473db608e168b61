"""Join operators: point-in-time (interval) resolution, as-of lookup and
referential anti-joins.

No side is broadcast by a hint: the planner broadcasts by measured bytes (file
statistics, then the runtime sizes that adaptive execution sees), shuffles
otherwise, and splits skewed partitions. Building a join runs no job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Versions that touch more months than this are kept once per key, not once per month.
LONG_MONTHS = 3


def month_of(c: Column) -> Column:
    """Months since year 0, so that neighbouring months are neighbouring numbers."""
    return F.year(c) * 12 + F.month(c)


def _all_equal(left: DataFrame, pairs: dict[str, str]) -> Column:
    return reduce(and_, [left[a] == F.col(b) for a, b in pairs.items()])


def resolve_version(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    date_col: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    take: Sequence[str] = ("instrument_version_sk",),
    how: str = "left",
) -> DataFrame:
    """Point-in-time join: attach the version whose [valid_from, valid_to]
    (inclusive) holds the fact's date, matching on the equi ``keys``.

    Versions are cut at month borders and facts carry their month, so both are
    joined on (key, month) by equality: a key with any number of versions and
    facts is spread over its months, and a fact meets only the versions that
    touch its own month (32 at most where the key's versions do not overlap).
    Versions of more than ``LONG_MONTHS`` months, such as an open-ended base
    version, are kept once per key; without overlaps a key has at most six a year.

    A null fact key or date never matches (``left`` keeps the fact with nulls,
    ``inner`` drops it); versions with a null key or bound match nothing.
    Overlapping versions, or fewer keys than the version grain, fan out to one
    row per match; ``count_versions`` checks that.
    """
    names = {k: f"__v_{k}" for k in keys}
    body = F.struct(F.col(valid_from).alias("__from"), F.col(valid_to).alias("__to"), *[F.col(c) for c in take]).alias("__v")
    v = versions.filter(F.col(valid_from) <= F.col(valid_to)).select(
        *[F.col(k).alias(n) for k, n in names.items()], body, month_of(F.col(valid_from)).alias("__first"), month_of(F.col(valid_to)).alias("__last"))
    spans = F.col("__last") - F.col("__first") >= F.lit(LONG_MONTHS)
    monthly = v.filter(~spans).withColumn("__v_month", F.explode(F.sequence("__first", "__last")))
    monthly = monthly.groupBy(*names.values(), "__v_month").agg(F.collect_list("__v").alias("__monthly"))
    long = v.filter(spans).groupBy(*names.values()).agg(F.collect_list("__v").alias("__long"))

    def holding(array: str) -> Column:
        mine = F.filter(array, lambda x: (x["__from"] <= F.col(date_col)) & (F.col(date_col) <= x["__to"]))
        return F.coalesce(mine, F.array().cast(monthly.schema["__monthly"].dataType))

    # What matches in the month is picked before the second join, so the arrays themselves move once.
    f = facts.withColumn("__month", month_of(F.col(date_col)))
    j = f.join(monthly, _all_equal(f, names) & (F.col("__month") == F.col("__v_month")), "left").select(*f.columns, holding("__monthly").alias("__found"))
    j = j.join(long, _all_equal(j, names), "left").select(*facts.columns, F.concat("__found", holding("__long")).alias("__found"))
    each = F.explode_outer("__found") if how == "left" else F.explode("__found")
    return j.withColumn("__v", each).select(*facts.columns, *[F.col(f"__v.`{c}`").alias(c) for c in take])


def count_versions(
    fact_keys: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    date_col: str,
    count_col: str = "instrument_version_sk",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Per distinct (keys, date) of the facts, how many versions resolve.

    Anything but 1 is a timeline gap (0) or overlap (>1). Distinct first so
    the join works on the key grain, not on the fact volume.
    """
    fk = fact_keys.select(*keys, date_col).distinct()
    joined = resolve_version(fk, versions, keys, date_col, valid_from, valid_to, take=(count_col,))
    return joined.groupBy(*keys, date_col).agg(F.count(count_col).alias("version_rows"))


def _period(c: Column, kind: str, period: str | Callable[[Column], Column] | None) -> Column:
    if callable(period):
        return period(c)
    return F.date_trunc(period, c) if period and kind.startswith(("date", "timestamp")) else F.lit(0)


def asof_points(
    points: DataFrame,
    right: DataFrame,
    by: Sequence[str] | dict[str, str],
    left_on: str,
    right_on: str,
    value_cols: Sequence[str],
    period: str | Callable[[Column], Column] | None = "month",
) -> DataFrame:
    """``points`` (distinct (by, left_on), nothing else) with the values of the
    latest right row of the same key on or before each point; nulls when none.

    Points and right rows are one tagged set of rows, sorted by time: a point
    takes the last right row before it. That scan runs in two levels, so a hot
    key is split by ``period``. Inside a (key, period) the rows are scanned; what
    a period starts with is the last right row of the key's earlier periods,
    carried over one row per (key, period). No row is matched with another, so
    the work is linear in both sides.

    ``period``: a date_trunc unit for dates and timestamps, or a function from
    the time column to any ordered value that never falls as time rises. The
    right side has one row per (by, right_on); its rows with a null key or
    time, and points with one, match nothing.
    """
    by_map = dict(by) if isinstance(by, dict) else {k: k for k in by}
    keys = [f"__k_{k}" for k in by_map]
    kind = dict(points.dtypes)[left_on]
    mine = points.select(*[F.col(k).alias(f"__k_{k}") for k in by_map], F.col(left_on).alias("__t"))
    known = right.select(*[F.col(r).alias(f"__k_{k}") for k, r in by_map.items()], F.col(right_on).cast(kind).alias("__t"), F.struct(*value_cols).alias("__v"))
    known = known.dropna(subset=[*keys, "__t"])
    # A null struct tags the points; right rows of the same time sort before them.
    both = mine.withColumn("__v", F.lit(None).cast(known.schema["__v"].dataType)).unionByName(known)
    both = both.withColumn("__p", _period(F.col("__t"), kind, period))
    is_point = F.col("__v").isNull()
    ends = both.groupBy(*keys, "__p").agg(F.max_by("__v", F.when(~is_point, F.col("__t"))).alias("__end"))
    earlier = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(k).alias(f"__c{k}") for k in keys], F.col("__p").alias("__cp"), F.last("__end", ignorenulls=True).over(earlier).alias("__carry"))
    inside = Window.partitionBy(*keys, "__p").orderBy("__t", is_point).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = both.withColumn("__in", F.last("__v", ignorenulls=True).over(inside)).filter(is_point)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__c{k}")) for k in keys], F.col("__p").eqNullSafe(F.col("__cp")))
    found = scanned.join(carried, same, "left").withColumn("__v", F.coalesce("__in", "__carry"))
    return found.select(*[F.col(f"__k_{k}").alias(k) for k in by_map], F.col("__t").alias(left_on), *[F.col(f"__v.`{c}`").alias(c) for c in value_cols])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str] | dict[str, str],
    left_on: str,
    right_on: str,
    value_cols: Sequence[str],
    period: str | Callable[[Column], Column] | None = "month",
) -> DataFrame:
    """Left as-of join: each left row with the values of the right row of the
    same ``by`` group with the greatest ``right_on`` <= ``left_on``; nulls when none.

    The distinct (by, left_on) of the left side are resolved by ``asof_points``
    and joined back by equality, so left rows that share a key and a time
    are resolved once, and the join back is one that adaptive execution can
    split. A null key or time keeps its row with nulls.
    """
    by_map = dict(by) if isinstance(by, dict) else {k: k for k in by}
    points = left.select(*by_map, left_on).dropna().distinct()
    found = asof_points(points, right, by_map, left_on, right_on, value_cols, period)
    found = found.select(*[F.col(c).alias(f"__r_{c}") for c in (*by_map, left_on)], F.struct(*value_cols).alias("__v"))
    out = left.join(found, _all_equal(left, {c: f"__r_{c}" for c in (*by_map, left_on)}), "left")
    return out.select(*[left[c] for c in left.columns], *[F.col(f"__v.`{c}`").alias(c) for c in value_cols])


def missing_parents(
    children: DataFrame,
    parents: DataFrame,
    keys: Sequence[str] | dict[str, str],
) -> DataFrame:
    """Child rows whose (composite) key has no parent; null keys are skipped.

    Left anti join against the *distinct* parent keys, so a parent table with
    repeated keys cannot multiply the work.
    """
    key_map = dict(keys) if isinstance(keys, dict) else {k: k for k in keys}
    child_cols = list(key_map.keys())
    kids = children.dropna(subset=child_cols)
    par = parents.select(*[F.col(p).alias(f"__p_{c}") for c, p in key_map.items()]).distinct()
    cond = None
    for c in child_cols:
        e = kids[c] == par[f"__p_{c}"]
        cond = e if cond is None else cond & e
    return kids.join(par, cond, "left_anti")
