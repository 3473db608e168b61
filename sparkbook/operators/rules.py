"""Data-quality rules compiled to few passes: many rules, one report.

A rule names what must not be; ``report`` turns the rules of any number of
tables into one plan. All row rules of a table are conditional counts of a
single aggregate. All key rules over the same columns share one grouping. All
references to the same columns of a parent, from whichever tables, share one
join with the parent's distinct keys, after the children's keys are counted
(so a key with a third of the rows is one row per task). A table is read once
for its row rules and once per grouping, however many rules there are.

The report has one row per rule with the number of violations and up to two
violating rows (the least and the greatest as JSON): nothing unbounded is kept.

Nulls: a condition that is null does not violate a row rule (``holds`` takes it
as a violation); null keys are skipped by ``unique`` and ``known``. An empty
table violates ``at_least`` alone.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbook.operators.sets import union_all

Where = str | Column | None


@dataclass(frozen=True)
class Rule:
    """``warn_if`` / ``error_if``: violations from which an error rule warns or fails; a warn rule never fails."""

    name: str
    severity: str = field(default="error", kw_only=True)
    warn_if: int = field(default=1, kw_only=True)
    error_if: int = field(default=1, kw_only=True)


@dataclass(frozen=True)
class RowRule(Rule):
    """``fails`` makes the condition when the report is built, so that rules can be declared without a session."""

    fails: Callable[[], Column]


@dataclass(frozen=True)
class KeyRule(Rule):
    """Violations are keys with more than one row."""

    columns: tuple[str, ...]
    where: Where


@dataclass(frozen=True)
class ReferenceRule(Rule):
    """Violations are rows whose key no row of ``parent`` has."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    where: Where


@dataclass(frozen=True)
class FloorRule(Rule):
    """One violation where the table has fewer rows."""

    rows: int


@dataclass(frozen=True)
class NameRule(Rule):
    """Violations are columns whose name does not match; the table is not read."""

    pattern: str


def _col(c: Where) -> Column:
    return F.lit(True) if c is None else F.expr(c) if isinstance(c, str) else c


def _within(where: Where, fails: Callable[[], Column]) -> Callable[[], Column]:
    return fails if where is None else lambda: _col(where) & fails()


def required(col: str, where: Where = None, **kw) -> RowRule:
    return RowRule(kw.pop("name", f"{col} required"), _within(where, lambda: F.col(col).isNull()), **kw)


def filled(col: str, where: Where = None, **kw) -> RowRule:
    """Strings of spaces only violate; null passes."""
    return RowRule(kw.pop("name", f"{col} filled"), _within(where, lambda: F.trim(F.col(col)) == ""), **kw)


def accepted(col: str, values: Iterable, where: Where = None, **kw) -> RowRule:
    return RowRule(kw.pop("name", f"{col} accepted"), _within(where, lambda: ~F.col(col).isin(list(values))), **kw)


def within(col: str, low=None, high=None, where: Where = None, **kw) -> RowRule:
    """Bounds are inclusive; null passes."""

    def fails() -> Column:
        parts = ([F.col(col) < low] if low is not None else []) + ([F.col(col) > high] if high is not None else [])
        return reduce(or_, parts, F.lit(False))

    return RowRule(kw.pop("name", f"{col} within"), _within(where, fails), **kw)


def matches(col: str, pattern: str, where: Where = None, **kw) -> RowRule:
    """The whole value must match; null passes."""
    return RowRule(kw.pop("name", f"{col} format"), _within(where, lambda: ~F.col(col).rlike(f"^(?:{pattern})$")), **kw)


def holds(condition: str | Column, where: Where = None, **kw) -> RowRule:
    """Rows on which ``condition`` is false or null violate."""
    return RowRule(kw.pop("name", None) or f"holds {condition}", _within(where, lambda: ~F.coalesce(_col(condition), F.lit(False))), **kw)


def unique(columns: str | Sequence[str], where: Where = None, **kw) -> KeyRule:
    columns = (columns,) if isinstance(columns, str) else tuple(columns)
    return KeyRule(kw.pop("name", f"{', '.join(columns)} unique"), columns, where, **kw)


def known(columns: str | Mapping[str, str], parent: str, where: Where = None, **kw) -> ReferenceRule:
    """``columns``: child column -> column of the table ``parent``."""
    pairs = {columns: columns} if isinstance(columns, str) else dict(columns)
    return ReferenceRule(kw.pop("name", f"{', '.join(pairs)} in {parent}"), tuple(pairs), parent, tuple(pairs.values()), where, **kw)


def at_least(rows: int, **kw) -> FloorRule:
    return FloorRule(kw.pop("name", f"at least {rows} rows"), rows, **kw)


def named(pattern: str = "[a-z][a-z0-9_]*", **kw) -> NameRule:
    return NameRule(kw.pop("name", "column names"), pattern, **kw)


def _violations(n: Column) -> Column:
    return n.cast("long").alias("violations")


def _long(wide: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """(table, rule, violations, least, greatest) from one row with n_i, lo_i and hi_i per rule."""
    each = [F.struct(F.lit(r.name).alias("rule"), F.col(f"n_{i}").cast("long").alias("violations"), F.col(f"lo_{i}").alias("least"), F.col(f"hi_{i}").alias("greatest")) for i, r in enumerate(rules)]
    return wide.select(F.lit(table).alias("table"), F.inline(F.array(*each)))


def _row_rules(table: str, df: DataFrame, rules: Sequence[RowRule | FloorRule]) -> DataFrame:
    """A row is written as JSON once, however many rules it violates, and each rule is evaluated once."""
    own = [(i, r) for i, r in enumerate(rules) if isinstance(r, RowRule)]
    example = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    found = df.select(*[F.coalesce(r.fails(), F.lit(False)).alias(f"__f{i}") for i, r in own], (example if own else F.lit(None)).cast("string").alias("__row"))
    aggs = []
    for i, r in enumerate(rules):
        if isinstance(r, FloorRule):
            aggs += [(F.count(F.lit(1)) < r.rows).cast("long").alias(f"n_{i}"), F.lit(None).cast("string").alias(f"lo_{i}"), F.lit(None).cast("string").alias(f"hi_{i}")]
        else:
            shown = F.when(F.col(f"__f{i}"), F.col("__row"))
            aggs += [F.count_if(F.col(f"__f{i}")).alias(f"n_{i}"), F.min(shown).alias(f"lo_{i}"), F.max(shown).alias(f"hi_{i}")]
    return _long(found.agg(*aggs), table, rules)


def _per_key(df: DataFrame, columns: Sequence[str], rules: Sequence[KeyRule | ReferenceRule]) -> DataFrame:
    """One row per key without nulls: in how many rows each rule applies."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(*[F.count_if(_col(r.where)).alias(f"in_{i}") for i, r in enumerate(rules)])


def _key_rules(table: str, df: DataFrame, columns: tuple[str, ...], rules: Sequence[KeyRule]) -> DataFrame:
    keys = _per_key(df, columns, rules)
    shown = keys.select(*[F.when(F.col(f"in_{i}") > 1, F.to_json(F.struct(*columns, F.col(f"in_{i}").alias("n_records")))).alias(f"__r{i}") for i in range(len(rules))])
    aggs = [a for i in range(len(rules)) for a in (F.count(f"__r{i}").alias(f"n_{i}"), F.min(f"__r{i}").alias(f"lo_{i}"), F.max(f"__r{i}").alias(f"hi_{i}"))]
    return _long(shown.agg(*aggs), table, rules)


def _references(parent: DataFrame, parent_columns: tuple[str, ...], children: Sequence[tuple[str, DataFrame, tuple[str, ...], Sequence[ReferenceRule]]]) -> DataFrame:
    """All references to these columns of one parent: children's key counts in one union, one anti join."""
    names = [f"k{i}" for i in range(len(parent_columns))]
    have = parent.select(*[F.col(c).alias(f"p{i}") for i, c in enumerate(parent_columns)]).dropna().distinct()
    kinds = [f.dataType for f in have.schema]
    parts = []
    for table, df, columns, rules in children:
        each = F.inline(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"in_{i}").alias("n")) for i, r in enumerate(rules)]))
        keyed = _per_key(df, columns, rules).select(F.lit(table).alias("table"), *[F.col(c).cast(t).alias(n) for c, t, n in zip(columns, kinds, names, strict=True)], each)
        parts.append(keyed.filter("n > 0"))
    counts = union_all(*parts)
    # Not an anti join: the optimizer would push that below the union, one join per child.
    met = counts.join(have, reduce(and_, [F.col(n) == F.col(f"p{i}") for i, n in enumerate(names)]), "left")
    missing = met.filter(F.col("p0").isNull())
    shown = missing.select("table", "rule", "n", F.to_json(F.struct(*names)).alias("__row"))
    return shown.groupBy("table", "rule").agg(_violations(F.sum("n")), F.min("__row").alias("least"), F.max("__row").alias("greatest"))


def report(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """(table, rule, severity, violations, status, sample) for every rule, as one lazy plan.

    ``rules``: by table, whose names are keys of ``tables``, as parents are; a
    rule's name is unique in its table.
    """
    meta, parts = [], []
    by_parent: dict = defaultdict(list)
    for table, own in rules.items():
        if len({r.name for r in own}) != len(own):
            raise ValueError(f"rule names of {table} repeat")
        meta += [(table, r.name, r.severity, r.warn_if, r.error_if) for r in own]
        df = tables[table]
        rows = [r for r in own if isinstance(r, RowRule | FloorRule)]
        if rows:
            parts.append(_row_rules(table, df, rows))
        by_key, references = defaultdict(list), defaultdict(list)
        for r in own:
            if isinstance(r, KeyRule):
                by_key[r.columns].append(r)
            if isinstance(r, ReferenceRule):
                references[r.columns, r.parent, r.parent_columns].append(r)
        parts += [_key_rules(table, df, columns, same) for columns, same in by_key.items()]
        for (columns, parent, parent_columns), same in references.items():
            by_parent[parent, parent_columns].append((table, df, columns, same))
        for r in own:
            if isinstance(r, NameRule):
                bad = sorted(c for c in df.columns if not re.fullmatch(r.pattern, c))
                one = [(table, r.name, len(bad), bad[0] if bad else None, bad[-1] if bad else None)]
                parts.append(df.sparkSession.createDataFrame(one, "table string, rule string, violations long, least string, greatest string"))
    if not meta:
        raise ValueError("no rules given")
    parts += [_references(tables[parent], columns, children) for (parent, columns), children in by_parent.items()]
    spark = next(iter(tables.values())).sparkSession
    wanted = spark.createDataFrame(meta, "table string, rule string, severity string, warn_if long, error_if long")
    found = union_all(*parts).withColumnsRenamed({"table": "__t", "rule": "__r"})
    j = wanted.join(found, (F.col("table") == F.col("__t")) & (F.col("rule") == F.col("__r")), "left")
    n = F.coalesce("violations", F.lit(0))
    status = F.when((F.col("severity") != "warn") & (n >= F.col("error_if")), "fail").when(n >= F.col("warn_if"), "warn").otherwise("pass")
    sample = F.array_distinct(F.array_compact(F.array("least", "greatest")))
    return j.select("table", "rule", "severity", n.alias("violations"), status.alias("status"), sample.alias("sample"))
