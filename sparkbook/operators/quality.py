"""Declarative data-quality layer: every rule is a DataFrame of violating
rows, so a rule is just another lazy plan that Catalyst prunes and pushes
down; ``run_checks`` turns them into one report that holds counts and a bounded
sample, never a violation set.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkbook.operators.joins import missing_parents
from sparkbook.operators.sets import union_all

BLANKS = ("", "N/A")


@dataclass
class Check:
    """A named rule whose ``violations`` frame must be empty to pass.

    ``severity`` is 'error' or 'warn'; ``warn_if`` / ``error_if`` are
    violation-count thresholds as in the reference (default: any row).
    """

    name: str
    violations: DataFrame
    severity: str = "error"
    warn_if: int = 1
    error_if: int = 1


def _scope(df: DataFrame, where: str | Column | None) -> DataFrame:
    return df if where is None else df.filter(where)


def not_null(df: DataFrame, col: str, where=None) -> DataFrame:
    return _scope(df, where).filter(F.col(col).isNull())


def unique(df: DataFrame, cols: str | Sequence[str], where=None) -> DataFrame:
    """Keys occurring more than once, with their count (nulls are skipped)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    d = _scope(df, where).dropna(subset=cols)
    return d.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def accepted_values(df: DataFrame, col: str, values: Iterable, where=None) -> DataFrame:
    """Values outside the accepted set; nulls pass."""
    return _scope(df, where).filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def not_empty_string(df: DataFrame, col: str, where=None) -> DataFrame:
    return _scope(df, where).filter(F.trim(F.col(col)) == "")


def relationships(df: DataFrame, parent: DataFrame, keys: str | Sequence[str] | dict[str, str], where=None) -> DataFrame:
    """Rows whose (composite) key has no parent row; null keys are skipped."""
    k = [keys] if isinstance(keys, str) else keys
    return missing_parents(_scope(df, where), parent, k)


def expression_is_true(df: DataFrame, expr: str | Column, where=None) -> DataFrame:
    """Rows where the expression is false or null."""
    e = F.expr(expr) if isinstance(expr, str) else expr
    return _scope(df, where).filter(~F.coalesce(e, F.lit(False)))


def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None, inclusive: bool = True, where=None) -> DataFrame:
    c = F.col(col)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ((c < F.lit(min_value)) if inclusive else (c <= F.lit(min_value)))
    if max_value is not None:
        bad = bad | ((c > F.lit(max_value)) if inclusive else (c >= F.lit(max_value)))
    return _scope(df, where).filter(c.isNotNull() & bad)


def is_trading_date(df: DataFrame, col: str, dates: DataFrame, where=None) -> DataFrame:
    """Rows whose date is not an open day; a date missing from the calendar
    counts as a violation (a join miss must not pass)."""
    cal = dates.select(F.col("date_key").alias("__d"), F.col("is_trading_day").alias("__open"))
    d = _scope(df, where)
    cal = F.broadcast(cal)  # one row per day
    j = d.join(cal, d[col] == cal["__d"], "left")
    return j.filter(~F.coalesce(F.col("__open"), F.lit(False))).drop("__d", "__open")


def is_blank(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.isNull() | col.isin(*BLANKS)


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """Report (check, severity, violations, status, sample) for every check, as one lazy plan.

    Each check is one aggregate (its count and two of its rows as JSON); the
    aggregates are united, so the whole report is one job. Rules on the rows
    and keys of tables are cheaper in ``rules.report``, which fuses them first.
    """
    if not checks:
        raise ValueError("no checks given")
    parts, meta = [], []
    for i, c in enumerate(checks):
        shown = F.to_json(F.struct(*[F.col(f"`{x}`") for x in c.violations.columns]))
        rows = c.violations.select(shown.alias("__row"))  # written once for both ends of the sample
        parts.append(rows.agg(F.count(F.lit(1)).alias("violations"), F.array_distinct(F.array_compact(F.array(F.min("__row"), F.max("__row")))).alias("sample")).withColumn("__i", F.lit(i)))
        meta.append((i, c.name, c.severity, c.warn_if, c.error_if))
    named = checks[0].violations.sparkSession.createDataFrame(meta, "i int, check string, severity string, warn_if long, error_if long")
    n = F.col("violations")
    status = F.when((F.col("severity") != "warn") & (n >= F.col("error_if")), "fail").when(n >= F.col("warn_if"), "warn").otherwise("pass")
    return named.join(union_all(*parts), F.col("i") == F.col("__i")).select("check", "severity", "violations", status.alias("status"), "sample")
