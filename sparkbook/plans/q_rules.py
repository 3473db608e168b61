"""Data-quality rules by the hundred: one report over the order tables."""

from __future__ import annotations

from sparkbook.operators import rules as R
from sparkbook.plans import standins as S
from sparkbook.plans.registry import register

LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _rows(where):
    return f"(select count(*) from {{table}} where {where})"


def _keys(columns, where="true"):
    return f"(select count(*) from (select {columns} from {{table}} where {where} group by {columns} having count(*) > 1))"


def _orphans(child, parent, key, where="true"):
    return f"(select count(*) from {{table}} where {where} and {child} is not null and {child} not in (select {key} from {parent} where {key} is not null))"


def line_rules():
    """(rule, SQL for its violations) on the line items: 100 of them."""
    out = [(R.required(c), _rows(f"{c} is null")) for c in LINE]
    out += [(R.within("l_quantity", high=n, name=f"quantity up to {n}", severity="warn"), _rows(f"l_quantity > {n}")) for n in range(1, 50)]
    out += [(R.within("l_discount", high=n / 100, name=f"discount up to {n}", severity="warn"), _rows(f"l_discount > {n / 100}")) for n in range(10)]
    out += [(R.holds(f"l_shipdate < timestamp'{y}-01-01'", name=f"shipped before {y}", severity="warn"), _rows(f"l_shipdate >= timestamp '{y}-01-01'")) for y in range(1996, 2004)]
    out += [
        (R.accepted("l_returnflag", ["A", "N", "R"]), _rows("l_returnflag not in ('A', 'N', 'R')")),
        (R.accepted("l_returnflag", ["A", "N"], name="not returned", severity="warn"), _rows("l_returnflag not in ('A', 'N')")),
        (R.accepted("l_linestatus", ["F"], where="l_returnflag = 'R'", name="returned lines are final", severity="warn"), _rows("l_returnflag = 'R' and l_linestatus not in ('F')")),
        (R.filled("l_returnflag"), _rows("trim(l_returnflag) = ''")),
        (R.matches("l_linestatus", "[FO]"), _rows("not regexp_full_match(l_linestatus, '[FO]')")),
        (R.matches("l_returnflag", "[A-N]", severity="warn", name="flag format"), _rows("not regexp_full_match(l_returnflag, '[A-N]')")),
        (R.within("l_tax", 0, 0.08), _rows("l_tax < 0 or l_tax > 0.08")),
        (R.holds("l_extendedprice >= l_quantity", name="price covers quantity"), _rows("not coalesce(l_extendedprice >= l_quantity, false)")),
        (R.holds("l_extendedprice > 1000 * l_quantity", name="a thousand a piece", severity="warn", warn_if=10), _rows("not coalesce(l_extendedprice > 1000 * l_quantity, false)")),
        (R.unique(["l_orderkey", "l_linenumber"], severity="warn"), _keys("l_orderkey, l_linenumber")),
        (R.unique(["l_orderkey", "l_linenumber"], where="l_linestatus = 'F'", name="final lines unique", severity="warn"), _keys("l_orderkey, l_linenumber", "l_linestatus = 'F'")),
        (R.unique("l_orderkey", severity="warn"), _keys("l_orderkey")),
        (R.unique(["l_partkey", "l_suppkey"], where="l_returnflag = 'R'", severity="warn"), _keys("l_partkey, l_suppkey", "l_returnflag = 'R'")),
        (R.known({"l_orderkey": "o_orderkey"}, "orders"), _orphans("l_orderkey", "orders", "o_orderkey")),
        (R.known({"l_orderkey": "o_orderkey"}, "orders", where="l_quantity > 25", name="large lines have an order"), _orphans("l_orderkey", "orders", "o_orderkey", "l_quantity > 25")),
        (R.known({"l_partkey": "p_partkey"}, "part"), _orphans("l_partkey", "part", "p_partkey")),
        (R.known({"l_suppkey": "s_suppkey"}, "supplier"), _orphans("l_suppkey", "supplier", "s_suppkey")),
        (R.known({"l_linenumber": "s_suppkey"}, "supplier", name="line numbers are suppliers", severity="warn"), _orphans("l_linenumber", "supplier", "s_suppkey")),
        (R.known({"l_partkey": "s_suppkey"}, "supplier", name="parts are suppliers", severity="warn"), _orphans("l_partkey", "supplier", "s_suppkey")),
        (R.at_least(1), "(select case when count(*) < 1 then 1 else 0 end from {table})"),
        (R.at_least(10**12, name="more than there are", severity="warn"), "(select case when count(*) < 1000000000000 then 1 else 0 end from {table})"),
        (R.named("l_[a-z]+"), "(select 0)"),
    ]
    return out


def order_rules():
    out = [(R.required(c), _rows(f"{c} is null")) for c in ORDER]
    return out + [
        (R.unique("o_orderkey"), _keys("o_orderkey")),
        (R.known({"o_custkey": "c_custkey"}, "customer"), _orphans("o_custkey", "customer", "c_custkey")),
        (R.known({"o_custkey": "s_suppkey"}, "supplier", name="clients are suppliers", severity="warn"), _orphans("o_custkey", "supplier", "s_suppkey")),
        (R.accepted("o_orderpriority", ["1-URGENT", "2-HIGH"], name="pressing", severity="warn"), _rows("o_orderpriority not in ('1-URGENT', '2-HIGH')")),
        (R.within("o_totalprice", low=0), _rows("o_totalprice < 0")),
        (R.named("[a-z]_[a-z]+key", name="key columns", severity="warn"), "(select 4)"),
    ]


TABLES = {"lineitem": line_rules(), "orders": order_rules()}


def _sql():
    rows = " union all ".join(
        f"select '{t}' as \"table\", '{r.name.replace(chr(39), chr(39) * 2)}' as \"rule\", '{r.severity}' as severity, {r.warn_if} as warn_if, {r.error_if} as error_if, {sql.format(table=t)} as violations"
        for t, own in TABLES.items() for r, sql in own)
    return (f"select \"table\", \"rule\", severity, violations::bigint as violations, case when severity <> 'warn' and violations >= error_if then 'fail' "
            f"when violations >= warn_if then 'warn' else 'pass' end as status from ({rows})")


def rule_report(spark, d):
    names = [*TABLES, "part", "supplier", "customer"]
    return R.report({t: S.table(spark, d, t) for t in names}, {t: [r for r, _ in own] for t, own in TABLES.items()})


@register("q_rule_report", _sql())
def q_rule_report(spark, d):
    """112 rules on two tables; line items are read once for all row rules and once per grouping."""
    return rule_report(spark, d).drop("sample")
