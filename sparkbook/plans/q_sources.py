"""Queries for the source-side operators on stand-ins of the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkbook.plans import standins as S
from sparkbook.plans.oracle_sql import with_ctes
from sparkbook.plans.registry import register
from sparkbook.session import checkpoint_root
from sparkbook.sources import files as FS
from sparkbook.sources import registers as R

FLAGS = ["A", "N", "R"]

_WIDE = {"wide": "select cast(l_shipdate as date) as rate_date, " + ", ".join(
    f"cast(max(case when l_returnflag = '{f}' then cast(l_extendedprice as decimal(18,2)) end) as varchar) as \"{f}\""
    for f in FLAGS) + " from lineitem group by cast(l_shipdate as date)"}


def wide_matrix(spark, d):
    li = S.table(spark, d, "lineitem")
    return li.groupBy(F.col("l_shipdate").cast("date").alias("rate_date")).agg(*[
        F.max(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice").cast("decimal(18,2)"))).cast("string").alias(f)
        for f in FLAGS])


@register("q_unpivot", with_ctes(
    "select rate_date, currency, fx_rate from (unpivot wide on \"A\", \"N\", \"R\" into name currency value fx_rate) u "
    "where fx_rate is not null and fx_rate not in ('', 'N/A')", extra=_WIDE))
def q_unpivot(spark, d):
    """Wide matrix to long rows, blanks dropped."""
    return R.unpivot_matrix(wide_matrix(spark, d), "rate_date", FLAGS)


@register("q_unpivot_check", with_ctes(" union all ".join(
    f"select '{f}' as currency, count_if(\"{f}\" is not null and \"{f}\" not in ('', 'N/A')) as quoted_cells, "
    f"count_if(\"{f}\" is not null and \"{f}\" not in ('', 'N/A')) as long_rows from wide" for f in FLAGS), extra=_WIDE))
def q_unpivot_check(spark, d):
    """Quoted cells of the wide matrix equal long rows per column."""
    w = wide_matrix(spark, d)
    q = R.quoted_cells(w, FLAGS)
    lr = R.unpivot_matrix(w, "rate_date", FLAGS).groupBy("currency").agg(F.count(F.lit(1)).cast("bigint").alias("long_rows"))
    return q.join(lr, "currency", "left").select("currency", "quoted_cells",
                                                 F.coalesce("long_rows", F.lit(0)).cast("bigint").alias("long_rows"))


_SLOTS_SQL = {"slots": """select o_orderkey,
    case when o_orderpriority = '1-URGENT' then 'RELATIONSHIP_PERIOD' when o_orderkey % 3 = 0 then null else 'OTHER' end as t1,
    strftime(o_orderdate, '%Y-%m-%d') as s1, cast(null as varchar) as e1,
    case when o_orderstatus = 'F' then 'RELATIONSHIP_PERIOD' else 'ACCOUNTING_PERIOD' end as t2,
    strftime(o_orderdate, '%Y-01-01') as s2, strftime(o_orderdate, '%Y-12-31') as e2,
    'RELATIONSHIP_PERIOD' as t3, '1990-01-01' as s3, o_orderpriority as e3
  from orders"""}


def slots(spark, d):
    o = S.table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", "RELATIONSHIP_PERIOD")
        .when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string")).otherwise("OTHER").alias("t1"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("s1"), F.lit(None).cast("string").alias("e1"),
        F.when(F.col("o_orderstatus") == "F", "RELATIONSHIP_PERIOD").otherwise("ACCOUNTING_PERIOD").alias("t2"),
        F.date_format("o_orderdate", "yyyy-01-01").alias("s2"), F.date_format("o_orderdate", "yyyy-12-31").alias("e2"),
        F.lit("RELATIONSHIP_PERIOD").alias("t3"), F.lit("1990-01-01").alias("s3"), F.col("o_orderpriority").alias("e3"),
    )


def _slot_case(field):
    return "case " + " ".join(f"when t{i} = 'RELATIONSHIP_PERIOD' then {field}{i}" for i in (1, 2, 3)) + " end"


@register("q_slot_pick", with_ctes(
    f"select o_orderkey, {_slot_case('s')} as period_start, {_slot_case('e')} as period_end from slots", extra=_SLOTS_SQL))
def q_slot_pick(spark, d):
    """First numbered slot of the wanted type, fields kept together."""
    spec = [{"type": f"t{i}", "start": f"s{i}", "end": f"e{i}"} for i in (1, 2, 3)]
    pick = R.pick_slot(spec, "type", "RELATIONSHIP_PERIOD", ["start", "end"])
    x = slots(spark, d).select("o_orderkey", pick.alias("p"))
    return x.select("o_orderkey", F.col("p.start").alias("period_start"), F.col("p.end").alias("period_end"))


_CHILD_SQL = {"kids": """select p_partkey as parent_isin, 1 as br, 0 as pos, 'ISIN' as underlying_type, p_brand as underlying_id,
      cast(null as varchar) as underlying_name from part where p_size % 3 = 0
    union all select p_partkey, 2, 0, 'LEI', 'LEI' || cast(p_partkey as varchar), null from part where p_size % 3 = 1
    union all select p_partkey, 3, 0, 'INDEX', null, p_type from part where p_size % 3 = 2
    union all select p_partkey, 4, 0, 'BASKET_ISIN', p_brand, null from part where p_size % 5 = 0
    union all select p_partkey, 4, 1, 'BASKET_ISIN', 'Brand#' || cast(p_size % 25 as varchar), null from part where p_size % 5 = 0"""}


@register("q_child_explode", with_ctes(
    "select parent_isin, underlying_type, underlying_id, underlying_name, cast(row_number() over (partition by parent_isin "
    "order by br, pos) as int) as ordinal from kids", extra=_CHILD_SQL))
def q_child_explode(spark, d):
    """Repeating underlyings as a child table with ordinals in branch order."""
    p = S.table(spark, d, "part")
    m3, m5 = F.col("p_size") % 3, F.col("p_size") % 5
    one = lambda cond, i, n: F.when(cond, F.array(F.struct(i.alias("id"), n.alias("name"))))
    null = F.lit(None).cast("string")
    branches = [
        ("ISIN", one(m3 == 0, F.col("p_brand"), null)),
        ("LEI", one(m3 == 1, F.concat(F.lit("LEI"), F.col("p_partkey").cast("string")), null)),
        ("INDEX", one(m3 == 2, null, F.col("p_type"))),
        ("BASKET_ISIN", F.when(m5 == 0, F.array(
            F.struct(F.col("p_brand").alias("id"), null.alias("name")),
            F.struct(F.concat(F.lit("Brand#"), (F.col("p_size") % 25).cast("string")).alias("id"), null.alias("name"))))),
    ]
    return R.explode_children(p, ["p_partkey"], branches).withColumnRenamed("p_partkey", "parent_isin")


_LISTING = {"listing": "select distinct source_file, effective_date as publication_date from register_deltas"}


def listing(spark, d):
    x = S.register_deltas(spark, d)
    return x.select("source_file", F.col("effective_date").alias("publication_date")).distinct()


@register("q_latest_set", with_ctes(
    "select * from listing where publication_date = (select max(publication_date) from listing)", "register_deltas",
    extra=_LISTING))
def q_latest_set(spark, d):
    """The newest publication set of a file listing."""
    return FS.latest_set(listing(spark, d))


@register("q_resume_gap", with_ctes(
    "select date '1999-06-30' as watermark, cast(date '1999-06-30' + interval 1 day as date) as next_needed, "
    "min(publication_date) as earliest_listed, count(*) as files_to_fetch, "
    "coalesce(min(publication_date) > cast(date '1999-06-30' + interval 1 day as date), false) as is_gap "
    "from listing where publication_date > date '1999-06-30'", "register_deltas", extra=_LISTING))
def q_resume_gap(spark, d):
    """Resume plan after a watermark; flags an unhealable hole."""
    return FS.resume_plan(listing(spark, d), "1999-06-30")


@register("q_fidelity", "select (select count(*) from orders) as source_rows, (select count(*) from orders) as loaded_rows, "
          "true as schema_equal, true as content_equal")
def q_fidelity(spark, d):
    """Load fidelity (counts, ordered schema, contents) of a written table against its source."""
    orders = S.table(spark, d, "orders")
    path = f"{checkpoint_root(spark)}/tables/fidelity-{uuid.uuid4().hex}"
    FS.replace_table(orders, path)
    return FS.verify_load(orders, spark.read.parquet(path))


_FP_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "order_day", "o_orderpriority"]


@register("q_fingerprint", "select count(*) as n_rows, cast(sum(('0x' || substr(h, 1, 16))::UBIGINT::HUGEINT) % "
          "18446744073709551616 as varchar) as fp_a, cast(sum(('0x' || substr(h, 17, 16))::UBIGINT::HUGEINT) % "
          "18446744073709551616 as varchar) as fp_b from (select sha256(concat_ws(chr(31), " + ", ".join(
              f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), 'N')" for c in
              ["o_orderkey", "o_custkey", "o_orderstatus", "cast(o_orderdate as date)", "o_orderpriority"])
          + ")) as h from orders) x")
def q_fingerprint(spark, d):
    """Order-insensitive content fingerprint of a table."""
    o = S.table(spark, d, "orders").withColumn("order_day", F.col("o_orderdate").cast("date"))
    return FS.fingerprint(o, _FP_COLS)


_FP_SQL = ["o_orderkey", "{custkey}", "o_orderstatus", "cast(o_orderdate as date)", "o_orderpriority"]


def _frame_sql(cols):
    return "concat_ws(chr(31), " + ", ".join(f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), 'N')" for c in cols) + ")"


def _tree_sql(custkey):
    return (f"select level, substr(b, 1, level) as prefix, count(*) as n, sum(('0x' || substr(h, 1, 16))::UBIGINT::HUGEINT) as fa, sum(('0x' || substr(h, 17, 16))::UBIGINT::HUGEINT) as fb "
            f"from (select sha256({_frame_sql(c.format(custkey=custkey) for c in _FP_SQL)}) as h, sha256({_frame_sql(['o_orderkey'])}) as b from orders), range(4) l(level) group by all")


@register("q_fingerprint_diff", f"with a as ({_tree_sql('o_custkey')}), b as ({_tree_sql('case when o_orderkey = (select max(o_orderkey) from orders) then o_custkey + 1 else o_custkey end')}) "
          "select a.level::int as level, a.prefix, a.n as left_rows, b.n as right_rows from a join b on a.level = b.level and a.prefix = b.prefix where a.fa <> b.fa or a.fb <> b.fb or a.n <> b.n")
def q_fingerprint_diff(spark, d):
    """A change of one row, narrowed from the table's fingerprint to its bucket."""
    o = S.table(spark, d, "orders").withColumn("order_day", F.col("o_orderdate").cast("date"))
    last = o.agg(F.max("o_orderkey")).scalar()
    changed = o.withColumn("o_custkey", F.when(F.col("o_orderkey") == last, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    return FS.differing_buckets(*[FS.fingerprint_tree(x, ["o_orderkey"], _FP_COLS) for x in (o, changed)])
